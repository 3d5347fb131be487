"""Not-modified revisit records resolved against the latest earlier full response.

The join is as-of: same canonical URL, latest response before the revisit. A URL may
hold a large share of all captures, so each URL's captures are cut into spans of time,
at approximate quantiles of all times: a window works inside a span, and the last
response of the earlier spans (one row per URL and span) is carried in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.llm.quantiles import bounds, bucket

#: Header fields that a 304 response may update (RFC 9110, section 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")

SPANS = 256


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and port 80 or 443; no scheme, fragment, ``utm_`` field or final slash.

    Query fields are sorted. A null URL stays null.
    """
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/?]*", 0)), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    fields = F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"), lambda f: (f != "") & ~f.startswith("utm_"))
    query = F.array_join(F.array_sort(fields), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def _strong(etag: Column) -> Column:
    return F.regexp_replace(etag, r"^W/", "")


def verdict(revisit: Column, response: Column) -> Column:
    """Validators of two header maps: ETag decides, else Last-Modified, else ``unchecked``."""
    tag, old_tag = _strong(revisit["etag"]), _strong(response["etag"])
    date, old_date = revisit["last-modified"], response["last-modified"]
    return (
        F.when(tag.isNotNull() & old_tag.isNotNull(), F.when(tag == old_tag, "valid").otherwise("mismatch"))
        .when(date.isNotNull() & old_date.isNotNull(), F.when(date == old_date, "valid").otherwise("mismatch"))
        .otherwise("unchecked")
    )


def merge_headers(revisit: Column, response: Column) -> Column:
    """The response's fields, those of PERMITTED taken from the revisit where it has them."""
    new = F.map_filter(revisit, lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    old = F.map_filter(response, lambda k, v: ~F.array_contains(F.map_keys(new), k))
    return F.map_concat(old, new)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Each revisit with the response it stands for.

    ``records``: ``record_id long, kind string ('response' or 'revisit'), url string,
    captured long (seconds), headers map<string,string> (lower-case names), payload``.
    Returns ``record_id, url, captured, canonical, refers_to, refers_captured, verdict,
    headers, payload``: headers merged and payload taken over unless the validators
    disagree (``mismatch``) or no earlier response exists (``missing``); then the
    revisit's own headers and no payload.

    Defined cases: only strictly earlier responses count; of several at one time the
    largest record_id wins; records of another or null kind, and responses without
    record_id, URL or time, resolve nothing; a revisit without URL or time is
    ``missing``; null headers count as empty; repeated rows, and rows that share a
    record_id or have none, each give a row, by their own headers; of responses that
    share id, URL and time, the one whose headers and payload hash highest is used; an
    empty table gives an empty table; further columns are not read.
    """
    from kinweave.session import materialise

    headers = F.coalesce("headers", F.expr("cast(map() as map<string,string>)"))
    own = F.when(F.col("kind") == "revisit", headers)  # a revisit's headers go with its row
    keyed = records.select("record_id", "kind", "url", "captured", canonical_url(F.col("url")).alias("canonical"), own.alias("own"))
    keyed = materialise(keyed.where("kind in ('response', 'revisit')"), "warc-keys")
    span = bucket(F.col("captured"), bounds(keyed, "captured", SPANS))
    timed = keyed.where("canonical is not null and captured is not null and (kind = 'revisit' or record_id is not null)").withColumn("span", span)
    full = F.when(F.col("kind") == "response", F.struct("captured", "record_id"))

    ends_of_spans = timed.groupBy("canonical", "span").agg(F.max(full).alias("last"))
    earlier = Window.partitionBy("canonical").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends_of_spans.select("canonical", "span", F.max("last").over(earlier).alias("carried"))
    inside = Window.partitionBy("canonical", "span").orderBy("captured").rangeBetween(Window.unboundedPreceding, -1)
    found = (
        timed.withColumn("near", F.max(full).over(inside))
        .where("kind = 'revisit'")
        .join(carried, ["canonical", "span"])
        .select("record_id", "url", "captured", "canonical", "own", F.coalesce("near", "carried").alias("match"))
    )
    lost = keyed.where("kind = 'revisit' and (canonical is null or captured is null)").select(
        "record_id", "url", "captured", "canonical", "own", F.lit(None).cast("struct<captured:bigint,record_id:bigint>").alias("match")
    )
    found = found.unionByName(lost).withColumns({"refers_to": F.col("match.record_id"), "refers_captured": F.col("match.captured")})
    held = records.where("kind = 'response' and record_id is not null and captured is not null").select(
        F.col("record_id").alias("refers_to"), F.col("captured").alias("refers_captured"), canonical_url(F.col("url")).alias("canonical"), headers.alias("full_headers"), F.col("payload").alias("full_payload")
    )
    one = ["refers_to", "refers_captured", "canonical"]
    order = F.xxhash64(F.array_sort(F.map_entries("full_headers")), "full_payload")
    used = held.groupBy(*one).agg(F.max_by(F.struct("full_headers", "full_payload"), order).alias("full")).select(*one, "full.*")
    joined = found.join(used, one, "left")
    judged = joined.withColumn("verdict", F.when(F.col("refers_to").isNull(), "missing").otherwise(verdict(F.col("own"), F.col("full_headers"))))
    stands = F.col("verdict").isin("valid", "unchecked")
    return judged.select(
        "record_id", "url", "captured", "canonical", "refers_to", "refers_captured", "verdict",
        F.when(stands, merge_headers(F.col("own"), F.col("full_headers"))).otherwise(F.col("own")).alias("headers"),
        F.when(stands, F.col("full_payload")).alias("payload"),
    )

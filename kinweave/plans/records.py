"""Scans, text repair and counts over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinweave.functions.text import MARKED, PLAIN, canonical, doubtful, first_year
from kinweave.operators.similarity_join import one_edit_pairs
from kinweave.session import materialise
from kinweave.sources.tables import table


def scan_filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipped lines of a discount band by year and flag; filter and columns reach the scan."""
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_discount").between(0.05, 0.07) & (F.col("l_quantity") < 24))
    revenue = F.col("l_extendedprice").cast("decimal(18,4)") * F.col("l_discount").cast("decimal(18,4)")
    return lines.groupBy(F.year("l_shipdate").alias("ship_year"), "l_returnflag").agg(
        F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"), F.round(F.sum(revenue).cast("double"), 2).alias("revenue")
    )


SCAN_FILTER_PROJECT = """
SELECT year(l_shipdate) AS ship_year, l_returnflag, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
  round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(l_discount AS DECIMAL(18,4))) AS DOUBLE), 2) AS revenue
FROM lineitem WHERE l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24 GROUP BY ALL
"""


def decade_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by decade and status, with the years of the decade that have none."""
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", F.year("o_orderdate").alias("y"))
    out = orders.groupBy((F.floor(F.col("y") / 10) * 10).alias("decade"), "o_orderstatus").agg(F.count("*").alias("n"), F.count_distinct("y").alias("years"))
    return out.withColumn("missing_years", 10 - F.col("years"))


DECADE_HISTOGRAM = """
SELECT year(o_orderdate) // 10 * 10 AS decade, o_orderstatus, count(*) AS n, count(DISTINCT year(o_orderdate)) AS years,
  10 - count(DISTINCT year(o_orderdate)) AS missing_years
FROM orders GROUP BY ALL
"""


def gaps_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of each customer's orders: a gap of more than 180 days begins a new one."""
    day = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"))
    by = Window.partitionBy("o_custkey").orderBy("day")
    new = F.when(F.datediff("day", F.lag("day").over(by)) <= 180, 0).otherwise(1)
    runs = day.withColumn("new", new).withColumn("run", F.sum("new").over(by.rangeBetween(Window.unboundedPreceding, 0)))
    # Orders of one day share a run: the first of them decides.
    return runs.groupBy("o_custkey", "run").agg(F.min("day").cast("string").alias("first_day"), F.max("day").cast("string").alias("last_day"), F.count("*").alias("orders"))


GAPS_COMPACT = """
WITH d AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders),
n AS (SELECT *, CASE WHEN day - lag(day) OVER (PARTITION BY o_custkey ORDER BY day) <= 180 THEN 0 ELSE 1 END AS new FROM d),
r AS (SELECT *, sum(new) OVER (PARTITION BY o_custkey ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM n)
SELECT o_custkey, CAST(run AS BIGINT) AS run, CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day, count(*) AS orders FROM r GROUP BY o_custkey, run
"""


def words(docs: DataFrame) -> DataFrame:
    """``doc_id, word``: lower-case words, letters of any script."""
    return docs.select("doc_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))


WORDS_SQL = r"SELECT doc_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM documents"


def top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thirty commonest words, with the documents that have them."""
    each = words(table(spark, sf_dir, "documents")).groupBy("doc_id", "word").agg(F.count("*").alias("n"))
    return each.groupBy("word").agg(F.sum("n").alias("n"), F.count("*").alias("documents")).orderBy(F.desc("n"), "word").limit(30)


TOP_TERMS = f"""
SELECT word, count(*) AS n, count(DISTINCT doc_id) AS documents FROM ({WORDS_SQL}) GROUP BY word ORDER BY n DESC, word LIMIT 30
"""


def uncertainty_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with marks of doubt taken out: how many are doubtful, by role."""
    turns = table(spark, sf_dir, "conversations").select("role", F.length("text").alias("before"), doubtful(F.col("text")).alias("d"))
    return turns.groupBy("role").agg(
        F.count("*").alias("turns"), F.count_if(F.col("d.uncertain")).alias("doubtful"), F.sum(F.coalesce(F.length("d.value"), F.lit(0))).alias("chars"), F.sum("before").alias("chars_before")
    )


UNCERTAINTY_SPLIT = r"""
SELECT role, count(*) AS turns,
  count(*) FILTER (regexp_matches(text, '\[\?\]|\(\?\)|\?\s*$|\[[^\]]*\]')) AS doubtful,
  CAST(sum(length(trim(regexp_replace(trim(regexp_replace(text, '\[\?\]|\(\?\)', '', 'g')), '[?\s]+$', '')))) AS BIGINT) AS chars,
  CAST(sum(length(text)) AS BIGINT) AS chars_before
FROM conversations GROUP BY role
"""


def canonical_form_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings that share a canonical form, and the one best attested."""
    forms = words(table(spark, sf_dir, "documents")).groupBy("word").agg(F.count("*").alias("n"))
    grouped = forms.withColumn("form", canonical(F.col("word"))).groupBy("form")
    best = F.max_by("word", F.struct("n", F.col("word")))
    return grouped.agg(F.count("*").alias("spellings"), F.sum("n").alias("n"), best.alias("best")).where("spellings > 1")


CANONICAL_FORM_GROUPS = f"""
WITH f AS (SELECT word, count(*) AS n FROM ({WORDS_SQL}) GROUP BY word),
p AS (SELECT word, n, CASE WHEN length(w) > 4 AND left(w, 2) IN ('di', 'de', 'lo', 'la') THEN left(w, 1) || w[3:] ELSE w END AS s
  FROM (SELECT word, n, translate(word, '{MARKED}', '{PLAIN}') AS w FROM f)),
c AS (SELECT word, n, array_to_string(list_filter(string_split(s, ''), lambda x, i: i = 1 OR x <> s[i - 1]), '') AS form FROM p)
SELECT form, count(*) AS spellings, CAST(sum(n) AS BIGINT) AS n, arg_max(word, (n, word)) AS best FROM c GROUP BY form HAVING count(*) > 1
"""


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by a field of their JSON and its band."""
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return events.groupBy("event_type", (F.floor(F.col("k") / 10) * 10).alias("band")).agg(F.count("*").alias("n"), F.sum("k").alias("total"))


JSON_PROPS = """
SELECT event_type, CAST(props->>'$.k' AS INT) // 10 * 10 AS band, count(*) AS n, CAST(sum(CAST(props->>'$.k' AS INT)) AS BIGINT) AS total FROM events GROUP BY ALL
"""


def html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, language, number and title of each page, and how many links it has."""
    pages = table(spark, sf_dir, "pages")
    text = lambda c, p: F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    return pages.select(
        "page_id", text("url", "^https?://([^/?#]+)").alias("host"), text("url", "^https?://[^/]+/([a-z]+)/").alias("lang"),
        text("url", "/([0-9]+)").cast("long").alias("number"), text("html", "<title>([^<]*)</title>").alias("title"),
        F.size(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).cast("long").alias("links"),
    )


HTML_EXTRACT = """
SELECT page_id, nullif(regexp_extract(url, '^https?://([^/?#]+)', 1), '') AS host, nullif(regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1), '') AS lang,
  CAST(nullif(regexp_extract(url, '/([0-9]+)', 1), '') AS BIGINT) AS number, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title,
  len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS links
FROM pages
"""


def relevance_with_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of chosen segments, and those of others in nations that would else have none.

    A row left out by kind comes back if nothing kept covers its group; the reason is given.
    """
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    wanted = F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & (F.col("c_acctbal") > 8000)
    judged = rows.withColumn("kept", wanted)
    covered = judged.where("kept").select("c_nationkey").distinct()
    back = judged.where("not kept and c_acctbal > 9000").join(covered, "c_nationkey", "left_anti").withColumn("reason", F.lit("gap"))
    return judged.where("kept").withColumn("reason", F.lit("wanted")).unionByName(back).select("c_custkey", "c_nationkey", "reason")


RELEVANCE_WITH_SERIES = """
WITH j AS (SELECT *, c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_acctbal > 8000 AS kept FROM customer)
SELECT c_custkey, c_nationkey, 'wanted' AS reason FROM j WHERE kept
UNION ALL SELECT c_custkey, c_nationkey, 'gap' FROM j WHERE NOT kept AND c_acctbal > 9000 AND NOT EXISTS (SELECT 1 FROM j k WHERE k.kept AND k.c_nationkey = j.c_nationkey)
"""


def years_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The year that a part of a text names, else the record's own: here of pages by URL, else their number."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.select("page_id", F.coalesce(first_year(F.col("url")), F.lit(0)).alias("year"))


YEARS_IN_TEXT = r"""
SELECT page_id, coalesce(CAST(nullif(regexp_extract(url, '\b(1[78]\d{2}|19\d{2})\b', 1), '') AS INT), 0) AS year FROM pages
"""


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words(table(spark, sf_dir, "documents")).groupBy(F.col("word").alias("form")).agg(F.count("*").alias("n"))


def similarity_join_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of words of the documents one edit apart."""
    return one_edit_pairs(_counts(spark, sf_dir))


_EDITS_SQL = f"""
f AS (SELECT word AS form, count(*) AS n FROM ({WORDS_SQL}) GROUP BY word),
d AS (SELECT form, i, left(form, i - 1) || form[i + 1:] AS key FROM (SELECT form, unnest(range(1, length(form) + 1)) AS i FROM f)),
pairs AS (SELECT DISTINCT least(form, other) AS a, greatest(form, other) AS b FROM (
  SELECT d.form, f.form AS other FROM d JOIN f ON f.form = d.key UNION ALL SELECT x.form, y.form FROM d x JOIN d y ON x.key = y.key AND x.i = y.i AND x.form < y.form))
"""

SIMILARITY_JOIN_BOUNDED = f"WITH {_EDITS_SQL} SELECT a, b, 1 AS distance FROM pairs"


def variant_dominance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each rarely attested word beside the best attested word one edit away, if that is four times as common."""
    counts = materialise(_counts(spark, sf_dir), "word-counts")
    pairs = one_edit_pairs(counts)
    both = pairs.select("a", "b").union(pairs.select("b", "a"))
    # A form is a few bytes on disk and many in a task: the counts are shuffled, not sent whole through the driver.
    seen = both.hint("merge").join(counts.select(F.col("form").alias("a"), F.col("n").alias("n")), "a").hint("merge").join(counts.select(F.col("form").alias("b"), F.col("n").alias("target_n")), "b")
    best = seen.where("target_n >= 4 * n").groupBy(F.col("a").alias("form"), "n").agg(F.max(F.struct("target_n", "b")).alias("t"))
    return best.select("form", "n", F.col("t.b").alias("target"), F.col("t.target_n").alias("target_n"))


VARIANT_DOMINANCE = f"""
WITH {_EDITS_SQL}, sides AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs)
SELECT x.form, x.n, arg_max(y.form, (y.n, y.form)) AS target, max(y.n) AS target_n
FROM sides JOIN f x ON x.form = sides.a JOIN f y ON y.form = sides.b WHERE y.n >= 4 * x.n GROUP BY x.form, x.n
"""


def learned_binary_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources whose labels agree in at least 85 % of at least three cases."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    shares = rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("quality").alias("good"))
    share = F.col("good") / F.col("n")
    verdict = F.when(F.col("n") < 3, "unknown").when(share >= 0.85, "good").when(share <= 0.15, "bad").otherwise("mixed")
    return shares.select("source", "n", "good", verdict.alias("verdict"))


LEARNED_BINARY_SHARE = """
SELECT source, count(*) AS n, CAST(sum(quality) AS BIGINT) AS good,
  CASE WHEN count(*) < 3 THEN 'unknown' WHEN sum(quality) / count(*) >= 0.85 THEN 'good' WHEN sum(quality) / count(*) <= 0.15 THEN 'bad' ELSE 'mixed' END AS verdict
FROM labels JOIN documents USING (doc_id) GROUP BY source
"""


def dedupe_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of equal text after folding case and spaces: the first of each and how many."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.trim(F.regexp_replace(F.lower("text"), "[ \\t\\n\\r]+", " ")).cast("binary")).alias("key"))
    return docs.groupBy("key").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("copies")).where("copies > 1")


DEDUPE_DOCUMENTS = """
SELECT md5(trim(regexp_replace(lower(text), '[ \\t\\n\\r]+', ' ', 'g'))) AS key, min(doc_id) AS first_doc, count(*) AS copies FROM documents GROUP BY key HAVING count(*) > 1
"""


#: Distinct runs of eight bytes that may be sent to every task.
MAX_SENT_RUNS = 2_000_000


def benchmark_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that share a run of eight words with a benchmark item, and how many runs.

    Runs are hashed on both sides. Where the benchmark's distinct runs are few enough to
    send to every task (their number is counted), the documents' runs are held against them
    before anything is shuffled, so that only runs of the benchmark leave their task;
    otherwise both sides are shuffled by run.
    """

    def runs(rows: DataFrame, key: str) -> DataFrame:
        listed = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))
        rows = rows.select(key, listed.alias("w"))
        eight = F.transform(F.sequence(F.lit(0), F.size("w") - 8), lambda i: F.xxhash64(F.array_join(F.slice("w", i + 1, F.lit(8)), " ")))
        return rows.where(F.size("w") >= 8).select(key, F.explode(F.array_distinct(eight)).alias("run"))

    known = materialise(runs(table(spark, sf_dir, "benchmark"), "item_id"), "benchmark-runs")
    seen = known.select("run").distinct()
    held = runs(table(spark, sf_dir, "documents"), "doc_id")
    if seen.count() <= MAX_SENT_RUNS:
        held = held.join(F.broadcast(seen), "run", "left_semi")
    found = held.join(known, "run")
    return found.groupBy("doc_id", "item_id").agg(F.count("*").alias("runs"))


_RUNS = """SELECT DISTINCT {k}, array_to_string(w[i:i + 7], ' ') AS run FROM (
  SELECT {k}, w, unnest(range(1, len(w) - 6)) AS i FROM (SELECT {k}, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}\\p{{N}}]+') AS w FROM {t}) WHERE len(w) >= 8)"""

BENCHMARK_CONTAMINATION = f"""
WITH d AS ({_RUNS.format(k="doc_id", t="documents")}), b AS ({_RUNS.format(k="item_id", t="benchmark")})
SELECT doc_id, item_id, count(*) AS runs FROM d JOIN b USING (run) GROUP BY ALL
"""


def bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents for three terms: BM25 with a boost for often-seen sources.

    Terms are counted inside each document; only rows that have one are kept, so the
    corpus is never indexed whole for one question.
    """
    terms = ["the", "that", "was"]

    def occurrences(term: str) -> Column:
        return F.size(F.filter("w", lambda x: x == term))

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)).alias("w"))
    counted = docs.select("doc_id", "source", F.size("w").alias("dl"), *[occurrences(t).alias(f"tf{i}") for i, t in enumerate(terms)])
    stat = counted.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"), *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))])
    sources = counted.groupBy("source").agg(F.count("*").alias("held"))
    rows = counted.where(" and ".join(f"tf{i} > 0" for i in range(len(terms)))).crossJoin(F.broadcast(stat)).join(sources, "source")  # one row of totals
    idf = lambda i: F.ln(1 + (F.col("n") - F.col(f"df{i}") + 0.5) / (F.col(f"df{i}") + 0.5))
    tf = lambda i: F.col(f"tf{i}") * 2.2 / (F.col(f"tf{i}") + 1.2 * (0.25 + 0.75 * F.col("dl") / F.col("avgdl")))
    score = sum((idf(i) * tf(i) for i in range(len(terms))), F.lit(0.0)) + 1.5 * F.log10(1 + F.col("held"))
    return rows.select("doc_id", F.round(score, 6).alias("score")).orderBy(F.desc("score"), "doc_id").limit(50)


BM25_SEARCH = r"""
WITH w AS (SELECT doc_id, source, regexp_extract_all(lower(text), '\p{L}+') AS w FROM documents),
c AS (SELECT doc_id, source, len(w) AS dl, len(list_filter(w, lambda x: x = 'the')) AS t0, len(list_filter(w, lambda x: x = 'that')) AS t1, len(list_filter(w, lambda x: x = 'was')) AS t2 FROM w),
s AS (SELECT count(*) AS n, avg(dl) AS a, count(*) FILTER (t0 > 0) AS d0, count(*) FILTER (t1 > 0) AS d1, count(*) FILTER (t2 > 0) AS d2 FROM c),
h AS (SELECT source, count(*) AS held FROM c GROUP BY source)
SELECT doc_id, round(0.0 + ln(1 + (n - d0 + 0.5) / (d0 + 0.5)) * (t0 * 2.2 / (t0 + 1.2 * (0.25 + 0.75 * dl / a)))
  + ln(1 + (n - d1 + 0.5) / (d1 + 0.5)) * (t1 * 2.2 / (t1 + 1.2 * (0.25 + 0.75 * dl / a)))
  + ln(1 + (n - d2 + 0.5) / (d2 + 0.5)) * (t2 * 2.2 / (t2 + 1.2 * (0.25 + 0.75 * dl / a))) + 1.5 * log10(1 + held), 6) AS score
FROM c JOIN h USING (source), s WHERE t0 > 0 AND t1 > 0 AND t2 > 0 ORDER BY score DESC, doc_id LIMIT 50
"""


def embedding_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each label, the ten vectors nearest to its centre (cosine)."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.transform("embedding", lambda v: v.cast("double")).alias("v"))
    parts = rows.select("label", F.posexplode("v").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("decimal(20,12)")).cast("double").alias("m"))
    centres = parts.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("c"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    scored = rows.join(centres, "label").withColumn("score", F.round(dot(F.col("v"), F.col("c")) / F.sqrt(dot(F.col("v"), F.col("v")) * dot(F.col("c"), F.col("c"))), 6))
    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", rank).where("rank <= 10").select("label", "rank", "vec_id", "score")


EMBEDDING_TOPK = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
p AS (SELECT label, i, CAST(avg(v[i]) AS DOUBLE) AS m FROM (SELECT label, v, unnest(range(1, len(v) + 1)) AS i FROM e) GROUP BY ALL),
c AS (SELECT label, list(m ORDER BY i) AS c FROM p GROUP BY label),
s AS (SELECT label, vec_id, round(list_cosine_similarity(v, c), 6) AS score FROM e JOIN c USING (label))
SELECT label, rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""


QUERIES = {
    "scan_filter_project": (scan_filter_project, SCAN_FILTER_PROJECT),
    "decade_histogram": (decade_histogram, DECADE_HISTOGRAM),
    "gaps_compact": (gaps_compact, GAPS_COMPACT),
    "top_terms": (top_terms, TOP_TERMS),
    "uncertainty_split": (uncertainty_split, UNCERTAINTY_SPLIT),
    "canonical_form_groups": (canonical_form_groups, CANONICAL_FORM_GROUPS),
    "json_props": (json_props, JSON_PROPS),
    "html_extract": (html_extract, HTML_EXTRACT),
    "relevance_with_series": (relevance_with_series, RELEVANCE_WITH_SERIES),
    "years_in_text": (years_in_text, YEARS_IN_TEXT),
    "similarity_join_bounded": (similarity_join_bounded, SIMILARITY_JOIN_BOUNDED),
    "variant_dominance": (variant_dominance, VARIANT_DOMINANCE),
    "learned_binary_share": (learned_binary_share, LEARNED_BINARY_SHARE),
    "dedupe_documents": (dedupe_documents, DEDUPE_DOCUMENTS),
    "benchmark_contamination": (benchmark_contamination, BENCHMARK_CONTAMINATION),
    "bm25_search": (bm25_search, BM25_SEARCH),
    "embedding_topk": (embedding_topk, EMBEDDING_TOPK),
}

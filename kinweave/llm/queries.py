"""The queries of this subpackage and the SQL that gives the same rows, where SQL can."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm import ann, bpe, minhash, mixing, phrases, quality, sentence_pieces, shards, spotsigs, token_counts, toxicity, vector_codes, warc
from kinweave.session import materialise, working_dir

BPE_FILE = "byte_bpe_multi_50k.tiktoken"
PIECE_FILE = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    scored = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), columns=["doc_id"])
    return scored.select("doc_id", "held_out", "score", "predicted")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every document, as digests."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    coded = bpe.encode(docs, bpe.load_ranks(tokenizer_path(BPE_FILE)), pattern=public_tokenizers.PATTERN, columns=["doc_id"], with_decoded=True)
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_text_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    scored = toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), columns=["doc_id"])
    return scored.select("doc_id", "held_out", "score", "predicted")


def op4_multiprobe_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes every document's sequences as shards in the shared folder; the index of all records."""
    path = f"{working_dir(spark)}/kinweave/shards-{uuid.uuid4().hex}"
    return shards.write_shards(table(spark, sf_dir, "documents"), path)


def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each text and its edited text, and their likeness."""
    rows = spotsigs.with_next(table(spark, sf_dir, "documents"))
    rows = rows.withColumn("edited", spotsigs.edited(F.col("text"), F.col("next_text")))
    rows = rows.select("id", F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "spots", "next_spots", spotsigs.spot_set(F.col("edited")).alias("edited_spots"))
    return rows.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        spotsigs.as_text(F.col("spots")).alias("fingerprint"),
        spotsigs.as_text(F.col("edited_spots")).alias("edited_fingerprint"),
        spotsigs.likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        spotsigs.likeness(F.col("spots"), F.col("next_spots")).alias("near_next"),
    )


def op7_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "repetitions", "taken")


def captures(pages: DataFrame) -> DataFrame:
    """Each page as a full response, and its later revisit, answered "not modified"."""
    html = F.coalesce("html", F.lit(""))
    at = F.col("page_id") * 60
    base = pages.select(
        "page_id", "url", "html", at.alias("at"),
        F.concat(F.lit('"'), F.md5(html.cast("binary")), F.lit('"')).alias("etag"),
        F.octet_length(html).cast("string").alias("length"),
    )
    full = F.create_map(
        F.lit("content-type"), F.lit("text/html"), F.lit("content-length"), F.col("length"),
        F.lit("date"), F.col("at").cast("string"), F.lit("etag"), F.col("etag"), F.lit("server"), F.lit("full"),
    )
    later = F.col("at") + 86_400
    again = F.create_map(
        F.lit("content-length"), F.lit("0"), F.lit("date"), later.cast("string"), F.lit("etag"), F.concat(F.lit("W/"), F.col("etag")),
        F.lit("cache-control"), F.lit("max-age=60"), F.lit("server"), F.lit("again"),
    )
    responses = base.select((F.col("page_id") * 2).alias("record_id"), F.lit("response").alias("kind"), "url", F.col("at").alias("captured"), full.alias("headers"), F.col("html").alias("payload"))
    revisits = base.select((F.col("page_id") * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"), "url", later.alias("captured"), again.alias("headers"), F.lit(None).cast("string").alias("payload"))
    return responses.unionByName(revisits)


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisits derived from every page, with what they resolve to."""
    done = warc.resolve_revisits(captures(table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return done.select(
        "record_id", "canonical", "captured", "refers_to", "refers_captured", "verdict",
        F.array_join(lines, "\n").alias("headers"),
        F.sha2(F.col("payload").cast("binary"), 256).alias("payload_sha256"),
    )


OP8_SQL = r"""
WITH keyed AS (
  SELECT page_id, page_id * 60 AS at, coalesce(html, '') AS html, '"' || md5(coalesce(html, '')) || '"' AS etag,
    regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare
  FROM pages),
canon AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*', 0)), '^www\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '')
    || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS canonical
  FROM (SELECT *, list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'), lambda f: f <> '' AND NOT starts_with(f, 'utm_'))) AS q FROM keyed)),
best AS (
  SELECT r.page_id, r.canonical, r.at + 86400 AS captured, r.etag, max(f.at) AS fat
  FROM canon r LEFT JOIN canon f ON f.canonical = r.canonical AND f.at < r.at + 86400
  GROUP BY ALL),
pick AS (
  SELECT b.*, max(f.page_id) AS fid FROM best b LEFT JOIN canon f ON f.canonical = b.canonical AND f.at = b.fat GROUP BY ALL)
SELECT p.page_id * 2 + 1 AS record_id, p.canonical, p.captured, p.fid * 2 AS refers_to, p.fat AS refers_captured,
  CASE WHEN f.etag = p.etag THEN 'valid' ELSE 'mismatch' END AS verdict,
  CASE WHEN f.etag = p.etag THEN 'cache-control: max-age=60' || chr(10) || 'content-length: ' || strlen(f.html) || chr(10) || 'content-type: text/html'
      || chr(10) || 'date: ' || p.captured || chr(10) || 'etag: W/' || p.etag || chr(10) || 'server: full'
    ELSE 'cache-control: max-age=60' || chr(10) || 'content-length: 0' || chr(10) || 'date: ' || p.captured || chr(10) || 'etag: W/' || p.etag || chr(10) || 'server: again' END AS headers,
  CASE WHEN f.etag = p.etag THEN sha256(f.html) END AS payload_sha256
FROM pick p JOIN canon f ON f.page_id = p.fid
"""


def op9_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 3-word shingles, similarity 0.85."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op10_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece lengths of every document."""
    docs = table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, token_counts.load_pieces(tokenizer_path(PIECE_FILE)))


#: Totals by label of at most so many labels are sent to every task; more are joined by a shuffle.
MOST_LABELS_SENT = 200_000


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of every usable vector, with its error and that of all vectors of its label.

    Labels compare as they are, nulls together; the total of a label is one row, so a
    label of any number of vectors is joined without gathering them.
    """
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    books = vector_codes.learn(vectors)
    coded = materialise(vector_codes.encode(vectors, books, columns=["vec_id", "label"]), "vc-coded")
    totals = materialise(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label"), "vc-totals")
    if totals.limit(MOST_LABELS_SENT + 1).count() <= MOST_LABELS_SENT:
        totals = F.broadcast(totals)
    joined = coded.join(totals, F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256"))


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests; each batch checked against the library."""
    docs = table(spark, sf_dir, "documents")
    coded = sentence_pieces.encode(docs, sentence_pieces.load_model(tokenizer_path(PIECE_FILE)), columns=["doc_id"], with_decoded=True, check=True)
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 collocations, from all documents."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH RECURSIVE pieces AS MATERIALIZED (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
lists AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
places AS (SELECT lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) AS k FROM starts),
f AS MATERIALIZED (
  SELECT lang, k, array_to_string(w[i:i+k-1], ' ') AS phrase, count(*) AS f FROM places GROUP BY ALL),
total AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 100),
kept AS (
  SELECT * FROM cand c WHERE NOT EXISTS (
    SELECT 1 FROM cand d WHERE d.lang = c.lang AND d.k > c.k AND 100 * d.f >= 100 * c.f AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' '))),
cuts AS (SELECT lang, phrase, w, k, f AS a, unnest(range(1, k)) AS cut FROM kept),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, n, (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut+1:], ' ') JOIN total t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best QUALIFY rank <= 2000),
edges AS (SELECT lang, phrase, f, array_to_string(w[1:4], ' ') AS u, array_to_string(w[2:5], ' ') AS v, w[5] AS last FROM cand WHERE k = 5),
steps AS (
  SELECT a.lang, a.phrase, b.phrase AS next, b.last FROM edges a JOIN f n ON n.lang = a.lang AND n.phrase = a.v AND n.f = a.f
  JOIN edges b ON b.lang = a.lang AND b.u = a.v AND b.f = a.f),
walk AS (
  SELECT e.lang, e.phrase AS head, e.phrase AS at, e.phrase AS passage FROM edges e
  WHERE NOT EXISTS (SELECT 1 FROM steps s WHERE s.lang = e.lang AND s.next = e.phrase)
  UNION ALL SELECT w.lang, w.head, s.next, w.passage || ' ' || s.last FROM walk w JOIN steps s ON s.lang = w.lang AND s.phrase = w.at),
whole AS (SELECT lang, head, max_by(passage, len(passage)) AS passage FROM walk GROUP BY ALL),
lies AS (SELECT w.lang, w.at, p.passage FROM walk w JOIN whole p ON p.lang = w.lang AND p.head = w.head)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n::BIGINT AS n, r.score::BIGINT AS score, coalesce(p.passage, r.phrase) AS passage
FROM ranked r LEFT JOIN lies p ON p.lang = r.lang AND p.at = r.phrase
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bradley_terry": op1_bradley_terry,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_text_cnn": op3_text_cnn,
    "op4_multiprobe_lsh": op4_multiprobe_lsh,
    "op5_training_order": op5_training_order,
    "op6_spotsigs": op6_spotsigs,
    "op7_water_filling": op7_water_filling,
    "op8_warc_revisits": op8_warc_revisits,
    "op9_bbit_minhash": op9_bbit_minhash,
    "op10_piece_counts": op10_piece_counts,
    "op11_vector_codes": op11_vector_codes,
    "op12_sentence_pieces": op12_sentence_pieces,
    "op13_collocations": op13_collocations,
}

ORACLES: dict[str, str] = {"op8_warc_revisits": OP8_SQL, "op13_collocations": OP13_SQL}

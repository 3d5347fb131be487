"""Reviews and searches over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.functions.text import ABSENT, ACT_NAMED, ELSEWHERE, HONOURS, NO_NAME, is_reading, looks_elsewhere, name_shaped
from kinweave.functions.weights import act_number
from kinweave.operators import review
from kinweave.plans.records import _EDITS_SQL, WORDS_SQL, variant_dominance, words
from kinweave.plans.village import _VILLAGE, mentions, pick, pick_sql, quoted
from kinweave.session import working_dir
from kinweave.sources.tables import table
from kinweave.streaming.orphans import run_attaching


def index_disagreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts returned (as the index) against parts shipped late (as the records), by supplier."""
    lines = table(spark, sf_dir, "lineitem")
    return review.index_disagreement(lines.where("l_returnflag = 'R'"), lines.where("l_shipdate >= '1998-01-01'"), "l_suppkey", "l_partkey")


INDEX_DISAGREEMENT = """
WITH i AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_returnflag = 'R'), r AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_shipdate >= '1998-01-01')
SELECT l_suppkey, count(*) FILTER (a AND b) AS "both", count(*) FILTER (a AND NOT b) AS only_index, count(*) FILTER (b AND NOT a) AS only_records FROM (
  SELECT coalesce(i.l_suppkey, r.l_suppkey) AS l_suppkey, i.l_partkey IS NOT NULL AS a, r.l_partkey IS NOT NULL AS b FROM i FULL JOIN r ON i.l_suppkey = r.l_suppkey AND i.l_partkey = r.l_partkey) GROUP BY l_suppkey
"""


def glossary_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken for spellings of a commoner word, though both stand in the same documents."""
    return review.glossary_audit(words(table(spark, sf_dir, "documents")), variant_dominance(spark, sf_dir))


GLOSSARY_AUDIT = f"""
WITH {_EDITS_SQL}, sides AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
g AS (SELECT x.form, arg_max(y.form, (y.n, y.form)) AS target FROM sides JOIN f x ON x.form = sides.a JOIN f y ON y.form = sides.b WHERE y.n >= 4 * x.n GROUP BY x.form),
u AS (SELECT DISTINCT doc_id, word FROM ({WORDS_SQL})),
t AS (SELECT form, target, count(*) AS together FROM g JOIN u a ON a.word = form JOIN u b ON b.word = target AND a.doc_id = b.doc_id GROUP BY ALL)
SELECT g.form, g.target, coalesce(together, 0) AS together, x.n AS form_n, y.n AS target_n FROM g LEFT JOIN t USING (form, target) JOIN f x ON x.form = g.form JOIN f y ON y.form = g.target
WHERE coalesce(together, 0) >= 3 OR x.n > y.n
"""


def prefix_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose names match "red wid" by prefix or written as one, often sold ones first."""
    parts = table(spark, sf_dir, "part").where(review.matches("red wid", F.split(F.lower("p_name"), " ")))
    sold = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("lines"))
    score = F.round(3 * F.log10(1 + F.coalesce("lines", F.lit(0))), 6)
    return parts.join(sold, "p_partkey", "left").select("p_partkey", "p_name", score.alias("score"))


PREFIX_SEARCH = """
SELECT p_partkey, p_name, round(3 * log10(1 + (SELECT count(*) FROM lineitem WHERE l_partkey = p_partkey)), 6) AS score FROM part
WHERE len(list_filter(string_split(lower(p_name), ' '), lambda w: starts_with(w, 'red'))) > 0 AND len(list_filter(string_split(lower(p_name), ' '), lambda w: starts_with(w, 'wid'))) > 0
  OR len(list_filter(string_split(lower(p_name), ' '), lambda w: starts_with(w, 'redwid') OR starts_with(w, 'rewid'))) > 0
"""

def stored_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that answer "red wid", from stored postings of all their names: those returned at least once, best first."""
    base = f"{working_dir(spark)}/kinweave/postings-{uuid.uuid4().hex}"
    parts, lines = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    review.store_postings(review.word_index(parts, "p_partkey", "p_name"), "p_partkey", base)
    boosts = lines.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("mentions"), F.count_if(F.col("l_returnflag") == "R").alias("links"))
    return review.stored_search(spark, base, boosts, "red wid", "p_partkey")[0]


def _way_sql(*terms: str) -> str:
    parts = [
        f"(SELECT p_partkey, ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl)) AS w FROM (SELECT p_partkey, count(*) AS tf, count(*) OVER () AS df FROM w WHERE starts_with(word, '{t}') GROUP BY p_partkey) JOIN d USING (p_partkey), c) t{i}"
        for i, t in enumerate(terms)
    ]
    return f"SELECT t0.p_partkey, {' + '.join(f't{i}.w' for i in range(len(terms)))} AS bm25 FROM " + " JOIN ".join([parts[0], *[f"{p} ON t{i}.p_partkey = t0.p_partkey" for i, p in enumerate(parts[1:], 1)]])


STORED_SEARCH = f"""
WITH w AS (SELECT p_partkey, unnest(regexp_extract_all(lower(p_name), '[\\p{{L}}\\p{{N}}]+')) AS word FROM part), d AS (SELECT p_partkey, count(*) AS dl FROM w GROUP BY 1), c AS (SELECT count(*) AS docs, avg(dl) AS avgdl FROM d),
b AS (SELECT l_partkey AS p_partkey, count(*) AS mentions, count(*) FILTER (l_returnflag = 'R') AS links FROM lineitem GROUP BY 1),
s AS ({_way_sql("red", "wid")} UNION ALL {_way_sql("redwid")} UNION ALL {_way_sql("rewid")})
SELECT p_partkey, round(max(bm25) + 1.5 * log10(1 + any_value(mentions)) + 3 * log10(1 + any_value(links)), 6) AS score FROM s JOIN b USING (p_partkey) WHERE links > 0 GROUP BY p_partkey
"""


def late_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions (order lines sent back) and records (orders) in one stream of several batches: each decision with the record it was waiting for."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    records = orders.select(F.lit("row").alias("kind"), F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("person"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("come"))
    asked = lines.select(F.lit("decision").alias("kind"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), F.col("l_partkey").alias("person"), F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("come"))
    base = f"{working_dir(spark)}/kinweave/late-{uuid.uuid4().hex}"
    for season in range(3):  # three files' worth of arrivals, each a batch of the stream
        records.unionByName(asked).where((F.col("come") - 1) % 3 == season).coalesce(8).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{base}/in").schema).option("maxFilesPerTrigger", 8).parquet(f"{base}/in")
    return run_attaching(stream, ["person", "year"], f"{base}/out").select(F.col("id").alias("decision"), "subject")


LATE_DECISIONS = """
WITH k AS (SELECT o_custkey AS person, year(o_orderdate) AS year, min(o_orderkey) AS subject FROM orders GROUP BY 1, 2)
SELECT l_orderkey * 8 + l_linenumber AS decision, min(subject) AS subject FROM lineitem LEFT JOIN k ON person = l_partkey AND year = year(l_shipdate) WHERE l_returnflag = 'R' GROUP BY 1
"""


def _cases(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Cases (people of orders whose keys are close) and a log of decisions on people of wider or equal ranges of keys."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    blocks = lambda shift, size: orders.groupBy(F.floor((F.col("o_orderkey") + shift) / size).alias("block"))
    people = F.collect_set("o_custkey")
    cases = blocks(4, 8).agg(people.alias("people"), F.max("o_totalprice").alias("priority"))
    kind = F.get(F.array(*map(F.lit, (*review.ARBITRATED, "DATE_ANOMALY"))), (F.col("block") % 5).cast("int"))
    wide = blocks(0, 32).agg(F.to_json(people).alias("entities")).select("entities", F.when(F.col("block") % 3 == 0, "algorithm").when(F.col("block") % 3 == 1, "anna").alias("decider"))
    same = blocks(4, 8).agg(F.to_json(F.reverse(people)).alias("entities")).where("block % 7 = 0").select("entities", F.lit("anna").alias("decider"))
    return cases.select(F.col("block").alias("id"), kind.alias("kind"), "people", "priority"), wide.unionByName(same)


def arbiter_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases whose people nobody judged together before, and whether all of them stand inside a set that was judged."""
    cases, log = _cases(spark, sf_dir)
    judged = review.judged_sets(log)
    left = review.arbiter_cases(cases, judged)
    outside = review.arbiter_cases(cases, judged, inside=True).select("id", F.lit(False).alias("inside"))
    return left.join(outside, "id", "left").select("id", "kind", F.size("people").alias("people"), "priority", F.coalesce("inside", F.lit(True)).alias("inside"))


ARBITER_CASES = """
WITH c AS (SELECT (o_orderkey + 4) // 8 AS id, list(DISTINCT o_custkey) AS people, max(o_totalprice) AS priority FROM orders GROUP BY 1),
w AS (SELECT o_orderkey // 32 AS block, list(DISTINCT o_custkey) AS people FROM orders GROUP BY 1),
j AS (SELECT people FROM w WHERE block % 3 = 1 UNION ALL SELECT people FROM c WHERE id % 7 = 0)
SELECT id, ['DUPLICATE_PERSON', 'POSSIBLE_HOMONYM', 'MARITAL_ANOMALY', 'IDENTITY_ANOMALY'][id % 5 + 1] AS kind, CAST(len(people) AS INTEGER) AS people, priority, EXISTS (SELECT 1 FROM j WHERE list_has_all(j.people, c.people)) AS inside
FROM c WHERE id % 5 < 4 AND NOT EXISTS (SELECT 1 FROM j WHERE list_sort(j.people) = list_sort(c.people))
"""


#: What proposals derived from the acts say besides the name, and how they explain themselves; # stands for the act, ## for the next one.
SAID = ("nulla", "non presente (e' il neonato)", "—", "Donna @", "@ oppure Rosa", "@ [?]", "@", "@ Di Mar Lella Tilli", "  ", "in bianco", "@ Rosa")
BECAUSE = ("si legge bene", "fine dell'atto precedente", "come nell'atto n. #", "come nell'atto n. ##", "alla pagina seguente", "atto numero sette", "l'atto # seguente", "")


def vetoed_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proposed readings of all rows of the acts: whether they are readings, have the form of a name, and look at another act."""
    rows = mentions(spark, sf_dir).select("id", "act", "name")
    value = F.replace(pick(SAID, F.col("id")), F.lit("@"), F.coalesce("name", F.lit("")))
    act = F.col("act").cast("string")
    because = F.replace(F.replace(pick(BECAUSE, F.floor(F.col("id") / 11)), F.lit("##"), (F.col("act") + 1).cast("string")), F.lit("#"), act)
    judged = rows.select("id", value.alias("value"), because.alias("because"), "act")
    return judged.select("id", "value", is_reading(F.col("value")).alias("reading"), name_shaped(F.col("value")).alias("name_shaped"), looks_elsewhere(F.col("because"), F.col("act"), act_number).alias("elsewhere"))


VETOED_READINGS = f"""WITH {_VILLAGE}, p AS (SELECT id, act, replace({pick_sql(tuple(s.replace("'", "''") for s in SAID), "id")}, '@', coalesce(name, '')) AS value, replace(replace({pick_sql(tuple(s.replace("'", "''") for s in BECAUSE), "id // 11")}, '##', CAST(act + 1 AS VARCHAR)), '#', CAST(act AS VARCHAR)) AS because FROM m)
SELECT id, value, trim(value) <> '' AND NOT regexp_matches(value, {quoted(ABSENT.replace("(?iu)", "(?i)"))}) AS reading,
  NOT regexp_matches(value, {quoted(NO_NAME.replace("(?iu)", "(?i)"))}) AND NOT regexp_matches(trim(value), {quoted(HONOURS.replace("(?iu)", "(?i)"))}) AND len(list_filter(string_split_regex(trim(value), '\\s+'), lambda w: w <> '')) BETWEEN 1 AND 3 AS name_shaped,
  regexp_matches(because, {quoted(ELSEWHERE.replace("(?iu)", "(?i)"))}) OR len(list_filter(regexp_extract_all(because, {quoted(ACT_NAMED.replace("(?iu)", "(?i)"))}, 1), lambda x: coalesce(coalesce(TRY_CAST(x AS BIGINT), CASE x WHEN 'sette' THEN 7 END) <> act, false))) > 0 AS elsewhere FROM p"""

QUERIES = {
    "stored_search": (stored_search, STORED_SEARCH),
    "late_decisions": (late_decisions, LATE_DECISIONS),
    "arbiter_cases": (arbiter_cases, ARBITER_CASES),
    "vetoed_readings": (vetoed_readings, VETOED_READINGS),
    "index_disagreement": (index_disagreement, INDEX_DISAGREEMENT),
    "glossary_audit": (glossary_audit, GLOSSARY_AUDIT),
    "prefix_search": (prefix_search, PREFIX_SEARCH),
}

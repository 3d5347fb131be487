"""Pages, acts, relations, decisions and streams, over records derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinweave.functions.weights import age, number_words
from kinweave.operators.context import marriage_parents, stitch
from kinweave.operators.decisions import latest
from kinweave.sources import pages as page_source
from kinweave.sources.tables import table
from kinweave.streaming import events as stream


def ingested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations written as page documents and read back: acts and people of each, by role."""
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    person = lambda t: F.struct(t["role"].alias("ruolo"), F.element_at(F.split(t["text"], " "), 1).alias("nome"), F.concat(t["role"], F.lit(" [?]")).alias("cognome"))
    act = F.transform("turns", lambda t: F.struct(t["turn"].cast("string").alias("numero_atto"), t["role"].alias("tipo"), F.lit("1 maggio 1843").alias("data_atto"), t["text"].alias("testo_integrale"), F.array(person(t)).alias("persone")))
    origin = F.struct(F.concat(F.lit("a\\b\\"), F.col("conv_id").cast("string")).alias("immagine"), F.lit("r").alias("registro"), F.lit(1840).alias("anno"))
    texts = turns.select("conv_id", F.to_json(F.struct(F.lit("atti").alias("tipo_pagina"), act.alias("atti"), origin.alias("_origine"))).alias("json"))
    acts = page_source.acts(page_source.parse_pages(texts, "json"), "conv_id")
    people = page_source.people(acts, "conv_id")
    rows = acts.select("conv_id", "place", "tipo", "anno", "immagine").join(people.select("conv_id", "place", "cognome", "incerto"), ["conv_id", "place"])
    return rows.groupBy("conv_id", "immagine", "anno", "tipo", "cognome", "incerto").agg(F.count("*").alias("n"))


INGESTED_PAGES = "SELECT conv_id, 'a/b/' || conv_id AS immagine, 1843 AS anno, role AS tipo, role AS cognome, true AS incerto, count(*) AS n FROM conversations GROUP BY conv_id, role"


def _marriages(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.when(F.col("l_returnflag") == "N", F.when(F.col("l_linestatus") == "O", "groom").otherwise("bride")).otherwise(F.when(F.col("l_linestatus") == "O", "father").otherwise("mother"))
    order = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    surname = F.concat(F.lit("name"), F.translate((F.col("l_suppkey") % 4).cast("string"), "0123", "bcdf"))
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("act"), order.alias("row"), role.alias("role"), F.lit("x").alias("name"), surname.alias("surname"))


def marriage_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as rows of a marriage: which spouse each parent belongs to."""
    return marriage_parents(_marriages(spark, sf_dir))


MARRIAGE_ATTRIBUTION = """
WITH r AS (SELECT l_orderkey AS act, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS row,
  CASE WHEN l_returnflag = 'N' THEN CASE WHEN l_linestatus = 'O' THEN 'groom' ELSE 'bride' END ELSE CASE WHEN l_linestatus = 'O' THEN 'father' ELSE 'mother' END END AS role, l_suppkey % 4 AS key FROM lineitem),
k AS (SELECT *, last_value(CASE WHEN role IN ('groom', 'bride') THEN row END IGNORE NULLS) OVER u AS last_spouse, min(CASE WHEN role IN ('father', 'mother') THEN row END) OVER a AS first_parent,
  min(CASE WHEN role IN ('groom', 'bride') THEN row END) OVER a AS s1, max(CASE WHEN role IN ('groom', 'bride') THEN row END) OVER a AS s2,
  count(*) FILTER (role IN ('father', 'mother')) OVER a AS parents, count(*) FILTER (role IN ('father', 'mother')) OVER u AS nth
  FROM r WINDOW a AS (PARTITION BY act), u AS (PARTITION BY act ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
m AS (SELECT *, max(CASE WHEN row = s1 THEN key END) OVER (PARTITION BY act) AS k1, max(CASE WHEN row = s2 THEN key END) OVER (PARTITION BY act) AS k2,
  CASE WHEN s2 < first_parent THEN CASE WHEN nth * 2 <= parents THEN s1 ELSE s2 END ELSE last_spouse END AS placed FROM k),
f AS (SELECT *, CASE WHEN role = 'father' THEN coalesce(CASE WHEN k1 <> k2 THEN CASE WHEN key = k1 THEN s1 WHEN key = k2 THEN s2 END END, placed) END AS fs FROM m),
g AS (SELECT *, last_value(CASE WHEN role = 'father' THEN fs END IGNORE NULLS) OVER u AS before, last_value(CASE WHEN role = 'father' THEN row END IGNORE NULLS) OVER u AS before_row
  FROM f WINDOW u AS (PARTITION BY act ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT act, row, role, coalesce(fs, CASE WHEN before_row > coalesce(last_spouse, -1) THEN before END, placed) AS spouse_row FROM g WHERE role IN ('father', 'mother')
"""


def stitched_acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as acts, those of the assistant without a number: parts put together."""
    turns = table(spark, sf_dir, "conversations")
    acts = turns.select(
        F.col("conv_id").alias("register"), F.lit("act").alias("type"), F.floor(F.col("turn") / 2).cast("int").alias("page"), F.col("turn").cast("int").alias("place"),
        F.when(F.col("role") != "assistant", F.col("turn").cast("string")).alias("number"), "text",
    )
    done = stitch(acts)
    return done.select(F.col("register").alias("conv_id"), "page", "number", "parts", F.md5(F.col("text").cast("binary")).alias("digest"))


def decisions_in_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as decisions on a customer's fields, an urgent one undoing the order before it: what holds."""
    orders = table(spark, sf_dir, "orders")
    log = orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("subject"), F.col("o_orderstatus").alias("field"), F.col("o_totalprice").alias("value"),
        F.when(F.col("o_orderpriority").like("1%"), F.col("o_orderkey") - 1).alias("undoes"),
    )
    return latest(log)


DECISIONS_IN_FORCE = """
WITH d AS (SELECT *, CASE WHEN o_orderpriority LIKE '1%' THEN o_orderkey - 1 END AS undoes FROM orders)
SELECT o_custkey AS subject, o_orderstatus AS field, arg_max(o_totalprice, o_orderkey) AS value, max(o_orderkey) AS id FROM d
WHERE undoes IS NULL AND o_orderkey NOT IN (SELECT undoes FROM d WHERE undoes IS NOT NULL) GROUP BY ALL
"""


def ages_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part sizes written out as Italian ages and read back, by form of writing."""
    words = F.broadcast(spark.createDataFrame([(v, w) for w, v in number_words().items() if v <= 60 and w not in ("cento",)], "p_size int, word string"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size").join(words, "p_size")
    kind = F.pmod("p_partkey", F.lit(4))
    text = F.when(kind == 0, F.concat("word", F.lit(" anni"))).when(kind == 1, F.concat("word", F.lit(" circa"))).when(kind == 2, F.concat(F.lit("mesi "), "word")).otherwise(F.concat(F.col("p_size").cast("string"), F.lit(" giorni")))
    read = parts.select(kind.cast("int").alias("kind"), age(text).alias("a"))
    return read.groupBy("kind").agg(F.count("*").alias("n"), F.round(F.sum("a.years"), 3).alias("years"), F.count_if(F.col("a.approximate")).alias("approximate"))


AGES_READ = """
SELECT CAST(p_partkey % 4 AS INT) AS kind, count(*) AS n, round(sum(p_size * CASE p_partkey % 4 WHEN 2 THEN 1 / 12 WHEN 3 THEN 1 / 365 ELSE 1 END), 3) AS years,
  count(*) FILTER (p_partkey % 4 = 1) AS approximate FROM part WHERE p_size BETWEEN 0 AND 60 GROUP BY 1
"""


def streamed_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by hour and kind, as a stream."""
    done = stream.run_to_table(stream.hourly(stream.event_stream(spark, f"{sf_dir}/events.parquet")), "complete", "hours")
    return done.select(F.unix_timestamp("hour").alias("hour"), "event_type", "n", F.col("total").cast("double").alias("total"))


STREAMED_HOURS = """
SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS hour, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM events GROUP BY 1, 2
"""


def streamed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each user, as a stream."""
    done = stream.run_to_table(stream.sessions(stream.event_stream(spark, f"{sf_dir}/events.parquet")), "complete", "sessions")
    return done.select("user_id", F.unix_micros("begin").alias("begin"), "n")


STREAMED_SESSIONS = """
WITH m AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) < 1800000000 THEN 0 ELSE 1 END AS new FROM events),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM m)
SELECT user_id, epoch_us(min(ts)) AS begin, count(*) AS n FROM r GROUP BY user_id, s
"""


QUERIES = {
    "ingested_pages": (ingested_pages, INGESTED_PAGES),
    "marriage_attribution": (marriage_attribution, MARRIAGE_ATTRIBUTION),
    "stitched_acts": (stitched_acts, None),
    "decisions_in_force": (decisions_in_force, DECISIONS_IN_FORCE),
    "ages_read": (ages_read, AGES_READ),
    "streamed_hours": (streamed_hours, STREAMED_HOURS),
    "streamed_sessions": (streamed_sessions, STREAMED_SESSIONS),
}

"""Facts out of mentions, events read twice, and clusters that cannot be one person."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Formulae for a parent who is not known.
UNKNOWN_PARENT = r"(?i)\b(ignot[oi]|genitori incerti|padre incerto|madre incerta|proiett[oa]|espost[oa])\b"


def not_a_person(name: Column) -> Column:
    """Whether a cell holds a formula for an unknown parent, or nothing."""
    return F.coalesce(name.rlike(UNKNOWN_PARENT) | (F.trim(name) == ""), F.lit(True))


def facts(mentions: DataFrame, key: str, fields: list[str], uncertain: str) -> DataFrame:
    """One row a field that is filled: ``key, field, raw, value, confidence`` (.7 where the reading is uncertain, else .95)."""
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("raw")) for f in fields])).alias("cell")
    rows = mentions.select(key, uncertain, cells).where("cell.raw is not null and trim(cell.raw) <> ''")
    value = F.trim(F.regexp_replace(F.col("cell.raw"), r"\[\?\]|\(\?\)|\?+\s*$", ""))
    return rows.select(key, "cell.field", "cell.raw", value.alias("value"), F.when(F.col(uncertain), 0.7).otherwise(0.95).alias("confidence"))


def same_event(rows: DataFrame, shared: int = 2) -> DataFrame:
    """``a, b, common``: acts of one register, type and year that share ``shared`` signatures.

    ``rows``: ``act, register, type, year, role, name, surname``. A signature is role, name
    and surname in lower case. Signatures are joined inside the act's key, so acts are
    never paired unless they have one in common. A signature that many acts hold is dealt
    to parts, and every part meets every part in a task of its own.
    """
    from kinweave.operators.blocking import meet

    signed = rows.where("name is not null and surname is not null").select("act", "register", "type", "year", F.xxhash64(F.lower("role"), F.lower("name"), F.lower("surname")).alias("s")).distinct()
    pairs = meet(signed, ["register", "type", "year", "s"], "act", distinct=False)
    return pairs.groupBy("a", "b").agg(F.count("*").alias("common")).where(F.col("common") >= shared)


def split_by_span(members: DataFrame, cluster: str, value: str, most: int) -> DataFrame:
    """``members`` with ``part``: a cluster whose values leave a gap of more than ``most`` is cut there.

    Rows without a value stay with the largest part (of equal ones, the first).
    """
    order = Window.partitionBy(cluster).orderBy(value)
    known = members.where(F.col(value).isNotNull())
    cut = known.withColumn("new", F.when(F.col(value) - F.lag(value).over(order) > most, 1).otherwise(0)).withColumn("part", F.sum("new").over(order.rangeBetween(Window.unboundedPreceding, 0)))
    sizes = cut.groupBy(cluster, "part").agg(F.count("*").alias("n")).groupBy(cluster).agg(F.max_by("part", F.struct("n", -F.col("part"))).alias("part"))
    rest = members.where(F.col(value).isNull()).join(sizes, cluster, "left").withColumn("part", F.coalesce("part", F.lit(0)))
    return cut.drop("new").unionByName(rest)


def conserved(mentions: DataFrame, entities: DataFrame, mention: str = "mention") -> DataFrame:
    """One row ``mentions, placed, distinct_placed, lost``: every mention must be placed exactly once."""
    lost = mentions.join(entities.select(mention), mention, "left_anti").agg(F.count("*").alias("lost"))
    n = mentions.agg(F.count("*").alias("mentions"))
    placed = entities.agg(F.count("*").alias("placed"), F.count_distinct(mention).alias("distinct_placed"))
    return n.crossJoin(placed).crossJoin(lost)  # one row each

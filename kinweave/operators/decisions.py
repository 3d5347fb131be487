"""The decision log: rows are only added; a decision that undoes another names it.

Columns: ``id, at, action, subject, field, value, decider, undoes``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def in_force(log: DataFrame) -> DataFrame:
    """Decisions that no later one undoes; the undoing rows themselves are left out."""
    undone = log.where("undoes is not null").select(F.col("undoes").alias("id")).distinct()
    return log.where("undoes is null").join(undone, "id", "left_anti")


def latest(log: DataFrame) -> DataFrame:
    """For each subject and field the value of its last decision in force."""
    return in_force(log).groupBy("subject", "field").agg(F.max_by("value", "id").alias("value"), F.max("id").alias("id"))


def add_new(log: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` that are not in the log already: an algorithm's decision is not written twice."""
    keys = ["action", "subject", "field", "value", "decider"]
    same = [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]
    by_algorithm = rows.where("decider = 'algorithm'").dropDuplicates(keys).alias("n").join(log.alias("o"), same, "left_anti")
    return by_algorithm.unionByName(rows.where("decider <> 'algorithm' or decider is null"))


def runs(log: DataFrame, gap_seconds: int = 300) -> DataFrame:
    """``decider, run, first, last, n``: decisions of one decider no more than a gap apart are one run."""
    order = Window.partitionBy("decider").orderBy("at", "id")
    apart = F.unix_timestamp("at") - F.unix_timestamp(F.lag("at").over(order))
    marked = log.withColumn("run", F.sum(F.when(apart <= gap_seconds, 0).otherwise(1)).over(order))
    return marked.groupBy("decider", "run").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("n"))


def reattach(decisions: DataFrame, old: DataFrame, new: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Decisions with ids of a rebuilt table, and the orphans whose row is gone.

    Rows are found again by natural key and by their ordinal among equal keys.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("id"))
    before = old.select(F.col("id").alias("subject"), *keys, place.alias("place"))
    after = new.select(F.col("id").alias("new_id"), *keys, place.alias("place"))
    found = decisions.join(before, "subject", "left").join(after, [*keys, "place"], "left").drop(*keys, "place")
    return found.where("new_id is not null").withColumn("subject", F.col("new_id")).drop("new_id"), found.where("new_id is null").drop("new_id")


def concerning(log: DataFrame, entity: int, column: str = "entities") -> DataFrame:
    """Decisions whose JSON list of entities holds this one (5 is not in [15, 25])."""
    return log.where(F.array_contains(F.from_json(column, "array<bigint>"), F.lit(entity)))


def naming(rows: DataFrame, form: str, column: str = "variants") -> DataFrame:
    """Rows whose list of variants, with bars between, holds this form, whatever its case."""
    listed = F.transform(F.split(F.lower(column), r"\s*\|\s*"), lambda x: F.trim(x))
    return rows.where(F.array_contains(listed, form.lower()))


def archived(log: DataFrame, keep: int = 5, gap_seconds: int = 300) -> tuple[DataFrame, DataFrame]:
    """What stays and what may be put away: of an algorithm's decisions those of its last ``keep`` runs stay.

    People's decisions stay, and so does whatever a decision that stays undoes.
    """
    order = Window.partitionBy("decider").orderBy("at", "id")
    apart = F.unix_timestamp("at") - F.unix_timestamp(F.lag("at").over(order))
    marked = log.withColumn("run", F.sum(F.when(apart <= gap_seconds, 0).otherwise(1)).over(order))
    last = marked.groupBy("decider").agg(F.max("run").alias("last_run"))
    old = F.coalesce((F.col("decider") == "algorithm") & (F.col("run") <= F.col("last_run") - keep), F.lit(False))
    judged = marked.join(last, "decider").withColumn("old", old)
    needed = judged.where("not old and undoes is not null").select(F.col("undoes").alias("id")).distinct().withColumn("needed", F.lit(True))
    judged = judged.join(needed, "id", "left").withColumn("gone", F.col("old") & F.col("needed").isNull())
    return judged.where("not gone").select(*log.columns), judged.where("gone").select(*log.columns)


def undo(log: DataFrame, ids: DataFrame, decider: str) -> DataFrame:
    """Rows to add that undo the decisions in force among ``ids``: the opposite action, naming what it undoes."""
    opposite = F.when(F.col("action") == "merge", "separate").when(F.col("action") == "separate", "merge").otherwise(F.concat(F.lit("undo "), F.col("action")))
    return in_force(log).join(ids.select("id").distinct(), "id", "left_semi").select(opposite.alias("action"), "subject", "field", F.lit(None).cast("string").alias("value"), F.lit(decider).alias("decider"), F.col("id").alias("undoes"))


def recheck(corrections: DataFrame, forms: DataFrame, refused: DataFrame, version: str) -> DataFrame:
    """``id, old, new, finding``: old corrections held against what is known today.

    ``corrections``: ``id, act, old, new, version``; ``forms``: ``form, n``; ``refused``: ``act`` whose
    proposals came from a neighbour. Findings: ``copied`` (the act is refused), ``unattested``
    (a new form that nobody wrote in place of one written three times), ``old version`` (to be asked again).
    """
    n = lambda c, out: forms.select(F.col("form").alias(c), F.col("n").alias(out))
    seen = corrections.join(n("old", "old_n"), "old", "left").join(n("new", "new_n"), "new", "left").join(refused.select("act").distinct().withColumn("bad", F.lit(True)), "act", "left")
    finding = F.when(F.col("bad"), "copied").when((F.coalesce("new_n", F.lit(0)) == 0) & (F.coalesce("old_n", F.lit(0)) >= 3), "unattested").when(~F.col("version").eqNullSafe(version), "old version")
    return seen.withColumn("finding", finding).where("finding is not null").select("id", "old", "new", "finding")


def for_review(corrections: DataFrame) -> DataFrame:
    """Corrections in the order they are looked at: confirmed first, then those whose premise holds, likely slips, filled gaps, the most alike.

    ``corrections``: ``id, old, new, read_now, confirmed, similarity``. The premise is that the
    record still reads what was corrected.
    """
    premise = F.col("read_now").eqNullSafe(F.col("old"))
    slip = F.coalesce(F.col("similarity") >= 0.8, F.lit(False))
    rows = corrections.withColumns({"premise": premise, "slip": slip, "fills": F.col("old").isNull()})
    return rows.orderBy(F.desc("confirmed"), F.desc("premise"), F.desc("slip"), F.desc("fills"), F.desc_nulls_last("similarity"), "id")


def retried(orphans: DataFrame, new: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Orphans whose natural key has come back, with its id, and those that wait on; at every rebuild, or in each micro-batch."""
    found = orphans.join(new.groupBy(*keys).agg(F.min("id").alias("new_id")), keys, "left")
    return found.where("new_id is not null").withColumn("subject", F.col("new_id")).drop("new_id"), found.where("new_id is null").drop("new_id")

"""Resolving mentions into entities: rounds of mutually best merges under vetoes.

A round scores the candidate pairs of clusters, keeps those that nothing forbids, and
merges the pairs in which each is the other's best by a margin. Such pairs do not
overlap, so a round is a few joins; every merge is a row of the decision log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinweave.session import materialise


def mutual_best(scored: DataFrame, threshold: float, margin: float) -> DataFrame:
    """``a, b, logit`` of the pairs in which each is the other's best, by ``margin`` over the next.

    Without a margin the next does not count, and each one's best is gathered where its pairs
    are found, so that only the best of a task are shuffled.
    """
    ok = scored.where(F.col("logit") >= threshold).select("a", "b", "logit")
    if margin <= 0:
        # Of equal logits the smallest pair; read from both ends without doubling the pairs' rows in a shuffle.
        sides = ok.select("logit", "a", "b", F.explode(F.array("a", "b")).alias("me"))
        first = F.min(F.struct((-F.col("logit")).alias("less"), "a", "b")).alias("first")
        held = sides.groupBy("me").agg(first).select("first.a", "first.b", (-F.col("first.less")).alias("logit"))
        return held.groupBy("a", "b").agg(F.count("*").alias("ends"), F.max("logit").alias("logit")).where("ends = 2").drop("ends")
    sides = ok.select(F.col("a").alias("me"), F.col("b").alias("you"), "logit").unionByName(ok.select(F.col("b").alias("me"), F.col("a").alias("you"), "logit"))
    order = Window.partitionBy("me").orderBy(F.desc("logit"), F.least("me", "you"), F.greatest("me", "you"))
    ranked = sides.withColumns({"place": F.row_number().over(order), "next": F.lead("logit").over(order)})
    best = ranked.where((F.col("place") == 1) & (F.col("next").isNull() | (F.col("logit") - F.col("next") >= margin)))
    back = best.select(F.col("me").alias("you"), F.col("you").alias("me"))
    return best.join(back, ["me", "you"], "left_semi").where("me < you").select(F.col("me").alias("a"), F.col("you").alias("b"), "logit")


def resolve(
    mentions: DataFrame,
    describe: Callable[[DataFrame], DataFrame],
    score: Callable[[DataFrame], DataFrame],
    *,
    threshold: float,
    margin: float = 0.0,
    rounds: int = 12,
) -> tuple[DataFrame, DataFrame]:
    """``(mention, entity)`` and the log ``(round, kept, merged, logit)``.

    ``mentions`` has a column ``mention``. ``describe`` turns mentions with their ``entity``
    into one row an entity; ``score`` turns those into candidate pairs ``a < b, logit``
    that nothing forbids. An entity is named by its smallest mention.
    """
    held = materialise(mentions.withColumn("entity", F.col("mention")), "resolve")
    log = None
    for n in range(1, rounds + 1):
        merges = materialise(mutual_best(score(describe(held)), threshold, margin), "merges")
        if not merges.limit(1).count():
            break
        moved = merges.select(F.col("b").alias("entity"), F.col("a").alias("into"))
        held = materialise(held.join(moved, "entity", "left").withColumn("entity", F.coalesce("into", "entity")).drop("into"), "resolve")
        rows = merges.select(F.lit(n).alias("round"), F.col("a").alias("kept"), F.col("b").alias("merged"), "logit")
        log = rows if log is None else log.unionByName(rows)
    empty = mentions.limit(0).select(F.lit(0).alias("round"), F.col("mention").alias("kept"), F.col("mention").alias("merged"), F.lit(0.0).alias("logit"))
    return held.select("mention", "entity"), empty if log is None else log

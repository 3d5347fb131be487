"""Buckets of about equally many rows, in the order of a number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bounds(df: DataFrame, key: str, buckets: int) -> list[int]:
    """At most ``buckets - 1`` rising values that cut ``df`` at approximate quantiles of ``key`` (long); none for one bucket or no rows."""
    if buckets <= 1:
        return []
    shares = [i / buckets for i in range(1, buckets)]
    found = df.agg(F.percentile_approx(key, shares, max(10_000, 10 * buckets))).first()[0]
    return sorted(set(found or []))


def bucket(value: Column, cuts: list[int]) -> Column:
    """The number of ``cuts`` not above ``value``, by halving; 0 without cuts."""
    if not cuts:
        return F.lit(0)
    held = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        above = F.get(held, middle) <= value
        lo = F.when((s["lo"] < s["hi"]) & above, middle + 1).otherwise(s["lo"])
        hi = F.when((s["lo"] < s["hi"]) & ~above, middle).otherwise(s["hi"])
        return F.struct(lo.alias("lo"), hi.alias("hi"))

    steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length()))
    return F.aggregate(steps, start, halve, lambda s: s["lo"])

"""Spelling variants: which forms are one name, and which of them stands for it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.functions.text import canonical, normal
from kinweave.operators.graph import connected_components


def variant_targets(forms: DataFrame, pairs: DataFrame) -> DataFrame:
    """``form, n, target, target_n, similarity, accepted`` of each form with a better attested neighbour.

    ``forms``: ``form, n``; ``pairs``: ``a, b, similarity`` with ``a < b``. The target is the
    most similar form that is commoner (of equal counts, the earlier one); forms are joined by
    shuffles, since a table small on disk is large in the driver's memory. It is accepted
    without a question if no other target is as similar and the two are the same without
    spaces or in canonical form, or similarity and dominance reach (.85, 4) or (.92, 3).
    """
    sides = pairs.select("a", "b", "similarity").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "similarity"))
    seen = (
        sides.hint("merge").join(forms.select(F.col("form").alias("a"), F.col("n").alias("n")), "a")
        .hint("merge").join(forms.select(F.col("form").alias("b"), F.col("n").alias("m")), "b")
        .where((F.col("m") > F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("b") < F.col("a"))))
    )
    best = seen.groupBy("a", "n").agg(F.max("similarity").alias("similarity"), F.min_by(F.struct("b", "m"), F.struct(-F.col("similarity"), "b")).alias("t"))
    ties = seen.hint("merge").join(best.select("a", F.col("similarity").alias("top")), "a").where("similarity = top").groupBy("a").agg(F.count("*").alias("ties"))
    bare = lambda c: F.regexp_replace(normal(c), " ", "")
    form, target, share = F.col("a"), F.col("t.b"), F.col("t.m") / F.col("n")
    same = (bare(form) == bare(target)) | (canonical(form) == canonical(target))
    strong = ((F.col("similarity") >= 0.85) & (share >= 4)) | ((F.col("similarity") >= 0.92) & (share >= 3))
    return best.hint("merge").join(ties, "a").select(
        form.alias("form"), "n", target.alias("target"), F.col("t.m").alias("target_n"), "similarity", ((F.col("ties") == 1) & (same | strong)).alias("accepted")
    )


def variant_groups(forms: DataFrame, pairs: DataFrame) -> DataFrame:
    """``form, n, group``: forms joined by similarity or by one canonical form; the group is its first form."""
    keyed = forms.select("form", canonical(F.col("form")).alias("key"))
    firsts = keyed.groupBy("key").agg(F.min("form").alias("first"))
    same = keyed.hint("merge").join(firsts, "key").where("form <> first").select(F.col("first").alias("a"), F.col("form").alias("b"))
    found = connected_components(pairs.select("a", "b").unionByName(same))
    return forms.hint("merge").join(found, forms.form == found.node, "left").select("form", "n", F.coalesce("component", "form").alias("group"))

"""Folds and bounded samples of labelled documents, shared by the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_col: Column) -> Column:
    """Whether crc32 of the id as text leaves 0 by 5; a null id is never held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(labels: DataFrame, label: str, per_class: int, seed: int, id_col: str = "doc_id") -> DataFrame:
    """``id, label`` of at most ``per_class`` labelled ids of each class, none held out.

    The choice follows a seeded hash of the id, so it is the same at every run. Null ids
    and labels other than 0 and 1 are left out; an id with both labels is left out too.
    """
    rows = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    one = rows.groupBy(F.col(id_col).alias("id")).agg(F.min(label).alias("label"), F.max(label).alias("most")).where("label = most")
    order = [F.xxhash64(F.lit(seed), "id"), F.col("id")]
    parts = [one.where(F.col("label") == v).orderBy(*order).limit(per_class).select("id", F.col("label").cast("int").alias("label")) for v in (0, 1)]
    return parts[0].unionByName(parts[1])

"""Table readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def glossary(spark: SparkSession, entries: dict[str, list[str]]) -> DataFrame:
    """``form, target`` of a glossary that lists under each right form its wrong ones; a right form is its own.

    A wrong form listed twice goes to the right form that comes first.
    """
    rows: dict[str, str] = {right: right for right in entries}
    for right in sorted(entries):
        for wrong in entries[right]:
            rows.setdefault(wrong, right)
    return spark.createDataFrame(sorted(rows.items()), "form string, target string")


def attach(spark: SparkSession, path: str, names: list[str], prefix: str = "") -> None:
    """The Parquet tables of a folder as views, so that two archives can be asked side by side."""
    for name in names:
        spark.read.parquet(f"{path}/{name}").createOrReplaceTempView(prefix + name)

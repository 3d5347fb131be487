"""Where results go: CSV for spreadsheets, proposals for review, keyed caches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BOM = "﻿"


def write_csv(df: DataFrame, path: str, separator: str = ";") -> None:
    """One folder of CSV files with a header, each with a byte order mark on its first name.

    Spreadsheets read UTF-8 by that mark; Spark writes one header a file, so the mark is
    part of the first column's name.
    """
    named = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    named.write.option("sep", separator).option("header", True).option("encoding", "UTF-8").mode("overwrite").csv(path)


def proposals(corrections: DataFrame) -> DataFrame:
    """``target, forms``: the forms proposed for each target, commonest first, as one review entry.

    ``corrections``: ``form, n, target``.
    """
    listed = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "form")))
    return corrections.groupBy("target").agg(F.transform(listed, lambda x: x["form"]).alias("forms"), F.sum("n").alias("n"))


def fingerprint(df: DataFrame, *columns: str) -> str:
    """A digest of a table that does not depend on row order: count and sums of row hashes."""
    row = F.xxhash64(*(columns or df.columns))
    stat = df.agg(F.count("*").alias("n"), F.sum(row.cast("decimal(38,0)")).alias("s"), F.bit_xor(row).alias("x")).first()
    return f"{stat.n}-{stat.s}-{stat.x}"


def cached(spark: SparkSession, folder: str, key: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The Parquet table kept under a key, built and written if it is not there."""
    path = f"{folder}/{key}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def append_new(existing: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` whose keys the existing table lacks; of equal keys among them one stays. Nulls are equal."""
    same: list[Column] = [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]
    return rows.dropDuplicates(keys).alias("n").join(existing.alias("o"), same, "left_anti")


def rewrite_tables(tables: dict[str, DataFrame], path: str) -> None:
    """The tables of a rebuild, each written anew under ``path``."""
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{path}/{name}")


def markdown(title: str, sections: dict[str, DataFrame], most: int = 50) -> str:
    """A report of small tables: the first ``most`` rows of each, and how many there are."""
    lines = [f"# {title}", ""]
    for name, rows in sections.items():
        held = rows.limit(most + 1).collect()
        lines += [f"## {name}", "", "| " + " | ".join(rows.columns) + " |", "|" + "---|" * len(rows.columns)]
        lines += ["| " + " | ".join("" if v is None else str(v).replace("|", r"\|") for v in r) + " |" for r in held[:most]]
        lines += ["", f"The first {most} of {rows.count()}.", ""] if len(held) > most else [""]
    return "\n".join(lines)

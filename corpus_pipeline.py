"""The corpus pipeline: quality, toxicity, near duplicates, mixing, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns of
``documents``. Null texts count as empty; null ids, repeated rows, empty tables and extra
columns are treated as each operator states. This module belongs to ``kinweave.llm`` and cannot be imported
without it; ``__spark_entry__.py`` alone looks whether both are there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinweave.llm import bpe, minhash, mixing, quality, toxicity
from kinweave.llm.queries import BPE_FILE, table, tokenizer_path
from kinweave.session import working_dir


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the cut."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where("predicted = 1").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below their language's threshold of toxicity."""
    net = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, net).where("predicted = 0").select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five words, similarity 0.8.

    Rows without an id stay. Of rows that repeat id and text one stays, the first by its
    other columns. Where an id has several texts, the first of them takes part in the
    comparison and the others stay as they are, so no text is lost.
    """
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count()
    others: DataFrame | None = None
    if repeated:
        plain = F.to_json(F.struct(*[c for c in docs.columns if c not in ("doc_id", "text")]))
        same, of_id = Window.partitionBy("doc_id", "text").orderBy(plain), Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last())
        once = docs.where("doc_id is not null").withColumn("kw_copy", F.row_number().over(same)).where("kw_copy = 1").withColumn("kw_text", F.row_number().over(of_id))
        others = once.where("kw_text > 1").select(*docs.columns)
        docs = once.where("kw_text = 1").select(*docs.columns).unionByName(docs.where("doc_id is null"))
    found = minhash.near_duplicates(docs, width=5, percent=80)
    gone = found.where("not kept").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    return kept if others is None else kept.unionByName(others)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeat_rows(mixing.mix(docs), docs.columns)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document's whole text, beside the columns that name it."""
    keep = [c for c in docs.columns if c != "text"]
    coded = bpe.encode(docs, bpe.load_ranks(tokenizer_path(BPE_FILE)), columns=keep)
    return coded.withColumn("n_tokens", F.size("token_ids"))


STAGES = [
    ("quality", keep_good),
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_each),
    ("mixing", mix_sources),
    ("tokens", to_tokens),
]

#: SQL can express neither the classifiers nor BPE; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    base = f"{working_dir(spark)}/kinweave/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs

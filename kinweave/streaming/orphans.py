"""Decisions whose record has not come yet: they wait, over micro-batches, for their natural key.

Each batch writes three small tables of its own under ``base``: the records it brought
(``known``), the decisions (``asked``) and what could be attached (``attached``), dealt into
buckets of the key. Only what is new is written, and what is new is joined with what is
there of its buckets; a key held by very many records is one row of a batch. A batch that
is run again overwrites its own folders and reads none that came after, so nothing is
attached twice or lost when the driver or an executor goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

BUCKETS = 64


def _merge(batch: DataFrame, n: int, keys: list[str], base: str) -> None:
    spark = batch.sparkSession
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    came = batch.where(F.col("id").isNotNull()).withColumn("bucket", bucket)
    rows = came.where((F.col("kind") == "row") & whole).groupBy("bucket", *keys).agg(F.min("id").alias("subject"))
    decisions = came.where("kind = 'decision'").select("bucket", *keys, "id").distinct()

    def stored(name: str, frame: DataFrame) -> DataFrame:
        frame.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{base}/{name}/batch={n}")
        # A batch without rows leaves an empty folder; the schema is said, so that it reads as an empty table.
        schema = StructType([f for f in frame.schema.fields if f.name != "bucket"]).add("batch", LongType()).add("bucket", IntegerType())
        return spark.read.schema(schema).parquet(f"{base}/{name}").where(F.col("batch") <= n)

    known, asked = stored("known", rows), stored("asked", decisions)
    on = ["bucket", *keys]
    new_asked, new_known = asked.where(F.col("batch") == n).drop("batch"), known.where(F.col("batch") == n).drop("batch")
    late = asked.where(F.col("batch") < n).drop("batch").join(new_known, on)
    prompt = new_asked.join(known.drop("batch").groupBy(*on).agg(F.min("subject").alias("subject")), on)
    found = late.select("bucket", "id", "subject").unionByName(prompt.select("bucket", "id", "subject"))
    stored("attached", found.groupBy("bucket", "id").agg(F.min("subject").alias("subject")))


def run_attaching(stream: DataFrame, keys: list[str], base: str) -> DataFrame:
    """``id, subject`` of every decision that came, in this run or an earlier one with the same ``base``; a decision still waiting has no subject.

    ``stream``: ``kind`` ("row" or "decision"), ``id`` and the key columns. A decision goes to
    the least id among the records of its key, whichever came first; one with a null in its
    key waits for ever. Repeated records and decisions do no harm.
    """
    spark: SparkSession = stream.sparkSession
    stream.writeStream.option("checkpointLocation", f"{base}/state").foreachBatch(lambda batch, n: _merge(batch, n, keys, base)).trigger(availableNow=True).start().awaitTermination()
    kind = stream.schema["id"].dataType
    read = lambda name, *c: spark.read.schema(StructType([stream.schema[k] for k in c if k != "subject"]).add("subject", kind) if "subject" in c else StructType([stream.schema[k] for k in c])).parquet(f"{base}/{name}")
    attached = read("attached", "id", "subject").groupBy("id").agg(F.min("subject").alias("subject"))
    return read("asked", "id").select("id").distinct().join(attached, "id", "left")

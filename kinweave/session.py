"""Session factory and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "kinweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects: AQE on, UTC, Arrow."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    return builder.config(map=settings).getOrCreate()


def working_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; in a local session without it, as in tests, one of its own.

    On a cluster the folder must be set: a local one would be seen by one machine only.
    """
    set_by_cluster = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if set_by_cluster:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(set_by_cluster)
        return set_by_cluster
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = tempfile.mkdtemp(prefix="kinweave-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the lineage ends there."""
    spark = df.sparkSession
    path = f"{working_dir(spark)}/kinweave/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def gathered(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """All rows of ``parts``, tables of one schema: each is worked out by itself and added to one table in the shared folder.

    A union of many parts is one plan, and all that it sends through the driver stays there until
    its last part is done; here a part's plan is gone before the next begins.
    """
    path, schema = None, None
    for df in parts:
        if path is None:
            spark, schema = df.sparkSession, df.schema
            path = f"{working_dir(spark)}/kinweave/{name}-{uuid.uuid4().hex}"
        df.write.mode("append").parquet(path)
    if path is None:
        raise ValueError("there are no parts")
    return spark.read.schema(schema).parquet(path)

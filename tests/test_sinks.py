from pyspark.sql import functions as F

from kinweave.sources import sinks


def test_csv_and_proposals(spark, tmp_path):
    df = spark.createDataFrame([("rosi", 2, "rossi"), ("rassi", 5, "rossi"), ("bo", 1, "ba")], "form string, n long, target string")
    sinks.write_csv(df.coalesce(1), f"{tmp_path}/csv")
    text = next((tmp_path / "csv").glob("*.csv")).read_text(encoding="utf-8")
    assert text.startswith("﻿form;n;target\n") and text.count("\n") == 4
    assert {r.target: r.forms for r in sinks.proposals(df).collect()} == {"rossi": ["rassi", "rosi"], "ba": ["bo"]}


def test_keys(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "k int, v string")
    assert sinks.fingerprint(df) == sinks.fingerprint(df.orderBy(F.desc("k"))) != sinks.fingerprint(df.where("k = 1"))
    calls = []
    build = lambda: calls.append(1) or df
    for _ in range(2):
        assert sinks.cached(spark, str(tmp_path), sinks.fingerprint(df), build).count() == 3
    assert len(calls) == 1
    assert [(r.k, r.v) for r in sinks.append_new(df, spark.createDataFrame([(2, None), (3, "c"), (3, "c")], df.schema), ["k", "v"]).collect()] == [(3, "c")]

"""Postings that are stored and decisions that wait, against the plain ways."""

import uuid

from kinweave.operators.review import search, store_postings, stored_search, word_index
from kinweave.streaming.orphans import run_attaching


def test_stored_search(spark, tmp_path):
    docs = [(1, "Maria Giuseppa Lella"), (2, "Mariagiuseppa Lella"), (3, "Giuseppe di Màrio"), (4, ""), (5, None), (6, "maria maria giuseppina"), (7, "x maria giusta")]
    index = word_index(spark.createDataFrame(docs, "id int, t string"), "id", "t")
    boosts = spark.createDataFrame([(i, i, i % 4) for i in range(1, 8)], "id int, mentions int, links int")
    path = str(tmp_path / "p")
    store_postings(index, "id", path)
    for question in ("maria giu", "mar", "lella", "m", "", "nobody", "x", "màrio", "giuseppa maria lella"):
        want, got = search(index, boosts, question, "id"), stored_search(spark, path, boosts, question, "id")
        assert [w.collect() for w in want] == [g.collect() for g in got], question
    plan = stored_search(spark, path, boosts, "lella", "id")[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(head" in plan and "StringStartsWith(word,lella)" in plan


def test_waiting_decisions(spark, tmp_path):
    schema = "kind string, id bigint, house string, year int"
    batches = [
        [("decision", 1, "Lella", 1850), ("decision", 2, "Petta", 1850), ("row", 70, "Petta", 1850), ("decision", 9, None, 1850), ("row", None, "Petta", 1850)],
        [("row", 50, "Lella", 1850), ("row", 40, "Lella", 1850), ("decision", 3, "Tilli", 1850), ("decision", 2, "Petta", 1850)],
        [],
        [("row", 30, "Petta", 1850), ("row", 60, None, 1850), ("decision", 4, "Lella", 1850), ("decision", 5, "Lella", 1851), ("x", 1, "Tilli", 1850)],
    ]
    base = str(tmp_path / uuid.uuid4().hex)
    for rows in batches:  # one run a batch: what is known is kept between runs
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(schema).parquet(f"{base}/in")
        got = {r.id: r.subject for r in run_attaching(stream, ["house", "year"], f"{base}/out").collect()}
        if rows is batches[0]:
            assert got == {1: None, 2: 70, 9: None}
    assert got == {1: 40, 2: 30, 3: None, 4: 40, 5: None, 9: None}

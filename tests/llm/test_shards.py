import os
import tempfile
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinweave.llm import shards


@pytest.mark.parametrize("total", [1, 2, 3, 10, 257, 5000])
def test_feistel_is_a_permutation(total):
    one, two = (shards.feistel(np.arange(total), total, key) for key in (1, 2))
    assert sorted(one) == sorted(two) == list(range(total))
    assert total < 100 or list(one) != list(two)


def folder():
    return f"{tempfile.mkdtemp()}/{uuid.uuid4().hex}"


def test_records(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text.encode() for r in docs.collect()}
    path = folder()
    index = shards.write_shards(docs, path, length=100, records_per_shard=500, key=7).collect()
    total = sum(max(1, -(-len(t) // 100)) for t in texts.values())
    assert len(index) == total and sorted(r.slot for r in index) == sorted(r.place for r in index) == list(range(total))
    records = {r.slot: bytes(r.tokens) for r in shards.read_records(spark, path, length=100, records_per_shard=500).collect()}
    assert sorted(records) == list(range(total))
    rebuilt = {}
    for r in sorted(index, key=lambda r: r["sequence"]):
        assert (r.shard, r.byte_offset) == (r.slot // 500, r.slot % 500 * 101)
        piece = records[r.slot]
        assert len(piece) == 100 and not piece[r.n_tokens :].strip(b"\0")
        rebuilt[r.doc_id] = rebuilt.get(r.doc_id, b"") + piece[: r.n_tokens]
    assert rebuilt == texts
    late = shards.read_records(spark, path, length=100, records_per_shard=500, first_slot=777).collect()
    assert {r.slot: bytes(r.tokens) for r in late} == {s: t for s, t in records.items() if s >= 777}
    # One file a shard, read without Spark.
    files = {r.shard: r.path for r in shards.shard_files(spark, path).collect()}
    assert len(files) == -(-total // 500)
    raw = np.fromfile(files[0].removeprefix("file:"), dtype=np.uint8).reshape(-1, 101)
    assert all(raw[s, :100].tobytes() == records[s] for s in range(500))
    again = shards.write_shards(docs, folder(), length=100, records_per_shard=500, key=7).collect()
    assert {(r.doc_id, r["sequence"], r.slot) for r in again} == {(r.doc_id, r["sequence"], r.slot) for r in index}


def test_odd_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (None, "é\n\0x", 0), (4, "ab", 0), (4, "ab", 0), (5, "long" * 100_000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, slot int").coalesce(2)
    path = folder()
    index = shards.write_shards(df, path, length=64, records_per_shard=1000).collect()
    records = {r.slot: bytes(r.tokens) for r in shards.read_records(spark, path, length=64, records_per_shard=1000).collect()}
    by = {}
    for r in sorted(index, key=lambda r: r["sequence"]):
        by.setdefault(r.doc_id, []).append(records[r.slot][: r.n_tokens])
    assert by[1] == by[2] == [b""] and b"".join(by[None]) == "é\n\0x".encode() and by[4] == [b"ab", b"ab"] and b"".join(by[5]) == b"long" * 100_000
    assert shards.write_shards(df.limit(0), folder()).count() == 0


@pytest.mark.parametrize("width", [2, 4])
def test_token_ids_of_a_vocabulary(spark, width):
    rng = np.random.default_rng(width)
    rows = [(i, rng.integers(0, 256**width // 2, int(n)).tolist(), 1) for i, n in enumerate(rng.integers(0, 40, 60))] + [(None, None, 1), (61, [256**width // 2 - 1] * 16, 1), (61, [1], 1)]
    df = spark.createDataFrame(rows, "doc_id long, token_ids array<int>, shard int").repartition(3)
    df.write.parquet(path_in := folder())
    df = spark.read.parquet(path_in)
    path = folder()
    index = shards.write_shards(df, path, length=16, records_per_shard=10, ids_col="token_ids", width=width).collect()
    read = shards.read_records(spark, path, length=16, records_per_shard=10, width=width)
    records = {r.slot: r.ids for r in read.select("slot", shards.token_ids(F.col("tokens"), width).alias("ids")).collect()}
    assert sorted(records) == list(range(len(index)))
    by = {}
    for r in sorted(index, key=lambda r: (r.place)):
        assert records[r.slot][r.n_tokens :] == [0] * (16 - r.n_tokens)
        by.setdefault(r.doc_id, []).extend(records[r.slot][: r.n_tokens])
    want = {}
    for i, ids, _ in rows:
        want.setdefault(i, []).extend(ids or [])
    assert {k: sorted(v) for k, v in by.items()} == {k: sorted(v) for k, v in want.items()}
    with pytest.raises(Exception):
        shards.write_shards(df.selectExpr("doc_id", "array(-1) as token_ids"), folder(), ids_col="token_ids", width=width)


def test_another_split_of_the_input_is_refused(spark):
    df = spark.range(50).selectExpr("id as doc_id", "repeat('x', cast(id as int) * 9) as text").coalesce(1)
    assert shards.write_shards(df, folder(), length=64, waves=1).count() == sum(max(1, -(-i * 9 // 64)) for i in range(50))

    def other_texts(batches):
        for pdf in batches:
            yield pdf.assign(text=["x" * int.from_bytes(os.urandom(2), "big") for _ in range(len(pdf))]).rename(columns={"id": "doc_id"})

    changing = spark.range(50).mapInPandas(other_texts, "doc_id long, text string")
    with pytest.raises(Exception, match="changed between two readings"):
        shards.write_shards(changing, folder(), length=64)

import math

import numpy as np
from pyspark.sql import functions as F

from kinweave.llm import ann


def brute(rows, asks, k):
    out = {}
    for i, v in rows:
        if asks(i):
            score = [(-float(np.dot(np.float64(v), np.float64(w))), j) for j, w in rows if j != i]
            out[i] = [j for _, j in sorted(score)[:k]], sorted(score)[:k]
    return out


def test_recall_and_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows, lambda i: i % 20 == 0, 20)
    vectors = dict(rows)
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r)
        assert math.isclose(r.score, float(np.dot(np.float64(vectors[r.query_id]), np.float64(vectors[r.vec_id]))), rel_tol=1e-12, abs_tol=1e-12)
    assert got.keys() == want.keys() and all([r.rank for r in v] == list(range(1, 21)) for v in got.values())
    assert all([(-r.score, r.vec_id) for r in v] == sorted((-r.score, r.vec_id) for r in v) for v in got.values())
    found = sum(len({r.vec_id for r in got[q]} & set(want[q][0])) for q in want)
    assert found / (20 * len(want)) >= 0.9


def test_equal_vectors_and_bad_ones(spark):
    rng = np.random.default_rng(2)
    base = [rng.standard_normal(6).astype(np.float32).tolist() for _ in range(5)]
    rows = [(i, base[i % 5] if i < 60 else rng.standard_normal(6).astype(np.float32).tolist()) for i in range(90)]
    bad = [(200, None), (220, [0.0] * 6), (240, [None] + [1.0] * 5), (260, [float("nan")] * 6), (280, [float("inf")] * 6), (None, base[0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + bad + rows[:3]], "vec_id long, embedding array<float>, score string")
    want = brute(rows, lambda i: i % 20 == 0, 8)
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, k=8, recall=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: v[0] for q, v in want.items()}


def test_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert ann.nearest(spark.createDataFrame([], schema), F.lit(True)).count() == 0
    assert ann.nearest(spark.createDataFrame([(0, [1.0, 0.0])], schema), F.lit(True)).count() == 0
    two = ann.nearest(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 2.0])], schema), F.col("vec_id") == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in two] == [(0, 1, 1, 0.5)]
    assert ann.nearest(spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0])], schema), F.col("vec_id") % 20 == 0).count() == 0


def test_doubles_lengths_and_norms(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.standard_normal(rng.integers(1, 7)) * 10.0 ** rng.integers(-3, 4)).tolist()) for i in range(300)]
    rows += [(300, [0.1, 0.2]), (301, [0.3, 0.4]), (302, [1e39, 1.0]), (303, [1e-9, 0.0, 2e-9]), (304, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    pad = [(i, v + [0.0] * (6 - len(v))) for i, v in rows if v]
    want = brute(pad, lambda i: i % 20 == 0, 5)
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, k=5, recall=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for q, (ids, scored) in want.items():
        assert all(math.isclose(s, -w[0], rel_tol=1e-12, abs_tol=1e-12) for (_, s), w in zip(got[q], scored))
    assert sum(len({v for v, _ in got[q]} & set(ids)) for q, (ids, _) in want.items()) >= 0.95 * 5 * len(want)
    pair = ann.nearest(df.where("vec_id in (300, 301)"), F.col("vec_id") == 300).collect()
    assert [(r.vec_id, r.score) for r in pair] == [(301, 0.1 * 0.3 + 0.2 * 0.4)]


def test_queries_whose_cells_hold_too_little_scan_everything(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute(rows, lambda i: i % 20 == 0, 20)
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, width=0.01, recall=0.01).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert {q: set(v[0]) for q, v in want.items()} == got

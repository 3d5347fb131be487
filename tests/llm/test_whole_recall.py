"""Neighbours in far cells are found too."""

import numpy as np
from pyspark.sql import functions as F

from kinweave.llm import ann


def test_one_huge_norm_among_unit_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((800, 24))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    x[0] *= 1000
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 10 == 3).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(3, 800, 10):
        order = [j for j in np.argsort(-(x.astype(float) @ x[q].astype(float)), kind="stable") if j != q][:20]
        assert len(got[q]) == 20
        hits += len(got[q] & set(order))
    assert hits / (20 * 80) >= 0.95


def test_cells_further_than_one_step():
    hashing = ann.Hashing(4, 1.0, 1, 3, 0.2, 1)
    q, v = np.array([[1.0, 0, 0, 0]]), np.array([[-1.0, 0, 0, 0]])
    radius = ann._radius(hashing, q, [v], 1.0)
    assert radius > 3 and ann._within(hashing.project(q, True, 0)[0], 1e9) is None
    p, cell = hashing.project(q, True, 0)[0], np.floor(hashing.project(v, False, 0))[0]
    assert abs(ann._apart(p, cell).sum() - radius) < 1e-6 * radius
    assert [0, 0, 0] in (ann._within(np.full(3, 2.5), 20.0)).tolist()

import math
import re

import pytest

from kinweave.llm import mixing


def slow_fill(sizes, weights, most, budget):
    """Raise all targets together, a little at a time, stopping each at its clamp."""
    low, high = 0.0, budget / min(weights) + 1
    for _ in range(200):
        level = (low + high) / 2
        total = sum(min(most * n, level * w) for n, w in zip(sizes, weights))
        low, high = (level, high) if total < budget else (low, level)
    return [min(most * n, high * w) for n, w in zip(sizes, weights)]


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 100, 1000], [5, 0, 7, 900], [1], [3, 3, 3, 3000]])
def test_water_fill(sizes):
    weights = [i % 3 + 1.0 for i in range(len(sizes))]
    got = mixing.water_fill(sizes, weights, 3, sum(sizes))
    assert got == pytest.approx(slow_fill(sizes, weights, 3, sum(sizes)), rel=1e-6, abs=1e-6)
    assert all(t <= 3 * n + 1e-9 for t, n in zip(got, sizes))


def test_weights_follow_code_points():
    assert mixing.cycle_weights(["b", None, "A", "é", "a"]) == [3.0, 2.0, 1.0, 1.0, 2.0]


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.mix(docs).collect()
    again = {(r.doc_id, r.taken) for r in mixing.mix(docs).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows} and len(rows) == docs.count()
    sizes = {}
    for r in rows:
        assert r["size"] == size(r.text) and r.taken == r["size"] * r.repetitions and r.repetitions <= 3
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    names = sorted(sizes)
    targets = dict(zip(names, mixing.water_fill([sizes[n] for n in names], mixing.cycle_weights(names), 3, sum(sizes.values()))))
    for n in names:
        mine = [r for r in rows if r.source == n]
        assert all(r.source_size == sizes[n] and math.isclose(r.target, targets[n]) for r in mine)
        assert abs(sum(r.taken for r in mine) - targets[n]) <= max(r["size"] for r in mine)


def test_odd_rows(spark):
    rows = [(1, None, "a", 9), (2, "", "a", 9), (3, "x y", None, 9), (3, "x y", None, 9), (None, "z", "b", 9), (5, "w " * 50_000, "b", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    out = mixing.mix(df).collect()
    assert len(out) == 6 and out[0].taken == out[1].taken == 0 and out[0].repetitions == 0
    twins = [r for r in out if r.doc_id == 3]
    assert twins[0].taken == twins[1].taken and {r["size"] for r in twins} == {2}
    assert out[5]["size"] == 50_000
    repeated = mixing.repeat_rows(mixing.mix(df), df.columns)
    assert repeated.columns == df.columns and repeated.count() == sum(r.repetitions for r in out)
    assert mixing.mix(df.limit(0)).count() == 0


def test_equal_rows_come_near_the_target(spark):
    # 50 equal rows of a source whose target is about half its size, beside single rows and equal ones of a few ids.
    rows = [(1, "w " * 100, "a", i % 7) for i in range(50)]
    rows += [(i, "v " * 160, "b", i) for i in range(100, 130)] + [(i, "u " * (10 + i % 3), "c", i) for i in range(200, 240)] * 3
    rows += [(None, "t t t", "d", 0)] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, kw_u int").repartition(6)
    out = mixing.mix(df, lambda names: [3.0, 5.0, 4.0, 0.02]).collect()
    assert len(out) == len(rows) and "kw_u" in out[0].asDict()
    for source in "abcd":
        mine = [r for r in out if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(r["size"] for r in mine), source
        assert 0 < mine[0].target and all(r.taken <= 3 * r["size"] for r in mine)
    again = mixing.mix(df, lambda names: [3.0, 5.0, 4.0, 0.02]).collect()
    key = lambda r: (r.source, r.doc_id or 0, r.taken)
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_the_cut_inside_equal_rows_alone(spark):
    rows = [(1, "w " * 100, "a") for _ in range(50)] + [(2, "v " * 10_000, "b")]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), budget=2667 + 5000, weigh=lambda n: [2667.0, 5000.0]).collect()
    assert sum(r.taken for r in out if r.source == "a") == 2700

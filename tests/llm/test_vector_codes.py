"""Product codes against plain whole-number arithmetic."""

import hashlib
import math
import random

import numpy as np
import pytest

from kinweave.llm import vector_codes
from kinweave.llm.vector_codes import nearest, sequency, walsh


def plain(rows, parts=4, entries=256, rounds=4):
    """``rows`` of (id, vector, label): rows of (id, code, error, label_error) and the digest, by the definition."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    dim = max(1, -(-max((len(r[1]) for r in rows), default=0) // parts)) * parts
    whole = lambda x: int(x) * 1024 if abs(x) >= 2**53 else math.floor(x * 1024)
    vectors = [[whole(x) for x in r[1]] + [0] * (dim - len(r[1])) for r in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, list(rows[i][1])))[:entries]
    w = dim // parts
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[cut(vectors[i], p) for i in order] for p in range(parts)]

    def best(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            of = {}
            for v in vectors:
                of.setdefault(best(cut(v, p), books[p])[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(of[i]) for c in zip(*of[i])] if i in of else e for i, e in enumerate(books[p])]
    out, totals = [], {}
    for r, v in zip(rows, vectors):
        found = [best(cut(v, p), books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        totals[r[2]] = totals.get(r[2], 0) + error
        out.append((r[0], "".join(f"{i:02x}" for _, i in found), error, r[2]))
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return [(i, c, e, totals[lab]) for i, c, e, lab in out], digest


def key(row):
    return tuple((x is None, x) for x in row)


def test_transform_keeps_distances_and_orders_by_sign_changes():
    for width in (1, 2, 4, 8, 16, 32):
        eye = walsh(np.eye(width, dtype=np.int64)).T  # row s: the Walsh function with s sign changes
        assert sorted(sequency(width).tolist()) == list(range(width))
        assert [(np.diff(row) != 0).sum() for row in eye] == list(range(width))
        rng = np.random.default_rng(width)
        x, y = rng.integers(-99, 99, (2, 5, width))
        assert (((walsh(x) - walsh(y)) ** 2).sum(1) == width * ((x - y) ** 2).sum(1)).all()


@pytest.mark.parametrize("kind", [np.int64, object])
def test_nearest_with_ties(kind):
    rng = np.random.default_rng(3)
    for width, spread in ((1, 3), (4, 2), (16, 2), (16, 500), (16, 3)):
        entries = rng.integers(-spread, spread + 1, (60, width))
        x = np.concatenate((rng.integers(-spread, spread + 1, (200, width)), entries + rng.integers(0, 2, entries.shape)))
        far = ((x[:, None] - entries[None]) ** 2).sum(2)
        index, distance = nearest(walsh(x).astype(kind), walsh(entries).astype(kind))
        assert (index.astype(int) == far.argmin(1)).all() and (distance.astype(int) == width * far.min(1)).all()


def test_entries_are_given_up_early(monkeypatch):
    rng = np.random.default_rng(5)
    entries = np.repeat(rng.integers(-1000, 1000, (256, 1)), 16, axis=1)  # all in the first coefficient
    x = entries[rng.integers(0, 256, 500)] + rng.integers(-2, 3, (500, 16))
    seen = []
    carry = vector_codes._carry_on
    monkeypatch.setattr(vector_codes, "_carry_on", lambda *a: seen.append((a[3].mean(), a[5])) or carry(*a))
    index, _ = nearest(walsh(x), walsh(entries))
    assert (index == ((x[:, None] - entries[None]) ** 2).sum(2).argmin(1)).all()
    assert seen[0][0] < 0.05 and seen[0][1] == vector_codes.LOOK_EVERY


def run(spark, rows, kind="array<double>"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding {kind}, label int, code int, error string")
    books = vector_codes.learn(df)
    out = vector_codes.encode(df, books)
    assert out.columns == ["vec_id", "label", "code", "error"]
    return df, books, out.collect()


def test_odd_vectors(spark):
    rng = random.Random(2)
    grid = lambda n: [rng.randint(-3, 3) / 8 for _ in range(n)]
    rows = [(rng.randint(0, 400), grid(8), rng.choice([None, 1, 2])) for _ in range(500)]
    rows += [(None, grid(8), 5)] * 3 + [(7, None, 1), (8, [], 2), (9, [1.0, None] * 4, 1), (10, [math.nan] * 8, 1), (11, [math.inf] + [0.0] * 7, 1), (12, grid(5), None), (-4, [-0.0001] * 8, 3)]
    df, books, out = run(spark, [(*r, 1, "x") for r in rows])
    want, digest = plain(rows)
    assert books.sha256() == digest
    assert sorted(((r.vec_id, r.code, r.error) for r in out), key=key) == sorted((r[:3] for r in want), key=key)
    back = vector_codes.decode(vector_codes.encode(df, books), books).collect()
    assert all(len(r.coded) == 8 for r in back) and len(back) == len(out)


def test_few_equal_and_no_vectors(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0], i) for i in range(5)] + [(3, [9.0, 2.0, 3.0, -4.0], 1)]
    _, books, out = run(spark, [(*r, 1, "x") for r in rows])
    want, digest = plain(rows)
    assert books.sha256() == digest and sorted((r.vec_id, r.code, r.error) for r in out) == sorted(r[:3] for r in want)
    assert {r.code[:6] for r in out} == {"000000"} or len(out) == 6
    empty = [(1, None, 1, 1, "x")]
    _, books, out = run(spark, empty)
    assert books is None and out == []
    _, books, out = run(spark, [(1, [], 1, 1, "x"), (2, [], 1, 1, "x")])
    assert [(r.code, r.error) for r in out] == [("00000000", 0)] * 2


def test_numbers_beyond_64_bits(spark):
    # Far apart, but each vector is an entry of its own: distances pass 64 bits, errors do not.
    rows = [(i, [s * 1e30 * (i + 1), 1e300, 0.3, -7.7], i % 2) for i in range(6) for s in (1, -1)]
    _, books, out = run(spark, [(*r, 1, "x") for r in rows])
    want, digest = plain(rows)
    assert books.dtype is object and books.sha256() == digest
    assert sorted((r.vec_id, r.code, r.error) for r in out) == sorted(r[:3] for r in want)


def test_op11_against_plain_numbers(spark, sf, tmp_path):
    from kinweave.llm.queries import op11_vector_codes

    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").where("vec_id < 330").collect()]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    out = op11_vector_codes(spark, str(tmp_path))
    want, digest = plain(rows)
    got = out.collect()
    assert {r.codebooks_sha256 for r in got} == {digest}
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == sorted(want)
    again = op11_vector_codes(spark, sf)
    assert again.count() == spark.read.parquet(f"{sf}/embeddings.parquet").count()

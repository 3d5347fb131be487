"""Components against brute force, also where one family fills many blocks."""

import random
import string

import numpy as np
import pytest

from kinweave.llm import minhash


def brute(rows, width, percent):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        n = min(width, len(w))
        sets[i] = frozenset(tuple(w[j : j + n]) for j in range(len(w) - n + 1)) if n else frozenset()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                small, large = sorted((len(sets[a]), len(sets[b])))
                if 100 * small >= percent * large:
                    both = len(sets[a] & sets[b])
                    if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                        x, y = root(a), root(b)
                        parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def family(rng, n, words, edits):
    """A text and copies of it with some words changed: few at first, many at last."""
    base = ["".join(rng.choices(string.ascii_lowercase, k=5)) for _ in range(words)]
    out = []
    for i in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(words)] = "".join(rng.choices(string.ascii_lowercase, k=5))
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_documents(spark, sf, width, percent):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, width=width, percent=percent).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], width, percent)


def test_large_families(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = random.Random(4)
    texts = family(rng, 150, 60, 6) + family(rng, 60, 80, 3) + family(rng, 40, 200, 40)
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=3, percent=85).collect()}
    assert got == brute(rows, 3, 85)


def test_odd_rows(spark):
    long_ = " ".join(f"w{i}" for i in range(50_000))
    rows = [
        (5, None, 1), (6, "", 1), (7, " \n", 1), (None, "a b c d", 1), (8, "One Two", 1), (3, "one two", 1), (9, "one", 1), (10, long_, 1), (11, long_ + " x", 1),
        (12, "p q r s t", 1), (12, "p q r s t", 1), (13, "P Q R S T", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    out = minhash.near_duplicates(df, width=3, percent=85)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in out.collect())
    assert got == [
        (0, 2, None, True), (3, 1, 3, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 1, 3, False), (9, 1, 9, True), (10, 49998, 10, True), (11, 49999, 10, False),
        (12, 3, 12, True), (12, 3, 12, True), (13, 3, 12, False),
    ]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_estimate_is_near_the_truth():
    rng = np.random.default_rng(0)
    signer = minhash.Signer(0.85, 11)
    for share in (0.5, 0.7, 0.85, 0.95):
        common = rng.integers(0, 2**63, int(2000 * share), dtype=np.uint64)
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 2**63, (2000 - len(common)) // 2, dtype=np.uint64)])) for _ in range(2))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        sig = [np.frombuffer(signer.pack(signer.minima(s)), dtype=np.uint64)[None] for s in (a, b)]
        assert abs(minhash.estimate(*sig)[0, 0] - true) < 0.15
    assert (1 - 0.85 ** minhash.rows_per_band(0.85)) ** (minhash.PERMUTATIONS // minhash.rows_per_band(0.85)) <= minhash.MISS


def test_ids_beyond_the_bit_set_are_joined(spark, sf, monkeypatch):
    monkeypatch.setattr(minhash, "MOST_BLOOM_BITS", 1)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, width=3, percent=85).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], 3, 85)


def brute_rows(rows, width, percent):
    """As ``brute``, each row on its own: its component is the smallest id of the rows it reaches."""
    numbered = brute([(i, text) for i, (_, text) in enumerate(rows)], width, percent)
    least = {}
    for i, (n, c, _) in numbered.items():
        least[c] = min(least.get(c, 1 << 60), rows[i][0])
    return sorted((rows[i][0], n, least[c] if n else rows[i][0], (least[c] if n else rows[i][0]) == rows[i][0]) for i, (n, c, _) in numbered.items())


def test_ids_with_several_texts(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(9)
    a, b = (" ".join("".join(rng.choices(string.ascii_lowercase, k=5)) for _ in range(60)) for _ in range(2))
    rows = [(5, a), (5, b), (7, a + " x"), (8, b + " y"), (9, b), (2, b + " z"), (5, a), (4, ""), (4, "one")]
    rows += [(rng.randrange(100, 130), t) for t in family(rng, 80, 60, 5) + family(rng, 50, 80, 3)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in minhash.near_duplicates(df, width=3, percent=85).collect())
    assert got == brute_rows(rows, 3, 85)
    of = {(i, n): c for i, n, c, _ in got}
    assert of[8, 59] == of[2, 59] == 2 and of[7, 59] == 5

"""Collocations against plain counting."""

import random
import re
from collections import Counter

import pytest

from kinweave.llm import phrases

SCHEMA = "doc_id long, text string, lang string, phrase string, k string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows, longest=5):
    f = Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            for i in range(len(w)):
                for k in range(1, min(longest, len(w) - i) + 1):
                    f[lang if lang is not None else "und", tuple(w[i : i + k])] += 1
    return f


def plain(rows, longest, least, percent=100, top=2000):
    f = plain_counts(rows, longest)
    total = Counter()
    for (lang, p), n in f.items():
        if len(p) == 1:
            total[lang] += n
    cand = {key: n for key, n in f.items() if len(key[1]) > 1 and n >= least}
    inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
    out = {}
    for (lang, p), a in cand.items():
        if any(m == lang and len(q) > len(p) and 100 * b >= percent * a and inside(p, q) for (m, q), b in cand.items()):
            continue
        score, _, l, r = min((1000 * a * total[lang] // (f[lang, p[:i]] * f[lang, p[i:]]), i, f[lang, p[:i]], f[lang, p[i:]]) for i in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for lang, found in out.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


def odd_rows(seed, n=60):
    rng = random.Random(seed)
    words = ["a", "b", "é", "İ", "x\x1cy", "der", "N\xa0n", "\x00", "b\x85", "日本", "Z"]
    seps = [" ", " ", " ", "  ", "\t", ". ", "\n", "!?", "\r\n", ", ", "\x0b"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words[: rng.randint(1, len(words))]) + rng.choice(seps) for _ in range(rng.randint(0, 60)))
        rows.append((i, text, rng.choice(["en", "de", None, "", "und"]), "x", "y"))
    return rows + [rows[3], (None, "a a a a a a a a a", "en", "", ""), (7, None, None, None, None), (8, "", "en", "", ""), (9, "a b " * 500, "fr", "", "")]


def run(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return sorted(tuple(r)[:8] for r in phrases.collocations(df, **how).collect())


@pytest.mark.parametrize("seed,longest,least,percent,top", [(1, 5, 4, 100, 2000), (2, 3, 2, 100, 7), (3, 5, 3, 60, 2000), (4, 2, 1, 100, 2000)])
def test_collocations(spark, seed, longest, least, percent, top):
    rows = odd_rows(seed)
    assert run(spark, rows, longest=longest, least=least, percent=percent, top=top) == plain([r[1:3] for r in rows], longest, least, percent, top)


def test_small_chunks_and_a_full_bit_set_change_nothing(spark, monkeypatch):
    rows = odd_rows(5)
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    want = plain_counts([r[1:3] for r in rows])
    monkeypatch.setattr(phrases, "MOST_PAIR_BITS", 1 << 10)
    monkeypatch.setattr(phrases, "MOST_BYTES_SENT", 0)
    assert run(spark, rows, least=4) == plain([r[1:3] for r in rows], 5, 4)
    for r in phrases.phrase_counts(df, least=4).collect():
        assert want[r.lang, tuple(r.phrase.split(" "))] == r.f and len(r.phrase.split(" ")) == r.k
    got = {(r.lang, r.phrase) for r in phrases.phrase_counts(df, least=4).where("f >= 4 or k = 1").collect()}
    assert got == {(lang, " ".join(p)) for (lang, p), n in want.items() if n >= 4 or len(p) == 1}


def test_chunk_runs(monkeypatch):
    rng = random.Random(8)
    for size in (21, 2):  # words that fit the packed numbers, and words that do not
        monkeypatch.setattr(phrases, "_WORD_BITS", size)
        texts = [" ".join(rng.choices(["a", "b", "c", "d", ". "], k=rng.randint(0, 30))) for _ in range(40)]
        chunk = phrases.Chunk(texts)
        _, both = chunk.slots("en")
        got = Counter()
        for k, grams, n in chunk.edges_and_ends(both, 5):
            got.update({(k, g.decode()): int(c) for g, c in zip(grams, n)})
        want = Counter()
        for text in texts:
            for piece in text.split("."):
                w = piece.split()
                want.update((5, " ".join(w[i : i + 5])) for i in range(len(w) - 4))
                want.update((k, " ".join(w[-k:])) for k in range(1, 5) if len(w) >= k)
        assert got == want


def test_unary_paths(spark):
    long_ = " ".join(f"w{i}" for i in range(40))
    texts = [f"x{i % 2} {long_} y{i}" for i in range(6)] + ["p q r s t u. p q r s t v"] * 3 + ["a a a a a a a"] * 2
    df = spark.createDataFrame([(i, t, "en", "", "") for i, t in enumerate(texts)], SCHEMA)
    counts = phrases.phrase_counts(df, least=3)
    got = {r.phrase: r.passage for r in phrases.unary_paths(counts, least=3).collect()}
    words = long_.split(" ")
    want = {" ".join(words[i : i + 5]): long_ for i in range(36)}
    want |= {f"x{i} w0 w1 w2 w3": f"x{i} w0 w1 w2 w3" for i in range(2)}
    want |= {p: p for p in ("p q r s t", "q r s t u", "q r s t v", "a a a a a")}
    assert got == want
    assert phrases.unary_paths(counts.limit(0)).count() == 0


def test_products_beyond_64_bits(spark, monkeypatch):
    big = {("en", "a b"): 9_000_000_000_001, ("en", "a"): 9_000_000_000_003, ("en", "b"): 9_100_000_000_007, ("en", "z"): 999_999_999_999_999}
    counts = spark.createDataFrame([(lang, len(p.split()), p, n) for (lang, p), n in big.items()], "lang string, k int, phrase string, f long")
    monkeypatch.setattr(phrases, "phrase_counts", lambda df, **how: counts)
    (row,) = phrases.collocations(counts).collect()
    n = sum(f for (_, p), f in big.items() if " " not in p)
    assert (row.n, row.score) == (n, 1000 * big["en", "a b"] * n // (big["en", "a"] * big["en", "b"]))


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert phrases.collocations(df).count() == 0 and phrases.phrase_counts(df).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, "one two", "en", "", "")], SCHEMA)).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "passage"]


def test_op13_on_whole_tables(spark, sf):
    from kinweave.llm.queries import op13_collocations

    rows = [(r.text, r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(tuple(r)[:8] for r in op13_collocations(spark, sf).collect())
    assert got == plain(rows, 5, 100) and got

"""Byte-level BPE against tiktoken, and word-piece counts against plain greedy matching."""

import functools
import random
import time

import pytest

from kinweave.llm import bpe, token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")
ODD = list("  \n\t\r\x0b\x1c\x85\xa0 　'slltdaabbcé日本ß12.,!*&\x00😀")


@pytest.fixture(scope="module")
def tokens():
    return bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference(tokens):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})


def texts():
    rng = random.Random(3)
    odd = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    repeats = ["".join(rng.choice("ab") for _ in range(50)) for _ in range(300)] + ["a" * n for n in range(40)] + ["na" * 400, "the " * 3000]
    return odd + repeats + ["I'll say it's  fine.\n\nNo  ", "Ünïcödé ²½ x", ""]


def test_codec_is_tiktoken(tokens, reference):
    sample = texts()
    codec = bpe.Codec(tokens)
    assert public_tokenizers.PATTERN == bpe.PATTERN
    import numpy as np

    for text, raw in zip(sample, codec.encode(sample)):
        ids = np.frombuffer(raw, dtype=np.int32).tolist()
        assert ids == reference.encode_ordinary(text), repr(text)
        assert codec.decode(ids) == text.encode()


@pytest.mark.parametrize("word", ["a" * 1_000_000, "=" * 1_000_000, "na" * 300_000, "".join(random.Random(2).choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))])
def test_one_very_long_word(tokens, reference, word):
    codec = bpe.Codec(tokens)
    begin = time.time()
    ids = codec.encode([word])[0].tolist()
    assert time.time() - begin < 10 and ids == reference.encode_ordinary(word)


def test_merges_of_one_turn_mind_lower_ranks():
    # A vocabulary whose ranks are out of order: merging a pair brings up lower ranks in its word.
    rng = random.Random(7)
    import tiktoken

    for _ in range(40):
        longer = {bytes(rng.choices(b"abc", k=rng.randint(2, 5))) for _ in range(30)}
        made = [bytes([b]) for b in range(256)] + rng.sample(sorted(longer), len(longer))
        own = tiktoken.Encoding("odd", pat_str=bpe.PATTERN, mergeable_ranks={t: i for i, t in enumerate(made)}, special_tokens={})
        codec = bpe.Codec(made)
        texts = ["".join(rng.choices("abc", k=rng.randint(1, 40))) for _ in range(50)]
        assert [c.tolist() for c in codec.encode(texts)] == [own.encode_ordinary(t) for t in texts]


def test_small_store_changes_nothing(tokens, reference, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_CACHED_WORDS", 5)
    codec = bpe.Codec(tokens)
    import numpy as np

    for _ in range(3):
        raw = codec.encode(["one two three four", "five six two one", "seven"])
        assert [np.frombuffer(r, dtype=np.int32).tolist() for r in raw] == [reference.encode_ordinary(t) for t in ("one two three four", "five six two one", "seven")]


def test_encode_table(spark, tokens, reference):
    rows = [(1, "the cat", "x", "clash"), (2, None, None, None), (3, "", "y", ""), (None, "the cat", "x", "clash"), (1, "the cat", "x", "clash"), (5, "word " * 60_000, "z", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, decoded string")
    out = bpe.encode(df, tokens, with_decoded=True).collect()
    assert len(out) == len(rows) and out[0].asDict().keys() == {"doc_id", "source", "token_ids", "decoded"}
    for r, row in zip(rows, out):
        assert row.doc_id == r[0] and row.token_ids == reference.encode_ordinary(r[1] or "") and bytes(row.decoded) == (r[1] or "").encode()
    again = bpe.decode(bpe.encode(df, tokens, columns=["doc_id"]), tokens)
    assert [bytes(r.decoded) for r in again.collect()] == [(r[1] or "").encode() for r in rows]
    assert bpe.encode(df.limit(0), tokens).count() == 0


@functools.cache
def longest_of(pieces):
    return max(map(len, pieces))


def greedy(word, pieces):
    n = at = 0
    pieces = frozenset(pieces)
    longest = longest_of(pieces)
    while at < len(word):
        for k in range(min(longest, len(word) - at), 0, -1):
            if word[at : at + k] in pieces:
                n, at = n + 1, at + k
                break
        else:
            n, at = n + len(word[at].encode()), at + 1
    return n


def test_automaton_is_greedy():
    rng = random.Random(1)
    for _ in range(200):
        pieces = {"".join(rng.choice("abcé") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 12))}
        automaton = token_counts.LongestMatch(sorted(pieces))
        for _ in range(30):
            word = "".join(rng.choice("abcéx") for _ in range(rng.randint(0, 14)))
            assert automaton.count(word) == greedy(word, pieces), (word, pieces)


def test_token_counts_table(spark, sf):
    pieces = token_counts.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    known = frozenset(pieces)
    rows = [(1, "a bc d", 1), (2, None, 2), (3, " \n", 3), (None, "日本 x", 4), (1, "a bc d", 1), (7, "verylongword" * 5000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out = token_counts.token_counts(df, pieces).collect()
    for r, row in zip(rows[:5], out):
        words = [w.decode() for w in (r[1] or "").encode().split()]
        assert (row.doc_id, row.n_words, row.n_tokens) == (r[0], len(words), sum(greedy("▁" + w, known) for w in words))
    assert out[5].n_tokens == greedy("▁" + rows[5][1], known)
    assert token_counts.token_counts(df.limit(0), pieces).count() == 0
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, pieces).collect()}
    for r in docs.collect():
        assert got[r.doc_id] == sum(greedy("▁" + w.decode(), known) for w in r.text.encode().split())

"""SentencePiece agenda against the sentencepiece library and against plain repeated search."""

import random
import time

import numpy as np
import pytest

from kinweave.llm import sentence_pieces

public_tokenizers = pytest.importorskip("public_tokenizers")
ODD = list("  ▁▁abcetaonst\n\t\r\x0b\x85\xa0　'é日本ß12.,!<s>\x00😀ﬁ①")


@pytest.fixture(scope="module")
def model():
    return sentence_pieces.load_model(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def pieces(model):
    return sentence_pieces.Pieces(model)


def texts():
    rng = random.Random(5)
    odd = ["".join(rng.choices(ODD, k=rng.randint(0, 40))) for _ in range(3000)]
    words = ["".join(rng.choices("etaoinshr", k=rng.randint(1, 30))) for _ in range(500)]
    blanks = [" " * n + "a" * (n % 3) for n in range(60)] + ["▁" * n for n in range(20)]
    return odd + words + blanks + ["", " ", "the  cat▁sat", "na" * 400, "the " * 3000, "<s> </s> <unk> <0x41>"]


def test_agenda_is_the_library(pieces):
    sample = texts()
    for text, ids in zip(sample, pieces.encode(sample)):
        assert ids.tolist() == pieces.library.encode(text), repr(text)
        assert pieces.decode(ids) == pieces.library.decode(ids.tolist()), repr(text)


def test_any_ids_decode_as_the_library(pieces):
    rng = random.Random(6)
    some = [0, 1, 2, *range(3, 259), pieces.id_of["▁"], pieces.id_of["▁▁"], pieces.id_of["▁the"], pieces.id_of["a"]]
    for _ in range(4000):
        ids = [rng.choice(some) if rng.random() < 0.8 else rng.randrange(32000) for _ in range(rng.randint(0, 12))]
        assert pieces.decode(ids) == pieces.library.decode(ids), ids


def test_ties_go_to_the_left(pieces):
    # Equal costs: the agenda must take the leftmost, as one search after the other does.
    own = object.__new__(sentence_pieces.Pieces)
    own.id_of = {p: i for i, p in enumerate(["a", "b", "ab", "ba", "aa", "aab", "abab", "bb"])}
    own._index({"ab": 1.0, "ba": 1.0, "aa": 1.0, "aab": 0.5, "abab": 2.0, "bb": 1.0})
    own.byte_id = np.arange(100, 356)

    def plain(text):
        symbols = list(text)
        while True:
            found = [(own.cost[symbols[i] + symbols[i + 1]], i) for i in range(len(symbols) - 1) if symbols[i] + symbols[i + 1] in own.cost]
            if not found:
                return [own.id_of[s] for s in symbols]
            i = min(found)[1]
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]

    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choices("ab", k=rng.randint(1, 14)))
        assert own.agenda(text) == plain(text), text
        ids, counts = own.segments([text, "b", text])
        assert ids.tolist() == plain(text) + [1] + plain(text) and counts.tolist()[1] == 1


@pytest.mark.parametrize("word", ["a" * 300_000, "na" * 150_000, "".join(random.Random(2).choices("abcdefghijklmnopqrstuvwxyz", k=300_000))])
def test_one_very_long_word(pieces, word):
    begin = time.time()
    ids = pieces.encode([word])[0].tolist()
    assert time.time() - begin < 20 and ids == pieces.library.encode(word)


def test_long_texts_and_small_stores_change_nothing(pieces, monkeypatch):
    text = "".join(texts())
    want = pieces.library.encode(text)
    for chars, segments in ((50, 10), (1000, 250_000)):
        monkeypatch.setattr(sentence_pieces, "CHARS_PER_RUN", chars)
        monkeypatch.setattr(sentence_pieces, "MAX_CACHED_SEGMENTS", segments)
        assert pieces.encode([text, text])[1].tolist() == want


def test_table(spark, model, pieces):
    rows = [(1, "the cat", "x", "clash"), (2, None, None, None), (3, "", "y", ""), (None, "the cat", "x", "clash"), (1, "the cat", "x", "clash"), (5, "word " * 60_000, "z", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, decoded string")
    out = sentence_pieces.encode(df, model, with_decoded=True, check=True).collect()
    assert len(out) == len(rows) and out[0].asDict().keys() == {"doc_id", "source", "token_ids", "decoded"}
    for r, row in zip(rows, out):
        assert (row.doc_id, row.token_ids, row.decoded) == (r[0], pieces.library.encode(r[1] or ""), r[1] or "")
    again = sentence_pieces.decode(sentence_pieces.encode(df, model, columns=["doc_id"]), model)
    assert [r.decoded for r in again.collect()] == [r[1] or "" for r in rows]
    assert sentence_pieces.encode(df.limit(0), model).count() == 0


def test_check_fails_the_job(pieces):
    with pytest.raises(ValueError):
        sentence_pieces._compare(pieces, ["the cat"], [np.array([5], dtype=np.int32)], ["the cat"])
    with pytest.raises(ValueError):
        sentence_pieces._compare(pieces, ["the cat"], pieces.encode(["the cat"]), ["the cat "])


def test_op12_against_the_library(spark, sf):
    import hashlib

    from kinweave.llm.queries import op12_sentence_pieces

    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    text_of = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = op12_sentence_pieces(spark, sf).collect()
    assert len(out) == len(text_of)
    for r in out:
        ids = library.encode(text_of[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids)))

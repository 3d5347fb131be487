"""Word-piece token counts by a linear longest-match automaton.

The vocabulary trie carries a failure link at every node and the number of pieces
that following it pops. A word is read once, left to right; its greedy
longest-match length is the sum of the pops, and no piece is ever built.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

MAX_CACHED_WORDS = 300_000


def load_pieces(path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece model, without control, unknown and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]


class LongestMatch:
    """Counts the pieces of a word under greedy longest match.

    A character that starts no piece costs its UTF-8 bytes (byte fallback).
    """

    def __init__(self, pieces: Sequence[str]):
        cost = {p: 1 for p in pieces if p}
        for char in {c for p in cost for c in p}:
            cost.setdefault(char, len(char.encode("utf-8", "surrogatepass")))
        self.kids: list[dict[str, int]] = [{}]
        own = [0]
        for piece, n in cost.items():
            node = 0
            for c in piece:
                child = self.kids[node].get(c)
                if child is None:
                    child = self.kids[node][c] = len(self.kids)
                    self.kids.append({})
                    own.append(0)
                node = child
            own[node] = n
        self.fail, self.pop, self.flush = [0] * len(own), [0] * len(own), [0] * len(own)
        level = [0]
        while level:  # by depth, so that a parent's link is ready
            below = []
            for node in level:
                for c, child in self.kids[node].items():
                    if own[child]:
                        self.pop[child] = own[child]
                    else:
                        popped, at = self.pop[node], self.fail[node]
                        while c not in self.kids[at]:
                            popped += self.pop[at]
                            at = self.fail[at]
                        self.pop[child], self.fail[child] = popped, self.kids[at][c]
                    self.flush[child] = self.pop[child] + self.flush[self.fail[child]]
                    below.append(child)
            level = below

    def count(self, word: str) -> int:
        kids, fail, pop = self.kids, self.fail, self.pop
        node = total = 0
        for c in word:
            child = kids[node].get(c)
            while child is None:
                if node == 0:
                    total += len(c.encode("utf-8", "surrogatepass"))
                    child = 0
                    break
                total += pop[node]
                node = fail[node]
                child = kids[node].get(c)
            node = child
        return total + self.flush[node]


class _Counts(dict):
    """Word to count, filled when asked; emptied when it holds MAX_CACHED_WORDS."""

    def __init__(self, automaton: LongestMatch, prefix: str):
        self.automaton, self.prefix = automaton, prefix

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_CACHED_WORDS:
            self.clear()
        n = self[word] = self.automaton.count(self.prefix + word.decode("utf-8", "surrogatepass"))
        return n


_ready: dict[tuple, _Counts] = {}


def token_counts(
    df: DataFrame, pieces: Sequence[str], *, word_prefix: str = "▁", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, n_words, n_tokens`` for each row of ``df``, over whole texts.

    Words are the runs between ASCII white space, each with ``word_prefix`` before it.

    Defined cases: a null or empty text counts 0 words and 0 tokens; a null id stays
    null; repeated rows each give a row; an empty table gives an empty table; other
    columns of ``df`` are not read.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(tuple(pieces))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (hash(vocabulary.value), word_prefix)
        if key not in _ready:
            _ready[key] = _Counts(LongestMatch(vocabulary.value), word_prefix)
        counts = _ready[key]
        for batch in batches:
            words, tokens = [], []
            for text in batch.column(1):
                parts = (text.as_py() or "").encode().split()
                words.append(len(parts))
                tokens.append(sum(map(counts.__getitem__, parts)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=[id_col, "n_words", "n_tokens"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(count, f"`{id_col}` {kind}, n_words long, n_tokens long")

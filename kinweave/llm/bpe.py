"""Byte-level BPE encoding and decoding by corpus-level merge replay.

Each task gathers the distinct words of a run of documents, lays their bytes out as
one symbol sequence and keeps an inverted index from merge (by rank) to the positions
where that pair of tokens stands. Merges are then applied in rank order to all their
positions at once; only the two neighbours of a merged position are looked up again.
Documents are put together from the encoded words.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: The store of encoded words is emptied beyond either; a replay takes texts up to either bound.
MAX_CACHED_WORDS = 250_000
MAX_CACHED_CHARS = 4_000_000
DOCS_PER_REPLAY = 2500
CHARS_PER_REPLAY = 2_000_000

#: Words of the byte-level BPE of GPT-2; the default of every function here.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def load_ranks(path: str) -> list[bytes]:
    """The tokens of a tiktoken file, by rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens: list[bytes] = [b""] * (max(int(r) for _, r in pairs) + 1)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class MergeReplay:
    """Encodes sets of words by replaying merges over all of them together."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        ranks = self.ranks = {t: i for i, t in enumerate(tokens) if t}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.made = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the token that each pair makes, or -1."""
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.made[at], -1)

    def _together(self, r: int, places: np.ndarray, symbols: np.ndarray, follows: np.ndarray, comes: np.ndarray, word_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the sorted ``places`` of merge ``r``: those merged in one turn, and those left for the next.

        One after the other, from the left, is the rule. Places of a word are merged in one
        turn if no pair that comes up between two of them has a lower rank; of places that
        overlap every second one goes. Words where a lower rank comes up merge their first only.
        """
        same = word_of[places[1:]] == word_of[places[:-1]]
        if not same.any():
            return places, places[:0]
        first = np.ones(len(places), dtype=bool)
        first[1:] = follows[places[:-1]] != places[1:]
        run = np.maximum.accumulate(np.where(first, np.arange(len(places)), 0))
        every = places
        places = places[(np.arange(len(places)) - run) % 2 == 0]
        gone = follows[places]
        after, before = follows[gone], comes[places]
        merged = np.full(len(places), r, dtype=np.int64)
        right = np.full(len(places), -1, dtype=np.int64)
        right[after >= 0] = self.rank(merged[after >= 0], symbols[after[after >= 0]])
        left_symbol = np.where(before >= 0, symbols[before], -1)
        left_symbol[1:][gone[:-1] == before[1:]] = r
        left = np.full(len(places), -1, dtype=np.int64)
        left[before >= 0] = self.rank(left_symbol[before >= 0], merged[before >= 0])
        lower = ((right >= 0) & (right < r)) | ((left >= 0) & (left < r))
        if not lower.any():
            return places, places[:0]
        careful = word_of[places[lower]]
        head = np.ones(len(every), dtype=bool)
        head[1:] = ~same
        wait = np.isin(word_of[every], careful) & ~head
        return np.setdiff1d(places, every[wait], assume_unique=True), every[wait]

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after the other (32-bit), and how many each has."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        lengths = np.array([len(w) for w in words])
        ends = np.cumsum(lengths)
        symbols = self.single[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word_of = np.repeat(np.arange(len(words)), lengths)
        follows = np.arange(1, len(symbols) + 1)
        follows[ends[lengths > 0] - 1] = -1
        comes = np.arange(-1, len(symbols) - 1)
        comes[(ends - lengths)[lengths > 0]] = -1
        pair_rank = np.full(len(symbols), -1, dtype=np.int64)
        inner = np.flatnonzero(follows >= 0)
        pair_rank[inner] = self.rank(symbols[inner], symbols[inner + 1])

        where: dict[int, list[np.ndarray]] = {}  # the inverted index: rank to positions
        queue: list[int] = []

        def index(places: np.ndarray) -> None:
            ranks = pair_rank[places]
            places, ranks = places[ranks >= 0], ranks[ranks >= 0]
            if not len(places):
                return
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            first = ranks[np.concatenate(([0], cuts))].tolist()
            bounds = [0, *cuts.tolist(), len(places)]
            for i, r in enumerate(first):
                if r not in where:
                    where[r] = []
                    heapq.heappush(queue, r)
                where[r].append(places[bounds[i] : bounds[i + 1]])

        index(inner)
        while queue:
            r = heapq.heappop(queue)
            lists = where.pop(r)
            places = np.concatenate(lists) if len(lists) > 1 else lists[0]
            places = np.sort(places[pair_rank[places] == r])
            places = places[np.concatenate(([True], places[1:] != places[:-1]))] if len(places) > 1 else places
            if not len(places):
                continue
            places, later = self._together(r, places, symbols, follows, comes, word_of)
            if len(later):
                where[r] = [later]
                heapq.heappush(queue, r)
            gone = follows[places]
            after, before = follows[gone], comes[places]
            symbols[places], symbols[gone] = r, -1
            pair_rank[gone] = -1
            follows[places] = after
            has = after >= 0
            comes[after[has]] = places[has]
            pair_rank[places] = -1
            pair_rank[places[has]] = self.rank(symbols[places[has]], symbols[after[has]])
            before = before[before >= 0]
            pair_rank[before] = self.rank(symbols[before], symbols[follows[before]])
            index(np.concatenate((before, places)))
        kept = symbols >= 0
        sizes = np.zeros(len(words), dtype=np.int64)
        if len(symbols):
            sizes[lengths > 0] = np.add.reduceat(kept, (ends - lengths)[lengths > 0], dtype=np.int64)
        return symbols[kept].astype(np.int32), sizes


class _Numbers(dict):
    """Word to number, in the order in which words are first asked for."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


class Codec:
    """Texts to ids and back, with a store of encoded words that is bounded by words and characters."""

    def __init__(self, tokens: list[bytes], pattern: str = PATTERN):
        import regex

        self.replay = MergeReplay(tokens)
        # Only Unicode's White_Space counts as \s here; Python also takes U+001C to U+001F.
        spaces = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")
        self.any_words = regex.compile(spaces).findall
        # Texts of plain Latin letters, digits and ASCII signs: the same classes spelled out, for the faster engine.
        letters, blanks = "A-Za-zÀ-ÖØ-öø-ÿ", " \\t-\\r"
        plain = pattern.replace(r"\p{L}", letters if r"[^\s\p{L}" in pattern else f"[{letters}]")
        plain = plain.replace(f" ?{letters}+", f" ?[{letters}]+").replace(r"[^\s" + letters + r"\p{N}]", f"[^{blanks}{letters}0-9]").replace(r"\p{N}", "[0-9]")
        plain = plain.replace(r"\S", f"[^{blanks}]").replace(r"\s", f"[{blanks}]")
        self.plain_words = re.compile(plain).findall if pattern == PATTERN else None
        self.not_plain = re.compile(r"[^\t-\r -~À-ÖØ-öø-ÿ¿¡«»]").search
        self._empty()

    def _empty(self) -> None:
        self.numbers = _Numbers()
        self.known_chars = 0
        self.ids, self.begins = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def split(self, text: str) -> list[str]:
        """The matches of the pattern."""
        if self.plain_words is None or self.not_plain(text):
            return self.any_words(text)
        return self.plain_words(text)

    def encode(self, texts: Iterable[str]) -> list[np.ndarray]:
        """The ids of each text (32-bit). Words are kept as numbers, so a text is never held as a list of strings."""
        if len(self.numbers) > MAX_CACHED_WORDS or self.known_chars > MAX_CACHED_CHARS:
            self._empty()
        before = len(self.numbers)
        number = self.numbers.__getitem__
        coded = [np.fromiter(map(number, self.split(t)), dtype=np.int32) for t in texts]
        new = [w.encode("utf-8", "surrogatepass") for w in islice(self.numbers, before, None)]
        self.known_chars += sum(map(len, new))
        # A word that is a token itself is that token, whatever the merges would give.
        whole = np.array([self.replay.ranks.get(w, -1) for w in new], dtype=np.int32)
        merged, counts = self.replay.encode([w for w, r in zip(new, whole.tolist()) if r < 0])
        sizes = np.ones(len(new), dtype=np.int64)
        sizes[whole < 0] = counts
        ids = np.repeat(whole, sizes)
        ids[ids < 0] = merged
        self.begins = np.concatenate((self.begins, self.begins[-1] + np.cumsum(sizes)))
        self.ids = np.concatenate((self.ids, ids))
        return [self._gather(words) for words in coded]

    def _gather(self, words: np.ndarray) -> np.ndarray:
        first = self.begins[words]
        sizes = self.begins[words + 1] - first
        ends = np.cumsum(sizes)
        return self.ids[np.repeat(first - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.replay.tokens.__getitem__, ids))


_ready: dict[tuple, Codec] = {}


def _codec(tokens: tuple[bytes, ...], pattern: str) -> Codec:
    key = (hash(tokens), pattern)
    if key not in _ready:
        _ready[key] = Codec(list(tokens), pattern)
    return _ready[key]


def _lists(coded: list[np.ndarray]) -> pa.ListArray:
    ends = np.zeros(len(coded) + 1, dtype=np.int32)
    np.cumsum([len(c) for c in coded], out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(coded)))


def _slices(texts: pa.Array, docs: int, size: int) -> Iterator[tuple[int, list[str]]]:
    """Runs of at most ``docs`` texts and about ``size`` characters, with the place of the first."""
    run: list[str] = []
    chars = begin = 0
    for i, value in enumerate(texts):
        text = value.as_py() or ""
        if run and (len(run) >= docs or chars + len(text) > size):
            yield begin, run
            run, chars, begin = [], 0, i
        run.append(text)
        chars += len(text)
    if run:
        yield begin, run


def encode(
    df: DataFrame,
    tokens: list[bytes],
    *,
    pattern: str = PATTERN,
    text_col: str = "text",
    columns: list[str] | None = None,
    with_decoded: bool = False,
) -> DataFrame:
    """``columns`` of ``df`` (all but the text if None) with ``token_ids``, the ids of the whole text.

    ``with_decoded`` adds ``decoded``: the bytes that decoding those ids gives, made in the
    same pass. Each match of ``pattern`` is encoded on its own; there are no special tokens.

    Defined cases: a null or empty text has no ids and decodes to no bytes; repeated rows
    each give a row; an empty table gives an empty table; input columns named like an
    output are replaced. Texts of any length are encoded whole.
    """
    made = ["token_ids"] + ["decoded"] * with_decoded
    keep = [c for c in (columns if columns is not None else [c for c in df.columns if c != text_col]) if c not in made]
    shared = df.sparkSession.sparkContext.broadcast(tuple(tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value, pattern)
        for batch in batches:
            rest = [batch.column(i) for i in range(1, batch.num_columns)]
            for begin, texts in _slices(batch.column(0), DOCS_PER_REPLAY, CHARS_PER_REPLAY):
                coded = codec.encode(texts)
                arrays = [c.slice(begin, len(texts)) for c in rest] + [_lists(coded)]
                if with_decoded:
                    arrays.append(pa.array([codec.decode(c.tolist()) for c in coded], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names=keep + made)

    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + ["token_ids array<int>"] + ["decoded binary"] * with_decoded
    return df.select(df[text_col].alias("kw_text"), *[df[c] for c in keep]).mapInArrow(run, ", ".join(fields))


def decode(df: DataFrame, tokens: list[bytes], *, ids_col: str = "token_ids") -> DataFrame:
    """``df`` with ``decoded``, the bytes of the ids in ``ids_col``.

    Defined cases: null or no ids decode to no bytes; repeated rows each give a row; an
    empty table gives an empty table; an input column ``decoded`` is replaced. An id that
    is null or outside the vocabulary fails the job.
    """
    keep = [c for c in df.columns if c != "decoded"]
    shared = df.sparkSession.sparkContext.broadcast(tuple(tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.__getitem__
        for batch in batches:
            raw = [b"".join(map(token, v.as_py() or ())) for v in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(1, batch.num_columns)] + [pa.array(raw, pa.binary())], names=[*keep, "decoded"])

    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + ["decoded binary"]
    return df.select(df[ids_col].alias("kw_ids"), *[df[c] for c in keep]).mapInArrow(run, ", ".join(fields))

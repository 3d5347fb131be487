"""SentencePiece encoding and decoding for vocabularies of the merge kind.

A text is normalised and cut into segments that no piece can span. A segment's
characters are its first symbols; every two adjacent symbols that make a piece wait in an
agenda ordered by the piece's score, and by place among equal scores. The best pair is
merged and its two neighbours are offered anew, until the agenda is empty. Symbols
without a piece become their bytes. The agendas of many short segments stand side by side
as the rows of an array, and each turn merges the best pair of every row; a long segment
has a heap. The encoder can be checked batch by batch against the sentencepiece library,
which also normalises the texts.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kinweave.llm.bpe import _lists, _Numbers, _slices

BLANK = "▁"
#: The store of encoded segments is emptied beyond either.
MAX_CACHED_SEGMENTS = 400_000
MAX_CACHED_CHARS = 8_000_000
#: Texts go through the encoder in runs of either size; longer ones are cut into segments piecemeal.
DOCS_PER_RUN = 1000
CHARS_PER_RUN = 1_000_000
#: Agendas side by side are for segments up to the last of these lengths, those up to each length together.
SHORT = (4, 8, 12, 16, 24)
_NONE = np.iinfo(np.int32).max


def load_model(path: str) -> bytes:
    """The bytes of a sentencepiece model file."""
    with open(path, "rb") as f:
        return f.read()


class Pieces:
    """Encodes and decodes with the pieces and scores of one model.

    The model must be of the merge kind (BPE) with byte fallback, without symbols defined
    by the user.
    """

    def __init__(self, model: bytes):
        import sentencepiece

        library = self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = library.get_piece_size()
        pieces = [library.id_to_piece(i) for i in range(size)]
        special = [library.is_control(i) or library.is_unknown(i) for i in range(size)]
        self.is_byte = np.array([library.is_byte(i) for i in range(size)], dtype=bool)
        self.byte_id = np.full(256, -1, dtype=np.int32)
        for i in np.flatnonzero(self.is_byte).tolist():
            self.byte_id[int(pieces[i][3:5], 16)] = i
        if (self.byte_id < 0).any():
            raise ValueError("the model has no piece for some bytes")
        self.byte_of = {i: b for b, i in enumerate(self.byte_id.tolist())}
        own = [i for i in range(size) if not special[i] and not self.is_byte[i]]
        if any(library.is_unused(i) for i in own):
            raise ValueError("the model has unused pieces")
        self.id_of = {pieces[i]: i for i in own}
        scores = {pieces[i]: -library.get_score(i) for i in own if len(pieces[i]) > 1}
        self._index(scores)
        unknown = library.decode([library.unk_id()])
        mine = set(own)
        self.shown = [pieces[i].replace(BLANK, " ") if i in mine else unknown if library.is_unknown(i) else "" for i in range(size)]
        self.is_control = np.array([library.is_control(i) for i in range(size)], dtype=bool)
        self.starts_blank = np.array([i in mine and pieces[i].startswith(BLANK) for i in range(size)], dtype=bool)
        self.strips_all = library.normalize("  a") == library.normalize("a")
        self.strips = self.strips_all or library.normalize("a").startswith(BLANK)
        # Where no piece has a blank after another character, a text falls apart there; and around characters of no longer piece.
        apart = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.id_of)
        joined = {c for p in scores for c in p}
        lone = "".join(re.escape(chr(c)) for c in range(0x250) if chr(c) not in joined)
        self.segment = re.compile((f"[{lone}]|" if lone else "") + (f"{BLANK}*[^{BLANK}{lone}]+|{BLANK}+" if apart else f"[^{lone}]+" if lone else r"[\s\S]+"))
        self.cut = re.compile(f"(?<=[^{BLANK}]){BLANK}") if apart else None
        self._empty()

    def _index(self, scores: dict[str, float]) -> None:
        """The costs of pairs: by the piece they make, and by the numbers of the two symbols."""
        place = {c: i for i, c in enumerate(sorted(set(scores.values())))}  # equal scores cost the same
        self.cost = {p: place[c] for p, c in scores.items()}
        self.symbol = np.full(0x110000, -1, dtype=np.int64)
        for p, i in self.id_of.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        pairs = {}
        for p in self.cost:
            for cut in range(1, len(p)):
                left, right = self.id_of.get(p[:cut]), self.id_of.get(p[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = p
        keys = sorted(pairs)
        self.keys = np.array([*keys, 1 << 62], dtype=np.int64)
        self.made = np.array([*(self.id_of[pairs[k]] for k in keys), -1], dtype=np.int64)
        self.pair_cost = np.array([*(self.cost[pairs[k]] for k in keys), _NONE], dtype=np.int32)

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place of each pair of symbols in the index, the last one for a pair that makes nothing."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, at, len(self.keys) - 1)

    def _empty(self) -> None:
        self.numbers = _Numbers()
        self.known_chars = 0
        self.ids, self.begins = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _side_by_side(self, symbols: np.ndarray) -> np.ndarray:
        """Rows of symbols (-1 behind the end) merged until no pair makes a piece."""
        out = np.full(symbols.shape, -1, dtype=np.int64)
        row, nothing = np.arange(len(symbols)), len(self.keys) - 1
        pairs = np.full(symbols.shape, nothing, dtype=np.int64)
        pairs[:, :-1] = np.where(symbols[:, 1:] >= 0, self._pair(symbols[:, :-1], np.maximum(symbols[:, 1:], 0)), nothing)
        column = np.arange(symbols.shape[1])[None]
        while len(row):
            cost = self.pair_cost[pairs]
            best = cost.argmin(1)  # the first of equal ones
            some = cost[np.arange(len(row)), best] < _NONE
            if not some.all():
                out[row[~some]] = symbols[~some]
                row, symbols, pairs, best = row[some], symbols[some], pairs[some], best[some]
            at = np.arange(len(row))
            merged = self.made[pairs[at, best]]
            behind = column > best[:, None]
            symbols = np.where(behind, np.pad(symbols[:, 1:], ((0, 0), (0, 1)), constant_values=-1), symbols)
            pairs = np.where(behind, np.pad(pairs[:, 1:], ((0, 0), (0, 1)), constant_values=nothing), pairs)
            symbols[at, best] = merged
            after = np.where(best + 1 < symbols.shape[1], symbols[at, np.minimum(best + 1, symbols.shape[1] - 1)], -1)
            pairs[at, best] = np.where(after >= 0, self._pair(merged, np.maximum(after, 0)), nothing)
            inner = np.flatnonzero(best > 0)
            pairs[inner, best[inner] - 1] = self._pair(symbols[inner, best[inner] - 1], merged[inner])
        return out

    def _merged(self, symbols: list[str]) -> list[str]:
        """The agenda as a heap. Merged symbols stay in place, empty ones after them."""
        last = len(symbols) - 1
        comes, follows = list(range(-1, last)), list(range(1, last + 2))
        cost, heap = self.cost, []
        for i in range(last):
            piece = symbols[i] + symbols[i + 1]
            if piece in cost:
                heap.append((cost[piece], i, i + 1, piece))
        heapq.heapify(heap)
        while heap:
            _, i, j, piece = heapq.heappop(heap)
            # Stale: one of the two has been merged since. A merged symbol only grows.
            if not symbols[i] or not symbols[j] or len(symbols[i]) + len(symbols[j]) != len(piece):
                continue
            symbols[i], symbols[j] = piece, ""
            k = follows[i] = follows[j]
            if k <= last:
                comes[k] = i
                wider = piece + symbols[k]
                if wider in cost:
                    heapq.heappush(heap, (cost[wider], i, k, wider))
            h = comes[i]
            if h >= 0:
                wider = symbols[h] + piece
                if wider in cost:
                    heapq.heappush(heap, (cost[wider], h, i, wider))
        return symbols

    def agenda(self, segment: str) -> list[int]:
        """The ids of one segment of any length."""
        ids: list[int] = []
        for s in self._merged(list(segment)):
            if s:
                found = self.id_of.get(s)
                if found is None:
                    ids += self.byte_id[list(s.encode("utf-8", "surrogatepass"))].tolist()
                else:
                    ids.append(found)
        return ids

    def segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all segments, one after the other (32-bit), and how many each has."""
        lengths = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))
        ends = np.cumsum(lengths)
        symbols = self.symbol[np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        # A character without a piece sends its segment to the heap, unless it is the segment.
        odd = np.zeros(len(segments), dtype=bool)
        odd[np.searchsorted(ends, np.flatnonzero(symbols < 0), side="right")] = True
        counts, found = np.zeros(len(segments), dtype=np.int64), []
        least = 0
        for most in SHORT:
            here = np.flatnonzero((lengths > least) & (lengths <= most) & ~odd)
            for part in np.split(here, range(20_000, len(here), 20_000)):
                column = np.arange(most)[None]
                inside = column < lengths[part][:, None]
                at = (ends - lengths)[part][:, None] + column
                rows = self._side_by_side(np.where(inside, symbols[np.minimum(at, len(symbols) - 1)], -1)) if len(part) else at
                held = rows >= 0
                counts[part] = held.sum(1)
                found.append((part, rows[held]))
            least = most
        rest = np.flatnonzero((lengths > least) | odd)
        coded = [self.agenda(segments[i]) for i in rest.tolist()]
        counts[rest] = [len(ids) for ids in coded]
        found.append((rest, np.array([i for ids in coded for i in ids], dtype=np.int64)))
        begins = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), dtype=np.int32)
        for part, ids in found:
            n = counts[part]
            out[np.repeat(begins[part] - np.cumsum(n) + n, n) + np.arange(len(ids))] = ids
        return out, counts

    def _parts(self, text: str) -> Iterator[list[str]]:
        begin = 0
        while begin < len(text):
            there = self.cut.search(text, begin + CHARS_PER_RUN) if self.cut and len(text) - begin > CHARS_PER_RUN else None
            end = there.start() if there else len(text)
            yield self.segment.findall(text, begin, end)
            begin = end

    def encode(self, texts: Iterable[str]) -> list[np.ndarray]:
        """The ids of each whole text (32-bit). Segments are kept as numbers, and each new one is encoded once."""
        if len(self.numbers) > MAX_CACHED_SEGMENTS or self.known_chars > MAX_CACHED_CHARS:
            self._empty()
        before = len(self.numbers)
        number = self.numbers.__getitem__
        coded = []
        for text in texts:
            parts = [np.fromiter(map(number, part), dtype=np.int32, count=len(part)) for part in self._parts(self.library.normalize(text))]
            coded.append(np.concatenate(parts) if parts else np.zeros(0, np.int32))
        new = list(islice(self.numbers, before, None))
        self.known_chars += sum(map(len, new))
        ids, counts = self.segments(new)
        self.begins = np.concatenate((self.begins, self.begins[-1] + np.cumsum(counts)))
        self.ids = np.concatenate((self.ids, ids))
        out = []
        for segments in coded:
            first = self.begins[segments]
            sizes = self.begins[segments + 1] - first
            ends = np.cumsum(sizes)
            out.append(self.ids[np.repeat(first - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)])
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of the ids: blanks shown, the one put before the text gone, bytes read as UTF-8, a bad byte as U+FFFD."""
        ids = np.asarray(ids, dtype=np.int64)
        out: list[str] = []
        begin = 0
        while self.strips and begin < len(ids) and (self.is_control[ids[begin]] or self.starts_blank[ids[begin]]):
            first = self.shown[ids[begin]]
            begin += 1
            if first:
                out.append(first[1:])
                if first[1:] or not self.strips_all:
                    break
        ids = ids[begin:]
        byte = self.is_byte[ids]
        if not byte.any():
            return "".join(out) + "".join(map(self.shown.__getitem__, ids.tolist()))
        edges = np.flatnonzero(np.diff(byte)) + 1
        for run in np.split(ids, edges):
            if self.is_byte[run[0]]:
                out.append(_utf8(bytes(self.byte_of[i] for i in run.tolist())))
            else:
                out.append("".join(map(self.shown.__getitem__, run.tolist())))
        return "".join(out)


def _utf8(raw: bytes) -> str:
    """``raw`` read as UTF-8; each byte that is part of no character gives one U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError as bad:
        return raw[: bad.start].decode() + "�" + _utf8_rest(raw, bad.start + 1)


def _utf8_rest(raw: bytes, begin: int) -> str:
    out = []
    while begin < len(raw):
        try:
            out.append(raw[begin:].decode())
            break
        except UnicodeDecodeError as bad:
            out.append(raw[begin : begin + bad.start].decode() + "�")
            begin += bad.start + 1
    return "".join(out)


_ready: dict[int, Pieces] = {}


def _pieces(model: bytes) -> Pieces:
    key = hash(model)
    if key not in _ready:
        _ready[key] = Pieces(model)
    return _ready[key]


def encode(
    df: DataFrame,
    model: bytes,
    *,
    text_col: str = "text",
    columns: list[str] | None = None,
    with_decoded: bool = False,
    check: bool = False,
) -> DataFrame:
    """``columns`` of ``df`` (all but the text if None) with ``token_ids``, the ids of the whole text.

    No ids of begin or end are added. ``with_decoded`` adds ``decoded``: the text that
    decoding those ids gives. ``check`` has the sentencepiece library encode and decode
    the same Arrow batch too, and fails the job where anything differs.

    Defined cases: a null or empty text has no ids and decodes to the empty text; repeated
    rows each give a row; an empty table gives an empty table; input columns named like an
    output are replaced. Texts of any length are encoded whole.
    """
    made = ["token_ids"] + ["decoded"] * with_decoded
    keep = [c for c in (columns if columns is not None else [c for c in df.columns if c != text_col]) if c not in made]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(shared.value)
        for batch in batches:
            rest = [batch.column(i) for i in range(1, batch.num_columns)]
            for begin, texts in _slices(batch.column(0), DOCS_PER_RUN, CHARS_PER_RUN):
                coded = pieces.encode(texts)
                arrays = [c.slice(begin, len(texts)) for c in rest] + [_lists(coded)]
                decoded = [pieces.decode(c) for c in coded] if with_decoded or check else []
                if check:
                    _compare(pieces, texts, coded, decoded)
                if with_decoded:
                    arrays.append(pa.array(decoded, pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, names=keep + made)

    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + ["token_ids array<int>"] + ["decoded string"] * with_decoded
    return df.select(df[text_col].alias("kw_text"), *[df[c] for c in keep]).mapInArrow(run, ", ".join(fields))


def _compare(pieces: Pieces, texts: list[str], coded: list[np.ndarray], decoded: list[str]) -> None:
    for text, ids, back in zip(texts, coded, decoded):
        theirs = pieces.library.encode(text)
        if theirs != ids.tolist() or pieces.library.decode(theirs) != back:
            raise ValueError(f"not the library's ids or text, for a text of {len(text)} characters that begins {text[:60]!r}")


def decode(df: DataFrame, model: bytes, *, ids_col: str = "token_ids") -> DataFrame:
    """``df`` with ``decoded``, the text of the ids in ``ids_col``.

    Defined cases: null or no ids decode to the empty text; repeated rows each give a row;
    an empty table gives an empty table; an input column ``decoded`` is replaced. An id
    that is null or outside the vocabulary fails the job.
    """
    keep = [c for c in df.columns if c != "decoded"]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(shared.value)
        for batch in batches:
            texts = [pieces.decode(v.as_py() or []) for v in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(1, batch.num_columns)] + [pa.array(texts, pa.string())], names=[*keep, "decoded"])

    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + ["decoded string"]
    return df.select(df[ids_col].alias("kw_ids"), *[df[c] for c in keep]).mapInArrow(run, ", ".join(fields))

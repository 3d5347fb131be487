"""Product codes of vectors, learned and assigned in whole numbers.

Components become ``floor(scale * x)``, vectors are cut into equal consecutive parts, and
each part has a codebook of its own. The nearest entry of a part is found on integer
Walsh-Hadamard transforms of the zero-padded part and entries: the transform multiplies
every squared distance by the padded length, so squared differences of coefficients are
added up in sequency order (slow sign changes first) and an entry is given up as soon as
its sum passes the whole distance of another. No step uses floating point, and numbers
that could pass 64 bits are carried as Python's whole numbers.

Codebooks are bounded by ``entries`` times the vector's length and are sent to every task.
A round of learning adds up the parts of each entry inside the tasks; only these sums are
shuffled.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pairs of a part and an entry that a task compares at once.
PAIRS_AT_ONCE = 1 << 18
#: Coefficients between two looks at what can be given up.
LOOK_EVERY = 2
#: Where less than this share of a block's pairs is left, only these are carried on.
SPARSE = 0.125
LIMB = 32


def walsh(x: np.ndarray) -> np.ndarray:
    """Rows of ``x`` (a power of two wide) transformed, coefficients in sequency order."""
    x = x.copy()
    width, half = x.shape[1], 1
    while half < width:
        y = x.reshape(len(x), width // (2 * half), 2, half)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(len(x), width)
        half *= 2
    return x[:, sequency(width)]


def sequency(width: int) -> np.ndarray:
    """Where the transform by halves holds the function with 0, 1, 2, ... sign changes."""
    bits = max(width.bit_length() - 1, 0)
    gray = np.arange(width) ^ (np.arange(width) >> 1)
    out = np.zeros(width, dtype=np.int64)
    for b in range(bits):
        out |= ((gray >> b) & 1) << (bits - 1 - b)
    return out


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``x`` the lowest index among its nearest ``entries``, and the distance; both transformed alike."""
    n, k, width = len(x), len(entries), x.shape[1]
    sums = np.zeros((n, k), dtype=x.dtype)
    rows = np.arange(n)
    for j in range(width):
        diff = x[:, j, None] - entries[None, :, j]
        diff *= diff
        sums += diff
        if j + 1 < width and (j + 1) % LOOK_EVERY == 0:
            guess = sums.argmin(1)
            bound = sums[rows, guess] + _rest(x, entries, rows, guess, j + 1)
            left = sums <= bound[:, None]
            if np.count_nonzero(left) < SPARSE * n * k:
                return _carry_on(x, entries, sums, left, bound, j + 1)
    best = sums.argmin(1)
    return best, sums[rows, best]


def _rest(x: np.ndarray, entries: np.ndarray, row: np.ndarray, entry: np.ndarray, j: int) -> np.ndarray:
    diff = x[row, j:] - entries[entry, j:]
    return (diff * diff).sum(1)


def _carry_on(x: np.ndarray, entries: np.ndarray, sums: np.ndarray, left: np.ndarray, bound: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray]:
    """The coefficients from ``j`` on, for the pairs in ``left`` only."""
    row, entry = np.nonzero(left)
    sums = sums[left]
    for j in range(j, x.shape[1]):
        diff = x[row, j] - entries[entry, j]
        sums = sums + diff * diff
        stays = sums <= bound[row]
        row, entry, sums = row[stays], entry[stays], sums[stays]
    # Pairs are by row, then entry: of those at the row's least distance the first is meant.
    first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    least = np.minimum.reduceat(sums, first)
    at = np.flatnonzero(sums == np.repeat(least, np.diff(np.append(first, len(row)))))
    at = at[np.concatenate(([True], row[at[1:]] != row[at[:-1]]))]
    return entry[at], sums[at]


@dataclass(frozen=True)
class Codebooks:
    """``books[part, entry, position]`` in whole numbers, of vectors of ``dim`` components scaled by ``scale``."""

    books: np.ndarray
    dim: int
    scale: int
    largest: float  # no scaled component is larger

    @property
    def parts(self) -> int:
        return len(self.books)

    @property
    def padded(self) -> int:
        return 1 << max(self.books.shape[2] - 1, 0).bit_length()

    @property
    def dtype(self) -> type:
        """64-bit numbers where no scaled distance can pass them."""
        return np.int64 if self.largest < math.isqrt(2**60 // (self.padded * self.books.shape[2])) else object

    def whole(self, flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """``floor(scale * x)`` of vectors laid end to end, zeros at the end of shorter ones."""
        lengths = np.diff(ends)
        out = np.zeros((len(lengths), self.dim), dtype=self.dtype)
        if self.dtype is object:
            # From 2**53 on a double is a whole number itself.
            made = np.array([int(v) * self.scale if abs(v) >= 2**53 else math.floor(v * self.scale) for v in flat.tolist()] + [None], dtype=object)[:-1]
        else:
            made = np.floor(flat * self.scale).astype(np.int64)
        out[np.arange(self.dim)[None] < lengths[:, None]] = made
        return out

    def transformed(self, part: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(part), self.padded), dtype=self.dtype)
        wide[:, : part.shape[1]] = part
        return walsh(wide)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entry of each part of each vector, and the squared distances over the parts."""
        n, width = len(x), self.books.shape[2]
        codes, errors = np.zeros((n, self.parts), dtype=np.int64), np.zeros(n, dtype=self.dtype)
        block = max(1, PAIRS_AT_ONCE // self.books.shape[1])
        for p in range(self.parts):
            entries = self.transformed(self.books[p].astype(self.dtype))
            for begin in range(0, n, block):
                at = slice(begin, begin + block)
                codes[at, p], far = nearest(self.transformed(x[at, p * width : (p + 1) * width]), entries)
                errors[at] += far // self.padded
        return codes, errors

    def text(self) -> str:
        """All components by part, entry and position, joined by commas."""
        return ",".join(map(str, self.books.ravel().tolist()))

    def sha256(self) -> str:
        return hashlib.sha256(self.text().encode()).hexdigest()


def usable(vector: Column) -> Column:
    """True for vectors without null or non-finite components, and not null themselves."""
    finite = F.forall(vector.cast("array<double>"), lambda x: F.abs(x) < F.lit(float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    ends = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]], ends - ends[0]


def learn(
    df: DataFrame, *, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding"
) -> Codebooks | None:
    """Codebooks after ``rounds`` of assigning every part to its nearest entry and taking floors of the means.

    The books start from the parts of the usable vectors with the ``entries`` smallest ids
    (ties: the smaller vector; null ids last). All usable vectors take part in every round.
    Entries that no part is assigned to stay. The result is None without usable vectors.
    """
    rows = df.where(usable(F.col(vector_col))).select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    sizes = rows.agg(F.max(F.size("v")).alias("dim"), F.max(F.array_max(F.transform("v", F.abs))).alias("largest")).first()
    if sizes.dim is None:
        return None
    dim = max(1, -(-sizes.dim // parts)) * parts
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    largest = (sizes.largest or 0.0) * scale + 1
    blank = Codebooks(np.zeros((parts, len(first), dim // parts), dtype=object), dim, scale, largest)
    start = blank.whole(np.array([x for r in first for x in r.v], dtype=np.float64), np.cumsum([0] + [len(r.v) for r in first]))
    books = start.reshape(len(first), parts, -1).transpose(1, 0, 2)
    found = Codebooks(books, dim, scale, largest)
    for _ in range(rounds):
        found = Codebooks(_moved(rows, found), dim, scale, largest)
    return found


def _moved(rows: DataFrame, now: Codebooks) -> np.ndarray:
    """The books with each entry at the floor of its parts' mean."""
    shared = rows.sparkSession.sparkContext.broadcast(now)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = shared.value
        sums, counts = np.zeros(now.books.shape, dtype=now.dtype), np.zeros(now.books.shape[:2], dtype=np.int64)
        for batch in batches:
            x = now.whole(*_vectors(batch.column(0)))
            codes, _ = now.assign(x)
            for p in range(now.parts):
                np.add.at(sums[p], codes[:, p], x.reshape(len(x), now.parts, -1)[:, p])
                counts[p] += np.bincount(codes[:, p], minlength=counts.shape[1])
        # A sum may pass 64 bits once tasks are added up: it goes in limbs, each added up on its own.
        part, entry = np.nonzero(counts)
        out: list[tuple[int, int, int, int, int]] = [(p, e, -1, 0, int(counts[p, e])) for p, e in zip(part.tolist(), entry.tolist())]
        for p, e in zip(part.tolist(), entry.tolist()):
            for at, value in enumerate(sums[p, e].tolist()):
                sign, value, limb = (-1 if value < 0 else 1), abs(value), 0
                while value:
                    out.append((p, e, at, limb, sign * (value & (2**LIMB - 1))))
                    value, limb = value >> LIMB, limb + 1
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 5, [pa.int32()] * 4 + [pa.int64()])], names=["part", "entry", "at", "limb", "total"])

    made = rows.select("v").mapInArrow(run, "part int, entry int, at int, limb int, total long")
    totals = made.groupBy("part", "entry", "at", "limb").agg(F.sum("total").alias("total")).toArrow().to_pydict()
    sums, counts = np.zeros(now.books.shape, dtype=object), np.zeros(now.books.shape[:2], dtype=object)
    for p, e, at, limb, total in zip(*totals.values()):
        if at < 0:
            counts[p, e] = total
        else:
            sums[p, e, at] += total << (LIMB * limb)
    books = now.books.astype(object)
    used = counts > 0
    books[used] = sums[used] // counts[used][:, None]
    return books


def encode(df: DataFrame, books: Codebooks | None, *, vector_col: str = "embedding", columns: list[str] | None = None) -> DataFrame:
    """``columns`` of the rows of ``df`` with a usable vector, with ``code`` and ``error``.

    ``code`` has two hex digits (more, beyond 256 entries) for each part; ``error`` is the
    squared distance to the coded vector in scaled whole numbers.

    Defined cases: vectors that are null or hold null or non-finite components give no
    row; shorter vectors end in zeros, and one longer than the books fails the job; ties
    go to the lower entry; null ids and repeated rows each give a row; an empty table gives
    an empty table; input columns named like an output are replaced. An error beyond 64
    bits fails the job.
    """
    keep = [c for c in (columns if columns is not None else [c for c in df.columns if c != vector_col]) if c not in ("code", "error")]
    rows = df.where(usable(F.col(vector_col))).select(F.col(vector_col).cast("array<double>").alias("kw_v"), *keep)
    fields = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + ["code string, error long"])
    if books is None:
        return df.sparkSession.createDataFrame([], fields)
    shared = df.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        digits = max(2, (books.books.shape[1] - 1).bit_length() + 3 >> 2)
        hexes = np.array([f"{i:0{digits}x}" for i in range(books.books.shape[1])])
        for batch in batches:
            codes, errors = books.assign(books.whole(*_vectors(batch.column(0))))
            code = hexes[codes].view(f"<U{digits * books.parts}").ravel() if len(codes) else np.zeros(0, "<U1")
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(1, batch.num_columns)] + [pa.array(code.tolist(), pa.string()), pa.array(errors.tolist(), pa.int64())], names=[*keep, "code", "error"])

    return rows.mapInArrow(run, fields)


def decode(df: DataFrame, books: Codebooks, *, code_col: str = "code") -> DataFrame:
    """``df`` with ``coded``, the scaled whole numbers that its codes stand for.

    Defined cases: a null code has a null vector; repeated rows each give a row; an empty
    table gives an empty table; an input column ``coded`` is replaced.
    """
    digits = max(2, (books.books.shape[1] - 1).bit_length() + 3 >> 2)
    spark = df.sparkSession
    kept = [c for c in df.columns if c != "coded"]
    table = [(p, f"{e:0{digits}x}", [int(v) for v in books.books[p, e]]) for p in range(books.parts) for e in range(books.books.shape[1])]
    out = df.select(*kept)
    for p in range(books.parts):
        book = spark.createDataFrame([(h, v) for q, h, v in table if q == p], f"kw_hex{p} string, kw_part{p} array<long>")
        out = out.join(F.broadcast(book), F.substring(F.col(code_col), p * digits + 1, digits) == F.col(f"kw_hex{p}"), "left")
    return out.select(*kept, F.concat(*[F.col(f"kw_part{p}") for p in range(books.parts)]).alias("coded"))

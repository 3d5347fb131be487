"""Approximate nearest neighbours by multiprobe p-stable hashing, for largest inner product.

Vectors are lifted by one coordinate to a common norm, so that the largest inner product
is the smallest distance. The norm is that of the vector's band: bands halve from the
largest norm down, so one long vector does not press all others into one place. A table
hashes a lifted vector by ``floor((a . x + b) / w)`` for a few Gaussian ``a``. A query
visits the cells of a table in the order of their estimated success, which is the sum of
squared distances from its projections to the walls that a cell lies behind, up to a
radius. The radius is set by the recall on a bounded sample of queries, measured against
brute force over every vector. A query with very many cells in the radius, or with too
few vectors found, scans every vector in blocks.

Cells are dealt to shards. A task holds one block of one shard's vectors and one block of
the queries that visit it: it works out which cells each query visits, scores their
vectors by matrix product and keeps each query's best. A crowded cell or shard is split
on both sides, and no list of cells is sent anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_QUERIES = 64
BLOCK_ROWS = 8192
BLOCK_QUERIES = 1024
#: A query with more cells than this within the radius scans every vector instead.
MOST_CELLS = 3**7
#: Norms below 2**-BANDS of the largest share the last band.
BANDS = 24


class Hashing:
    """The tables' projections, and the cells a query visits."""

    def __init__(self, dim: int, norm: float, tables: int, projections: int, width: float, seed: int):
        rng = np.random.default_rng(seed)
        self.norm, self.tables, self.width = norm, tables, width
        self.a = rng.standard_normal((tables, projections, dim + 1))
        self.b = rng.uniform(0, width, (tables, projections))
        self.mix = rng.integers(1, 2**62, projections) * 2 + 1

    def lift(self, x: np.ndarray, query: bool) -> np.ndarray:
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        if query:
            return np.hstack([x / norm, np.zeros((len(x), 1))])
        band = np.clip(np.floor(np.log2(self.norm / norm) + 1e-12), 0, BANDS)
        x = x / (self.norm / 2.0**band)
        return np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1, keepdims=True)))])

    def project(self, x: np.ndarray, query: bool, table: int) -> np.ndarray:
        return (self.lift(x, query) @ self.a[table].T + self.b[table]) / self.width

    def cells(self, x: np.ndarray, table: int) -> np.ndarray:
        return np.floor(self.project(x, False, table)).astype(np.int32)

    def shard(self, cells: np.ndarray, table: int, shards: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (cells.astype(np.int64) * self.mix).sum(-1) + table * self.mix[0]
            return ((h ^ (h >> 29)) % shards).astype(np.int32)


def _apart(p: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """The squared distance from a projection to a cell's nearest wall, zero inside; by coordinate."""
    return np.maximum(0, np.maximum(cell - p, p - cell - 1)) ** 2


def _within(p: np.ndarray, radius: float) -> np.ndarray | None:
    """The cells, however far from home, whose distances to ``p`` sum to at most ``radius``; None beyond MOST_CELLS."""
    reach = int(np.ceil(np.sqrt(radius))) + 1
    if 2 * reach + 1 > MOST_CELLS:
        return None
    cells, total = np.zeros((1, 0), dtype=np.int32), np.zeros(1)
    for x in p:
        options = np.arange(-reach, reach + 1) + int(np.floor(x))
        sums = total[:, None] + _apart(x, options)
        i, j = np.nonzero(sums <= radius)
        # Home adds nothing, so each of these leads to a cell within the radius.
        if len(i) > MOST_CELLS:
            return None
        cells, total = np.hstack([cells[i], options[j][:, None].astype(np.int32)]), sums[i, j]
    return cells


def usable(vector: Column) -> Column:
    """Not null, not all zero, every component present and finite."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda v: v != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows of ``dim`` doubles, shorter ones ended with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) == len(column) * dim:
        return flat.reshape(len(column), dim)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dim))
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(column)), sizes), at] = flat
    return out


def _best(scores: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row, the places of its k largest finite scores, with all that all but tie with the last."""
    n = scores.shape[1]
    floor_ = np.partition(scores, n - k, axis=1)[:, n - k] if n > k else np.full(len(scores), -np.inf)
    slack = 1e-9 * np.maximum(1e-300, np.abs(np.where(np.isfinite(floor_), floor_, 0)))
    for i in range(len(scores)):
        row = scores[i]
        yield i, np.flatnonzero((row >= floor_[i] - slack[i]) & (row > -np.inf))


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products in double precision, the same for a pair wherever it is worked out."""
    return np.einsum("j,ij->i", q, x)


def _sample_truth(reps: DataFrame, sample: np.ndarray, k: int) -> list[np.ndarray]:
    """For each sample query, the vectors of its k nearest by brute force."""
    dim = sample.shape[1]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_q, kept_s, kept_v = np.zeros(0, int), np.zeros(0), np.zeros((0, dim))
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_ROWS):
                x = _matrix(batch.column(0).slice(begin, BLOCK_ROWS), dim)
                scores = sample @ x.T
                own = np.einsum("ij,ij->i", sample, sample)[:, None]
                i, j = np.nonzero(np.abs(scores - own) <= 1e-9 * own)
                same = (x[j] == sample[i]).all(1)
                scores[i[same], j[same]] = -np.inf  # the query itself and its copies
                rows = [(np.full(len(at), i), scores[i, at], x[at]) for i, at in _best(scores, k)]
                q = np.concatenate([kept_q, *(r[0] for r in rows)])
                s = np.concatenate([kept_s, *(r[1] for r in rows)])
                v = np.vstack([kept_v, *(r[2] for r in rows)])
                order = np.lexsort((-s, q))
                place = np.arange(len(order)) - np.searchsorted(q[order], q[order])
                order = order[place < k]
                kept_q, kept_s, kept_v = q[order], s[order], v[order]
        if len(kept_q):
            yield pa.RecordBatch.from_arrays([pa.array(kept_q, pa.int32()), pa.array(kept_s), pa.array(list(kept_v), pa.list_(pa.float64()))], names=["q", "s", "v"])

    found = reps.select("vec").mapInArrow(scan, "q int, s double, v array<double>")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s")))
    top = found.withColumn("place", place).where(F.col("place") <= k).select("q", "v").collect()  # k rows a sample query
    truth: list[list] = [[] for _ in sample]
    for r in top:
        truth[r.q].append(r.v)
    return [np.array(v, dtype=np.float64) for v in truth]


def _radius(hashing: Hashing, sample: np.ndarray, truth: list[np.ndarray], recall: float) -> float:
    """The least radius that finds the share ``recall`` of the sample's true neighbours."""
    need: list[float] = []
    for q, near in zip(sample, truth):
        if len(near):
            apart = [_apart(hashing.project(q[None], True, t), hashing.cells(near, t)).sum(1) for t in range(hashing.tables)]
            need += np.min(apart, axis=0).tolist()
    if not need:
        return 0.0
    return float(np.sort(need)[min(len(need) - 1, int(np.ceil(recall * len(need))) - 1)]) * (1 + 1e-9) + 1e-9


def _scorer(hashing: Hashing, dim: int, radius: float | None, k: int):
    """Scores one block of queries against one block of vectors of one table; all of them if ``radius`` is None."""

    def visited(x: np.ndarray, q: np.ndarray, table: int) -> np.ndarray:
        cells, of = np.unique(hashing.cells(x, table), axis=0, return_inverse=True)
        p = hashing.project(q, True, table)
        total = np.zeros((len(q), len(cells)))
        for j in range(cells.shape[1]):
            values, at = np.unique(cells[:, j], return_inverse=True)  # few steps along one projection
            total += _apart(p[:, j : j + 1], values[None])[:, at]
        return (total <= radius)[:, of.ravel()]

    def score(block: pa.Table) -> pa.Table:
        asks = block.column("asks").to_numpy()
        base, want = block.filter(pa.array(asks == 0)), block.filter(pa.array(asks == 1))
        out_q, out_r, out_s = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if base.num_rows and want.num_rows:
            x, q = _matrix(base.column("vec"), dim), _matrix(want.column("vec"), dim)
            ids, q_ids = base.column("rep").to_numpy(), want.column("rep").to_numpy()
            table = int(base.column("t")[0].as_py())
            for begin in range(0, len(q), 256):
                part = q[begin : begin + 256]
                scores = part @ x.T
                if radius is not None:
                    scores[~visited(x, part, table)] = -np.inf
                for i, at in _best(scores, k + 1):
                    s = exact(part[i], x[at])
                    order = np.lexsort((ids[at], -s))[: k + 1]
                    out_q.append(np.full(len(order), q_ids[begin + i]))
                    out_r.append(ids[at][order])
                    out_s.append(s[order])
        return pa.table({"q": pa.array(np.concatenate(out_q), pa.int64()), "rep": pa.array(np.concatenate(out_r), pa.int64()), "score": pa.array(np.concatenate(out_s), pa.float64())})

    return score


def nearest(
    df: DataFrame,
    queries: Column,
    *,
    k: int = 20,
    tables: int = 2,
    projections: int = 7,
    width: float = 1.6,
    recall: float = 0.96,
    seed: int = 7,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of each row where ``queries`` holds.

    Every row but the query's own is a candidate; scores are inner products in double
    precision. ``recall`` is aimed at on a sample of SAMPLE_QUERIES queries (the bound of
    the fitted part); every row is indexed.

    Defined cases: vectors that are null, zero, or hold a null or non-finite component
    take no part, nor rows with a null id; of vectors of different lengths the shorter
    counts as ended with zeros; equal vectors are searched once and all their rows
    returned, ties to the smaller id; a repeated id counts once for each distinct vector
    it has; an empty table, or one without queries, gives an empty table; other columns
    are not read.
    """
    from kinweave.session import materialise

    spark = df.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    # Floats become doubles without loss; the narrower type is what is stored and sent.
    narrow = "array<float>" if df.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(narrow).alias("vec"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vec")))
    # Equal vectors are one class; its k + 1 smallest ids are all that any query can need.
    same = Window.partitionBy("h", "g").orderBy("id")
    keyed = rows.select("id", "vec", "asks", F.xxhash64("vec").alias("h"), F.xxhash64(F.lit(1), "vec").alias("g"))
    members = materialise(keyed.dropDuplicates(["h", "g", "id"]).withColumn("place", F.row_number().over(same)).where(F.col("place") <= k + 1).drop("asks"), "ann-classes")
    reps = members.where("place = 1").select(F.col("id").alias("rep"), "vec", "h", "g")
    asking = materialise(keyed.where("asks").select("id", "h", "g").distinct(), "ann-asking")
    askers = materialise(reps.join(asking.select("h", "g").distinct(), ["h", "g"]).select("rep", "vec"), "ann-askers")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    stat = reps.agg(F.max(norm).alias("norm"), F.max(F.size("vec")).alias("dim"), F.count("*").alias("n")).first()
    sample_rows = askers.orderBy(F.xxhash64(F.lit(seed), "rep"), "rep").limit(SAMPLE_QUERIES).collect()
    if not sample_rows:
        return spark.createDataFrame([], result)
    dim = stat.dim
    hashing = Hashing(dim, float(stat.norm), tables, projections, width, seed)
    sample = _matrix(pa.array([r.vec for r in sample_rows], pa.list_(pa.float64())), dim)
    radius = _radius(hashing, sample, _sample_truth(reps, sample, k), recall)
    shards = max(1, -(-stat.n // BLOCK_ROWS))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            for t in range(tables):
                at = hashing.shard(hashing.cells(x, t), t, shards)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t), pa.int32()), pa.array(at, pa.int32()), batch.column(0), batch.column(1)], names=["t", "shard", "rep", "vec"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                q = _matrix(part.column(1), dim)
                cells = [[_within(p, radius) for p in hashing.project(q, True, t)] for t in range(tables)]
                wide = [any(c[i] is None for c in cells) for i in range(len(q))]
                for t in range(tables):
                    found = [(i, s) for i in range(len(q)) if not wide[i] for s in np.unique(hashing.shard(cells[t][i], t, shards)).tolist()]
                    which = pa.array([f[0] for f in found], pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(found), t), pa.int32()), pa.array([f[1] for f in found], pa.int32()), part.column(0).take(which), part.column(1).take(which)], names=["t", "shard", "rep", "vec"]
                    )

    shape = f"t int, shard int, rep long, vec {narrow}"
    data = reps.select("rep", "vec").mapInArrow(place, shape)

    def search(data: DataFrame, asks: DataFrame, radius: float | None) -> DataFrame:
        # How often each shard must be split: two counts a shard, at most tables * n / BLOCK_ROWS rows.
        n_data = data.groupBy("t", "shard").agg(F.count("*").alias("nd"))
        n_asks = asks.groupBy("t", "shard").agg(F.count("*").alias("nq"))
        split = n_data.join(n_asks, ["t", "shard"]).select(
            "t", "shard", F.ceil(F.col("nd") / BLOCK_ROWS).cast("int").alias("bd"), F.ceil(F.col("nq") / BLOCK_QUERIES).cast("int").alias("bq")
        )
        split = materialise(split, "ann-split")
        own = F.xxhash64("rep")
        left = data.join(split, ["t", "shard"]).select("t", "shard", "rep", "vec", F.lit(0).alias("asks"), F.pmod(own, "bd").cast("int").alias("d"), F.explode(F.expr("sequence(0, bq - 1)")).alias("q"))
        right = asks.join(split, ["t", "shard"]).select("t", "shard", "rep", "vec", F.lit(1).alias("asks"), F.explode(F.expr("sequence(0, bd - 1)")).alias("d"), F.pmod(own, "bq").cast("int").alias("q"))
        return left.unionByName(right).groupBy("t", "shard", "d", "q").applyInArrow(_scorer(hashing, dim, radius, k), "q long, rep long, score double")

    best = lambda found: found.groupBy("q", "rep").agg(F.max("score").alias("score"))
    asks = materialise(askers.mapInArrow(visit, shape), "ann-visits")
    found = materialise(best(search(data, asks, radius)), "ann-found")
    # Queries with too many cells, or whose cells held too few vectors, scan all of them: plain blocks instead of cells.
    counts = found.groupBy(F.col("q").alias("rep")).agg(F.count("*").alias("held"))
    short = askers.join(counts, "rep", "left").where(F.coalesce("held", F.lit(0)) < min(k + 1, stat.n)).select("rep", "vec")
    short = materialise(short, "ann-short")
    if not short.isEmpty():
        blocks = reps.select(F.lit(0).alias("t"), F.pmod(F.xxhash64("rep"), F.lit(shards)).cast("int").alias("shard"), "rep", "vec")
        every = short.select(F.lit(0).alias("t"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "rep", "vec")
        found = materialise(best(found.unionByName(search(blocks, every, None))), "ann-found")
    top = found.withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "rep"))).where(F.col("place") <= k + 1)
    # From classes back to rows: the members of each class found, and the rows that ask by each class.
    id_of = members.where("place = 1").select(F.col("id").alias("rep"), "h", "g")
    wide = top.select("q", "rep", "score").join(id_of, "rep").join(members.select("h", "g", F.col("id").alias("vec_id")), ["h", "g"])
    first = wide.withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).where(F.col("place") <= k + 1)
    who = asking.join(id_of, ["h", "g"]).select("id", F.col("rep").alias("q"))
    each = first.select("q", "vec_id", "score").join(who, "q").where(F.col("id") != F.col("vec_id"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("id").alias("query_id"), "rank", "vec_id", "score")

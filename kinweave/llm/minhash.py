"""Near-duplicate documents by b-bit MinHash.

Each text becomes a set of hashed word shingles. Of every minimum over PERMUTATIONS hash
functions the low BITS bits are kept and packed; whole minima are only used to form band
keys. Texts with equal sets are one class. Classes that share a band are candidates; the
similarity of a candidate pair is estimated from the bit counts of the packed signatures,
corrected for chance collisions, and every pair that the estimate does not rule out (five
standard deviations) is confirmed on the full sets.

A band may hold thousands of near copies, so pairs within a band are not spelled out:

1. Every member is paired with the smallest member of its band, and these pairs are
   confirmed. What links up is a component already.
2. Only bands that still hold several components go on. Their members are cut into
   blocks by set size and component; two blocks meet once if any band has members of
   both, and are searched for links between different components. Pairs inside a
   component, and blocks that share no band, need no test. This exact step leaves no
   link out that a band shows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PERMUTATIONS = 192
BITS = 4
BLOCK = 128
MISS = 1e-6
#: The bit set that finds the texts of candidates has some ten bits an id, at most so many; beyond it the ids are joined.
MOST_BLOOM_BITS = 1 << 28
#: Tables of at most so many rows of five numbers are sent to every task; larger ones are shuffled.
MAX_BROADCAST_ROWS = 200_000
_SHINGLE = np.uint64(0x9E3779B97F4A7C15)


def rows_per_band(threshold: float) -> int:
    """The most rows a band can have while a pair at the threshold is missed with at most MISS."""
    fits = [r for r in range(1, 17) if (1 - threshold**r) ** (PERMUTATIONS // r) <= MISS]
    return max(fits, default=1)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Collision-corrected similarity of packed signatures, every row of ``a`` with every row of ``b``."""
    differ = a[:, None, :] ^ b[None, :, :]
    differ |= differ >> np.uint64(2)
    differ |= differ >> np.uint64(1)
    differ &= np.uint64(0x1111111111111111)
    share = 1 - np.bitwise_count(differ).sum(-1) / PERMUTATIONS
    return (share - 2.0**-BITS) / (1 - 2.0**-BITS)


def slack(threshold: float) -> float:
    """The estimate below which a pair at the threshold is not expected: five standard deviations."""
    share = threshold + (1 - threshold) * 2.0**-BITS
    return threshold - 5 * math.sqrt(share * (1 - share) / PERMUTATIONS) / (1 - 2.0**-BITS)


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of the word shingles of each text.

    Words are the runs between ASCII white space with A-Z lowered; a text of fewer words
    than ``width`` has its whole sequence as one shingle, one without words none.
    """
    words = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    flat = np.empty(sum(map(len, words)), dtype=object)
    flat[:] = [w for ws in words for w in ws]
    hashes = pd.util.hash_array(flat, categorize=False) if len(flat) else np.zeros(0, np.uint64)
    out, at = [], 0
    for ws in words:
        h = hashes[at : at + len(ws)]
        at += len(ws)
        n = min(width, len(ws))
        if not n:
            out.append(h)
            continue
        mixed = np.full(len(h) - n + 1, n, dtype=np.uint64)
        for j in range(n):
            mixed = (mixed ^ h[j : j + len(mixed)]) * _SHINGLE
            mixed ^= mixed >> np.uint64(29)
        out.append(np.unique(mixed))
    return out


class Signer:
    """Minima, packed signatures and band keys of shingle sets."""

    def __init__(self, threshold: float, seed: int):
        rng = np.random.default_rng(seed)
        self.a = (rng.integers(0, 2**31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.b = rng.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)[:, None]
        self.rows = rows_per_band(threshold)
        self.bands = PERMUTATIONS // self.rows
        self.mix = rng.integers(0, 2**63, (self.bands, self.rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.salt = rng.integers(0, 2**63, self.bands, dtype=np.uint64)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        low = np.full(PERMUTATIONS, 0xFFFFFFFF, dtype=np.uint32)
        for i in range(0, len(x), 4096):
            np.minimum(low, (self.a * x[None, i : i + 4096] + self.b).min(1), out=low)
        return low

    def pack(self, minima: np.ndarray) -> bytes:
        low = (minima & np.uint32(2**BITS - 1)).astype(np.uint8)
        return (low[0::2] | (low[1::2] << 4)).tobytes()

    def keys(self, minima: np.ndarray) -> np.ndarray:
        m = minima[: self.bands * self.rows].reshape(self.bands, self.rows).astype(np.uint64)
        h = ((m + np.uint64(1)) * self.mix).sum(1) + self.salt
        h ^= h >> np.uint64(32)
        return (h * _SHINGLE).view(np.int64)


def _set_hash(s: np.ndarray) -> tuple[int, int]:
    one = (s ^ (s >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    two = (s ^ (s >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    both = np.array([one.sum(dtype=np.uint64), (two ^ (two >> np.uint64(33))).sum(dtype=np.uint64)], dtype=np.uint64)
    return tuple(both.view(np.int64).tolist())


def _texts(batch: pa.RecordBatch, docs: int = 256) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    for begin in range(0, batch.num_rows, docs):
        part = batch.slice(begin, docs)
        yield part, part.column(1).to_pylist()


def _features(df: DataFrame, width: int, threshold: float, seed: int) -> DataFrame:
    signer = Signer(threshold, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _texts(batch):
                n, one, two, sig, keys = [], [], [], [], []
                for s in shingle_sets(texts, width):
                    a, b = _set_hash(s)
                    minima = signer.minima(s)
                    n.append(len(s))
                    one.append(a)
                    two.append(b)
                    sig.append(signer.pack(minima))
                    keys.append(signer.keys(minima) if len(s) else [])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(sig, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["id", "n", "h", "g", "sig", "keys"],
                )

    return df.mapInArrow(run, "id long, n long, h long, g long, sig binary, keys array<long>")


def _bloom(nodes: DataFrame, seed: int, bits: int) -> np.ndarray:
    """A set of ``bits`` bits that holds every ``low`` of ``nodes``; a few other ids pass it too."""
    place = F.pmod(F.xxhash64(F.lit(seed), "low"), F.lit(bits))
    words = nodes.select(F.shiftright(place, 5).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(32)).cast("int")).alias("bit"))
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most bits / 32 rows
    out = np.zeros(bits // 32, dtype=np.uint32)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return out


def _sets(df: DataFrame, nodes: DataFrame, width: int, seed: int) -> DataFrame:
    """``node, items``: the full sets of ``nodes`` (``node, low, n, h, g``), made again from a text of the id ``low``."""
    size = 1 << max(20, int(10 * nodes.count()).bit_length())
    texts = df.where("id is not null")
    held = None
    if size <= MOST_BLOOM_BITS:
        held = df.sparkSession.sparkContext.broadcast(_bloom(nodes, seed, size))
    else:
        texts = texts.join(nodes.select(F.col("low").alias("id")), "id", "left_semi")
    place = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if held is not None:
                at = batch.column(2).to_numpy()
                batch = batch.filter(pa.array((held.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1))
            for part, texts in _texts(batch):
                sets = shingle_sets(texts, width)
                hashes = [_set_hash(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([h[0] for h in hashes], pa.int64()), pa.array([h[1] for h in hashes], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    names=["low", "h", "g", "items"],
                )

    made = texts.select("id", "text", place.alias("place")).mapInArrow(run, "low long, h long, g long, items array<long>")
    found = made.withColumn("n", F.size("items").cast("long")).join(nodes.select("node", "low", "h", "g", "n"), ["low", "h", "g", "n"])
    return found.dropDuplicates(["node"]).select("node", "items")


def _block_links(threshold: int, floor_: float):
    """Searches a pair of blocks (side 0 and 1, or one block with itself) for links between components."""

    def run(block: pa.Table) -> pa.Table:
        side = block.column("side").to_numpy()
        node, n = block.column("node").to_numpy(), block.column("n").to_numpy()
        _, component = np.unique(block.column("component").to_numpy(), return_inverse=True)
        sig = np.frombuffer(b"".join(block.column("sig").to_pylist()), dtype=np.uint64).reshape(len(node), -1)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(right):
            right = left
        items = block.column("items").combine_chunks()
        ends, flat = items.offsets.to_numpy(), items.values.to_numpy()
        of = lambda i: flat[ends[i] : ends[i + 1]]
        parent = list(range(component.max() + 1)) if len(node) else []

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        owner = np.repeat(np.arange(len(right)), [len(of(i)) for i in right])
        pool = np.concatenate([of(i) for i in right]) if len(right) else np.zeros(0, np.int64)
        order = np.argsort(pool, kind="stable")
        pool, owner = pool[order], owner[order]
        found: list[tuple[int, int]] = []
        size_r = n[right]
        for i, guess in zip(left, estimate(sig[left], sig[right]) if len(left) else []):
            fits = (guess >= floor_) & (component[right] != component[i])
            fits &= 100 * np.minimum(n[i], size_r) >= threshold * np.maximum(n[i], size_r)
            if not fits.any():
                continue
            begin, end = np.searchsorted(pool, of(i), "left"), np.searchsorted(pool, of(i), "right")
            length = end - begin
            at = np.repeat(begin - np.concatenate(([0], np.cumsum(length)[:-1])), length) + np.arange(length.sum())
            common = np.bincount(owner[at], minlength=len(right))
            for j in np.flatnonzero(fits & (100 * common >= threshold * (n[i] + size_r - common))):
                a, b = root(int(component[i])), root(int(component[right[j]]))
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    found.append((int(node[i]), int(node[right[j]])))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return run


def _ties(stars: DataFrame, node: str, centre: str) -> DataFrame:
    """``node, low``: fewer edges with the same components as the stars ``node, centre``.

    A node meets up to one centre a band; the smallest of them stands for all: one edge
    for each node, and one for each centre and the centre it is tied to.
    """
    pairs = stars.select(F.col(node).alias("node"), F.col(centre).alias("centre"))
    tied = pairs.groupBy("node").agg(F.min("centre").alias("low"))
    return tied.union(pairs.join(tied, "node").where("centre <> low").select("centre", "low")).distinct()


def near_duplicates(df: DataFrame, *, width: int = 5, percent: int = 80, seed: int = 11, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` for each row of ``df``.

    Two texts are linked if ``100 * common >= percent * union`` over their sets of
    ``width``-word shingles. A component's id is the smallest id in it, and its row of
    that id is the one kept.

    Defined cases: a text that is null or has no words has an empty set, is linked with
    nothing and kept; a row with a null id is linked with nothing, has a null component
    and is kept; repeated rows each give a row with the same answer; each of several texts
    of one id is linked on its own, as if it were of an id of its own; an empty table
    gives an empty table; other columns are not read.
    """
    from kinweave.operators.graph import connected_components
    from kinweave.session import materialise

    threshold, floor_ = percent / 100, slack(percent / 100)
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    feats = materialise(_features(docs, width, threshold, seed), "mh-features")
    some = feats.where("n > 0 and id is not null")
    # A class is one set of shingles, whatever ids its texts have. Numbers follow the smallest ids, so
    # that a band's centre is its first text, and are fixed once written.
    classes = some.groupBy("h", "g", "n").agg(F.min("id").alias("low"))
    classes = classes.repartitionByRange("low", "h", "g", "n").sortWithinPartitions("low", "h", "g", "n").withColumn("node", F.monotonically_increasing_id())
    classes = materialise(classes, "mh-classes")
    reps = some.join(classes.withColumnRenamed("low", "id"), ["h", "g", "n", "id"]).dropDuplicates(["node"])
    reps = materialise(reps.select("node", F.col("id").alias("low"), "n", "h", "g", "sig", "keys"), "mh-reps")

    # Candidates: each member of a band with its smallest member.
    banded = reps.select("node", F.explode("keys").alias("key"))
    centres = banded.groupBy("key").agg(F.min("node").alias("centre"), F.max("node").alias("other")).where("centre < other").select("key", "centre")
    stars = materialise(banded.join(centres, "key").where("node <> centre").select("node", "centre").distinct(), "mh-stars")
    nodes = materialise(stars.select("node").union(stars.select("centre")).distinct().join(reps.drop("keys"), "node"), "mh-nodes")
    sets = materialise(_sets(docs, nodes, width, seed), "mh-sets")

    # The estimate first, on packed signatures; what it does not rule out is confirmed on full sets.
    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint64).reshape(batch.num_rows, -1) for c in (2, 3))
            guess = np.array([estimate(x[None], y[None])[0, 0] for x, y in zip(a, b)])
            yield batch.select([0, 1]).filter(pa.array(guess >= floor_))

    sides = nodes.select("node", "n", "sig")
    paired = stars.join(sides, "node").join(sides.select(F.col("node").alias("centre"), F.col("n").alias("m"), F.col("sig").alias("centre_sig")), "centre")
    paired = paired.where(F.lit(100) * F.least("n", "m") >= F.lit(percent) * F.greatest("n", "m")).select("node", "centre", "sig", "centre_sig")
    paired = paired.mapInArrow(likely, "node long, centre long")
    common = F.size(F.array_intersect("items", "centre_items"))
    checked = paired.join(sets, "node").join(sets.select(F.col("node").alias("centre"), F.col("items").alias("centre_items")), "centre")
    linked = checked.where(F.lit(100) * common >= F.lit(percent) * (F.size("items") + F.size("centre_items") - common))
    links = materialise(linked.select(F.col("node").alias("a"), F.col("centre").alias("b")), "mh-links")

    # Bands that still hold several components: blocks against blocks. Clusters only say which texts to put in one block.
    component = connected_components(_ties(links, "a", "b"), "node", "low")
    cluster = connected_components(_ties(stars, "node", "centre"), "node", "low")
    placed = (
        nodes.select("node", "n")
        .join(cluster.select("node", F.col("component").alias("cluster")), "node")
        .join(component, "node", "left")
        .select("node", "n", "cluster", F.coalesce("component", "node").alias("component"))
    )
    several = placed.groupBy("cluster").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("cluster")
    band = F.floor(F.log("n") / -math.log(threshold)).cast("int")
    placed = materialise(placed.join(several, "cluster").withColumn("band", band), "mh-several")
    members = banded.join(placed.select("node", "component"), "node")
    mixed = members.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    members = materialise(members.join(mixed, "key").select("key", "node"), "mh-members")
    placed = materialise(placed.join(members.select("node").distinct(), "node"), "mh-open")
    whole = placed.groupBy("cluster", "band", "component").agg(F.count("*").alias("size"))
    # A component larger than a block has blocks of its own; the others of a cluster share theirs.
    whole = materialise(whole, "mh-sizes")
    hint = F.broadcast if whole.count() <= MAX_BROADCAST_ROWS else (lambda df: df)
    whole = whole.withColumn("pool", F.when(F.col("size") > BLOCK, F.col("component").cast("string")).otherwise(""))
    pools = whole.groupBy("cluster", "band", "pool").agg(F.sum("size").alias("total"))
    placed = (
        placed.join(hint(whole.drop("size")), ["cluster", "band", "component"])
        .join(hint(pools), ["cluster", "band", "pool"])
        .withColumn("salt", F.pmod(F.xxhash64("node"), F.ceil(F.col("total") / BLOCK)))
        .select("node", "band", "component", "pool", F.xxhash64("cluster", "band", "pool", "salt").alias("block"))
    )
    placed = materialise(placed, "mh-placed")
    members = materialise(members.join(placed.select("node", "band", "pool", "block"), "node"), "mh-blocks")
    held = members.groupBy("key", "band", "pool", "block").agg(F.count("*").alias("size"))
    one, two = held.alias("x"), held.alias("y")
    meets = (
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.block") <= F.col("y.block"))
        & (F.abs(F.col("x.band") - F.col("y.band")) <= 1)
        & ((F.col("x.pool") == "") | (F.col("x.pool") != F.col("y.pool")))
        & ((F.col("x.block") != F.col("y.block")) | (F.col("x.size") > 1))
    )
    duels = one.join(two, meets).select(F.col("x.block").alias("b0"), F.col("y.block").alias("b1")).distinct()
    seats = duels.select("b0", "b1", F.explode(F.expr("if(b0 = b1, array(struct(b0 as block, 0 as side)), array(struct(b0 as block, 0 as side), struct(b1 as block, 1 as side)))")).alias("s"))
    seats = seats.select("b0", "b1", F.col("s.block").alias("block"), F.col("s.side").alias("side"))
    full = placed.select("node", "component", "block").join(nodes.select("node", "n", "sig"), "node").join(sets, "node")
    more = seats.join(full, "block").groupBy("b0", "b1").applyInArrow(_block_links(percent, floor_), "a long, b long")
    more = materialise(more, "mh-more")
    if more.limit(1).count():
        component = connected_components(_ties(links.union(more), "a", "b"), "node", "low")

    least = component.join(classes.select("node", "low"), "node").groupBy("component").agg(F.min("low").alias("least"))
    of_node = component.join(least, "component").select("node", "least")
    reach = classes.join(of_node, "node", "left").select("h", "g", "n", F.coalesce("least", "low").alias("component"))
    out = feats.select("id", "n", "h", "g").join(reach, ["h", "g", "n"], "left")
    found = F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), found.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))
    )

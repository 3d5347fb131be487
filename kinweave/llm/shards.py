"""Training-order materialisation of token sequences as fixed-stride shards.

Every sequence has a place in the order of the input; a keyed Feistel permutation with
cycle-walking maps the places 0..N-1 onto slots 0..N-1. Slots are cut into shards (range
partitions of the slots), and each shard is written in slot order with one record of
fixed length a slot, so that a reader finds slot s at byte ``(s - first slot) * stride``
and can resume anywhere. A token id takes 1, 2 or 4 bytes, the lowest first.

Spark's own text writer writes the records (as raw bytes, each closed by a line end), so
shards go to any file system Spark writes and are committed as its output is: a lost
executor's files are made again.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 4
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)


def feistel(places: np.ndarray, total: int, key: int) -> np.ndarray:
    """The slots of ``places``: a permutation of 0..total-1 that depends on ``key``."""
    half = max(1, (max(total - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(key).integers(0, 2**63, ROUNDS, dtype=np.uint64)
    out = places.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):  # walk on while outside; the domain is less than four times the total
        x = out[todo]
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            f = (right + k) * np.uint64(_MIX[0])
            f = (f ^ (f >> np.uint64(29))) * np.uint64(_MIX[1])
            left, right = right, left ^ ((f ^ (f >> np.uint64(32))) & mask)
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= total]
    return out.astype(np.int64)


def sequence_count(tokens: Column, length: int) -> Column:
    """Sequences of a text of that many tokens: at least one."""
    return F.greatest(F.ceil(tokens / F.lit(length)), F.lit(1)).cast("int")


def _payloads(column: pa.Array, width: int) -> list[memoryview | bytes]:
    """The bytes of each row: binary as it is, ids as little-endian numbers of ``width`` bytes; null is empty."""
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        return [v.as_buffer() if v.is_valid else b"" for v in column]
    sizes = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    ids = column.flatten().to_numpy(zero_copy_only=False)
    if len(ids) and not (0 <= ids.min() and ids.max() < 1 << 8 * width):  # also where one is null
        raise ValueError(f"token ids must lie in 0..{(1 << 8 * width) - 1}")
    flat, ends = memoryview(ids.astype(f"<u{width}").tobytes()), (np.cumsum(sizes) * width).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends)]


def _records(payloads: list, record: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """How many sequences each row has, the bytes each holds, and the sequences padded with zeros."""
    sizes = np.array([len(p) for p in payloads], dtype=np.int64)
    counts = np.maximum(1, -(-sizes // record))
    first = np.cumsum(counts) - counts
    out = bytearray(int(counts.sum()) * record)
    for at, p in zip((first * record).tolist(), payloads):
        out[at : at + len(p)] = p
    held = np.clip(np.repeat(sizes, counts) - (np.arange(counts.sum()) - np.repeat(first, counts)) * record, 0, record)
    ends = pa.py_buffer((np.arange(len(held) + 1) * record).astype(np.int32))
    return counts, held, pa.Array.from_buffers(pa.binary(), len(held), [None, ends, pa.py_buffer(bytes(out))])


@contextmanager
def _shuffle_cleanup(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of a query when it ends, not when the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def write_shards(
    df: DataFrame,
    path: str,
    *,
    length: int = 256,
    records_per_shard: int = 32_768,
    key: int = 20260831,
    waves: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    ids_col: str | None = None,
    width: int = 1,
) -> DataFrame:
    """Writes every row's whole sequence of token ids as shards; returns the index.

    The ids are those of ``ids_col`` (array<int>, each below ``256 ** width``, ``width`` 1,
    2 or 4), or without it the UTF-8 bytes of ``text_col`` as ids 0..255. A row is cut
    into sequences of ``length`` ids, the last one padded with zeros. Records lie at
    ``{path}/shard=K/``, one file a shard, ``length * width + 1`` bytes a record. The
    shards are written in ``waves``: each wave reads the input and shuffles its own shards
    only, and its shuffle files are removed when it ends, so that the disk needed beside
    the shards is one wave's share.
    Index rows: ``id_col, sequence, place, slot, shard, byte_offset, n_tokens``.

    Places follow the partitions of ``df`` and the rows in them, as Spark numbers them;
    ``df`` must give them alike each time it is read (files, or a written table). The
    sequences of each partition are counted first (one row a partition on the driver), and
    a task whose partition has another count fails: the input then changed, or was split
    in another way. The bytes written are compared with the counts as well.

    Defined cases: null or no ids, and a null or empty text, give one sequence without
    tokens; ids out of range and nulls among ids fail the job; null document ids stay
    null; repeated rows have sequences of their own; an empty table writes nothing and
    gives an empty index; other columns are not read. A lost executor's shards are
    written again.
    """
    if width not in (1, 2, 4) or (ids_col is None and width != 1):
        raise ValueError("width is 1, 2 or 4 bytes, and 1 for texts")
    spark = df.sparkSession
    stride = length * width + 1
    payload = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8") if ids_col is None else F.col(ids_col).cast("array<int>")
    size = F.octet_length("payload") if ids_col is None else F.greatest(F.size(F.coalesce("payload", F.array().cast("array<int>"))), F.lit(0)) * width
    rows = df.select(F.col(id_col).alias("id"), payload.alias("payload"))
    counted = rows.select(sequence_count(size, length * width).alias("n"))
    per = counted.groupBy(F.spark_partition_id().alias("part")).agg(F.sum("n").alias("n")).collect()
    starts, total = {}, 0
    for r in sorted(per, key=lambda r: r.part):
        starts[r.part] = (total, r.n)
        total += r.n
    held = spark.sparkContext.broadcast(starts)

    def cut(pieces: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            begin, expected = held.value.get(TaskContext.get().partitionId(), (0, 0))
            done = 0
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    counts, sizes, records = _records(_payloads(part.column(1), width), length * width)
                    place = begin + done + np.arange(len(sizes))
                    done += len(sizes)
                    slot = pa.array(feistel(place, max(total, 1), key))
                    if pieces:
                        yield pa.RecordBatch.from_arrays([slot, records], names=["slot", "piece"])
                    else:
                        which = np.repeat(np.arange(len(counts)), counts)
                        number = np.arange(len(sizes)) - np.repeat(np.cumsum(counts) - counts, counts)
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).take(pa.array(which)), pa.array(number, pa.int32()), pa.array(place), slot, pa.array(sizes // width, pa.int32())], names=["id", "sequence", "place", "slot", "n_tokens"]
                        )
            if done != expected:
                raise ValueError(f"the input changed between two readings: {done} sequences, {expected} counted")

        return run

    shard = F.floor(F.col("slot") / records_per_shard).cast("int")
    kind = df.schema[id_col].dataType.simpleString()
    index = rows.mapInArrow(cut(False), f"id {kind}, sequence int, place long, slot long, n_tokens int").select(
        F.col("id").alias(id_col), "sequence", "place", "slot", shard.alias("shard"), (F.pmod("slot", F.lit(records_per_shard)) * stride).alias("byte_offset"), "n_tokens"
    )
    if not total:
        return index
    shards = -(-total // records_per_shard)
    numbered = rows.mapInArrow(cut(True), "slot long, piece binary")
    with _shuffle_cleanup(spark):
        for wave in range(waves):
            low, high = wave * shards // waves, (wave + 1) * shards // waves
            if low == high:
                continue
            # Each shard is the partition of its own range of slots.
            own = numbered.where(F.col("slot").between(low * records_per_shard, high * records_per_shard - 1))
            dealt = own.repartitionById(high - low, shard - low).withColumn("shard", shard).sortWithinPartitions("shard", "slot")
            dealt.select("shard", F.col("piece").cast("string").alias("value")).write.mode("append").partitionBy("shard").option("lineSep", "\n").text(path)
    written = shard_files(spark, path).agg(F.sum("length")).first()[0]
    if written != total * stride:
        raise ValueError(f"the input changed between two readings: {written} bytes for {total} sequences")
    return index


def shard_files(spark: SparkSession, path: str) -> DataFrame:
    """The shards under ``path``: their files and lengths (Spark's binary file source)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("shard", "path", "length")


def read_records(spark: SparkSession, path: str, *, length: int = 256, records_per_shard: int = 32_768, first_slot: int = 0, width: int = 1) -> DataFrame:
    """``slot, tokens`` from ``first_slot`` on: a reader that resumes there.

    Shards before it are not opened; each shard is a bounded value of
    ``records_per_shard * (length * width + 1)`` bytes. ``tokens`` are the record's bytes,
    padding included; see ``token_ids``. Defined cases: a first slot beyond the last gives
    an empty table; the parameters must be those of the writing.
    """
    stride = length * width + 1
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    files = files.where(F.col("shard") >= first_slot // records_per_shard)
    at = F.explode(F.sequence(F.lit(0), F.floor(F.col("length") / stride).cast("int") - 1)).alias("i")
    rows = files.select("shard", "content", at)
    slot = (F.col("shard").cast("long") * records_per_shard + F.col("i")).alias("slot")
    return rows.select(slot, F.substring("content", F.col("i") * stride + 1, F.lit(length * width)).alias("tokens")).where(F.col("slot") >= first_slot)


def token_ids(tokens: Column, width: int = 1) -> Column:
    """The ids (array<long>) of a record's bytes, padding included; null for null."""
    digits = F.hex(tokens)
    number = lambda i: sum((F.conv(F.substring(digits, i * 2 * width + 2 * b + 1, F.lit(2)), 16, 10).cast("long") * (256**b) for b in range(width)), F.lit(0).cast("long"))
    n = F.floor(F.octet_length(tokens) / width).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), number)).when(n == 0, F.array().cast("array<bigint>"))

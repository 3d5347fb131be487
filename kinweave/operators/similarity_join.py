"""Similarity joins over distinct written forms."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.similarity import CHEAP, CONFUSED, GROUPS
from kinweave.session import materialise


def one_edit_keys(form: Column) -> Column:
    """Hashes of the form and of all it becomes by leaving one character out: forms one edit apart share one."""
    cut = lambda i: F.concat(F.substring(form, F.lit(1), i - 1), F.substring(form, i + 1, F.char_length(form)))
    shorter = F.transform(F.sequence(F.lit(1), F.char_length(form)), lambda i: F.xxhash64(cut(i)))
    return F.array_distinct(F.concat(F.array(F.xxhash64(form)), shorter))


def one_edit_pairs(forms: DataFrame, form: str = "form") -> DataFrame:
    """``a, b, distance`` with ``a < b`` of all distinct forms at Levenshtein distance 1.

    Forms meet by shared deletions: a key is shared by few forms (an alphabet's worth
    for each place), so no bucket grows with the table; what two keys' hashes have in common
    by chance falls to the distance. The keys are a form's length times its rows: they are
    shuffled and sorted once, and each form of a key is beside those before it. Null and
    empty forms match nothing.
    """
    keyed = forms.where(F.col(form).isNotNull() & (F.col(form) != "")).select(F.col(form).alias("a")).distinct()
    keyed = keyed.withColumn("key", F.explode(one_edit_keys(F.col("a"))))
    before = F.collect_list("a").over(Window.partitionBy("key").orderBy("a").rowsBetween(Window.unboundedPreceding, -1))
    pairs = keyed.select(F.col("a").alias("b"), before.alias("before")).select(F.explode("before").alias("a"), "b")
    return pairs.withColumn("distance", F.levenshtein("a", "b", 1)).where("distance = 1").distinct()


#: A shard is walked with so many asked forms at a time, and one with more forms than this is split.
ASKED_AT_ONCE = 4096
FORMS_A_SHARD = 4000
_SLACK = 1e-6
_JUMPS = {x[0] for pair in GROUPS for x in pair if len(x) > 1}


def _codes(words: list[str]) -> np.ndarray:
    wide = max(map(len, words), default=0)
    return np.array([[*map(ord, w), *([0] * (wide - len(w)))] for w in words], dtype=np.int64).reshape(len(words), wide)


class Asked:
    """Forms walked together down a trie of others: one row of edit distances each, for the letters of the trie so far."""

    def __init__(self, words: list[str], threshold: float):
        self.codes, self.threshold = _codes(words), threshold
        self.lengths = np.array([len(w) for w in words], dtype=np.int64)
        self.steps = np.arange(self.codes.shape[1] + 1, dtype=np.float64)
        letters = sorted({c for pair in CONFUSED for c in pair})
        self.cheap = {x: [ord(y) for y in letters if frozenset((x, y)) in CONFUSED] for x in letters}
        # Where each word ends with each side of a group, by the place after it.
        self.ends = {y: np.column_stack([np.zeros((len(words), len(y)), dtype=bool), self._holds(y)]) for pair in GROUPS for y in pair}

    def _holds(self, part: str) -> np.ndarray:
        width = self.codes.shape[1]
        hold = np.ones((len(self.codes), max(width - len(part) + 1, 0)), dtype=bool)
        for k, c in enumerate(part):
            hold &= self.codes[:, k : width - len(part) + 1 + k] == ord(c)
        return hold

    def start(self) -> tuple[np.ndarray, list[np.ndarray]]:
        return np.arange(len(self.codes)), [np.repeat(self.steps[None], len(self.codes), 0)]

    def step(self, active: np.ndarray, rows: list[np.ndarray], path: str, longest: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """The words that can still be near some form below ``path``, and their rows (the last first, at most four).

        ``longest`` is the length of the longest form below. A letter "?" may be any letter.
        """
        letter, last = path[-1], rows[0]
        codes = self.codes[active]
        cost = np.ones(codes.shape)
        if letter == "?":
            cost[:] = 0.0
        else:
            cost[codes == ord(letter)] = 0.0
            for y in self.cheap.get(letter, ()):
                cost[codes == y] = CHEAP
        row = last + 1
        np.minimum(row[:, 1:], last[:, :-1] + cost, out=row[:, 1:])
        for x, y in GROUPS + [(y, x) for x, y in GROUPS]:
            if path.endswith(x) and len(x) <= len(rows):
                came = rows[len(x) - 1][:, : row.shape[1] - len(y)] + CHEAP
                if came.shape[1]:
                    here = self.ends[y][active][:, len(y) : row.shape[1]]
                    np.minimum(row[:, len(y) :], np.where(here, came, np.inf), out=row[:, len(y) :])
        # Letters of the asked word alone cost one each, from wherever it was cheaper.
        row = np.minimum.accumulate(row - self.steps, axis=1) + self.steps
        lengths = self.lengths[active]
        inside = self.steps[None] <= lengths[:, None]
        low = np.where(inside, row, np.inf).min(1)
        if letter in _JUMPS or letter == "?":  # a group of the form may have begun with this letter, or with the one before
            low = np.minimum(low, last.min(1) + CHEAP)
            if len(rows) > 1:
                low = np.minimum(low, rows[1].min(1) + CHEAP)
        room = (1 - self.threshold) * np.maximum(lengths, longest) + _SLACK
        stays = np.flatnonzero(low <= room)
        return active[stays], [row[stays], *[r[stays] for r in rows[:3]]]


def near_forms(asked: Asked, forms: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """The place of a form of ``forms`` (sorted, distinct) and the asked words that are near it."""
    lengths = np.array([len(f) for f in forms], dtype=np.int64)
    stack = [(0, len(forms), 0, *asked.start())]
    while stack:
        begin, end, depth, active, rows = stack.pop()
        if lengths[begin] == depth and depth:
            # The shortest of a node comes first: the form that ends here.
            n = asked.lengths[active]
            far = rows[0][np.arange(len(active)), n]
            yield begin, active[far <= (1 - asked.threshold) * np.maximum(n, depth) + _SLACK]
            begin += 1
        while begin < end:
            path = forms[begin][: depth + 1]
            stop = begin + 1
            while stop < end and forms[stop][depth] == path[depth]:
                stop += 1
            left, below = asked.step(active, rows, path, int(lengths[begin:stop].max()))
            if len(left):
                stack.append((begin, stop, depth + 1, left, below))
            begin = stop


def weighted_pairs(forms: DataFrame, threshold: float, form: str = "form") -> DataFrame:
    """``a, b, similarity`` with ``a < b`` of all forms whose weighted similarity reaches ``threshold``.

    Forms are dealt to shards by their first two letters (letters beyond a to z count as one), a
    large shard to several. Every form is asked of the shards whose two letters it can come
    from within its distance, and walked down the shard's trie together with the others
    asked there: a branch is left as soon as no way through its letters, cheap ones and
    groups included, stays within the distance. So shuffled rows grow with the forms, and
    the walk with what is near them; no pair is missed. What the walk finds is worked out
    once more by the exact similarity. Null and empty forms match nothing.
    """
    from kinweave.functions.similarity import similarity_udf

    base = materialise(forms.where(F.col(form).isNotNull() & (F.col(form) != "")).select(F.col(form).alias("form")).distinct(), "sj-forms")
    door = F.regexp_replace(F.substring("form", 1, 2), "[^a-z]", "?")
    placed = base.withColumn("door", door)
    doors = placed.groupBy("door").agg(F.max(F.char_length("form")).alias("longest"), F.ceil(F.count("*") / FORMS_A_SHARD).cast("int").alias("salts")).collect()  # at most 27 * 28 rows
    known = sorted((r.door, r.longest, r.salts) for r in doors)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            for begin in range(0, len(words), ASKED_AT_ONCE):
                part = words[begin : begin + ASKED_AT_ONCE]
                asked = Asked(part, threshold)
                for letters, longest, salts in known:
                    active, rows = asked.start()
                    for k in range(1, len(letters) + 1):
                        active, rows = asked.step(active, rows, letters[:k], longest)
                    some = [part[i] for i in active.tolist()] * salts
                    yield pa.RecordBatch.from_arrays([pa.array([letters] * len(some), pa.string()), pa.array([s for s in range(salts) for _ in range(len(active))], pa.int32()), pa.array(some, pa.string()), pa.array([True] * len(some))], names=["door", "salt", "word", "asks"])

    def meet_in_shard(shard: pa.Table) -> pa.Table:
        asks = shard.column("asks").to_numpy(zero_copy_only=False)
        words = np.array(shard.column("word").to_pylist(), dtype=object)
        held, asking = sorted(words[~asks].tolist()), words[asks].tolist()
        out: tuple[list[str], list[str]] = ([], [])
        for begin in range(0, len(asking), ASKED_AT_ONCE):
            part = asking[begin : begin + ASKED_AT_ONCE]
            for place, near in near_forms(Asked(part, threshold), held) if held else ():
                for i in near.tolist():
                    if part[i] < held[place]:
                        out[0].append(part[i])
                        out[1].append(held[place])
        return pa.table({"a": pa.array(out[0], pa.string()), "b": pa.array(out[1], pa.string())})

    salts = F.create_map(*[x for d, _, s in known for x in (F.lit(d), F.lit(s))]) if known else F.create_map(F.lit(""), F.lit(1))
    rows = placed.select("door", F.pmod(F.xxhash64("form"), F.element_at(salts, F.col("door"))).cast("int").alias("salt"), F.col("form").alias("word"), F.lit(False).alias("asks"))
    asked = base.mapInArrow(ask, "door string, salt int, word string, asks boolean")
    pairs = rows.unionByName(asked).groupBy("door", "salt").applyInArrow(meet_in_shard, "a string, b string")
    return pairs.withColumn("similarity", similarity_udf("a", "b")).where(F.col("similarity") >= threshold)

"""Collocations from a weighted de Bruijn graph of word sequences.

Nodes are sequences of ``longest - 1`` words; an edge is a sequence of ``longest`` words
between the two nodes that overlap in it, and its weight is how often it occurs. Only
edges are counted from the text. A node occurs as often as its outgoing edges together,
and once more for each piece that ends with it; the same rule gives every shorter count
from the next longer one. Unary paths, on which every node has one way in and one way out
of the same weight, are compacted into one passage.

Most sequences are rare. A first pass counts word pairs by a hash of 40 bits; a pair whose
hash occurs less than ``least`` times is no part of a frequent phrase, so pieces are cut
there as well, and the cut counts as a piece's end. The hash only ever counts too much:
every phrase of frequent pairs is counted wherever it stands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Texts are counted together inside a task up to so many characters.
CHARS_PER_CHUNK = 6_000_000
ROWS_AT_ONCE = 50_000
#: The bit set of frequent pairs has some ten bits a pair, at most so many; a fuller one lets more rare pairs through.
MOST_PAIR_BITS = 1 << 26
#: Frequent phrases up to so many bytes together are sent to every task; more are joined by a shuffle.
MOST_BYTES_SENT = 32 << 20
SALTS = 32
_BREAK = b"."
_WORD_BITS = 21
_K1, _K2, _K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: A-Z lowered, every separator of pieces one mark, tab a blank.
_BYTES = bytes(_BREAK[0] if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


class _Numbers(dict):
    """Word to number in order of appearance; the break is 0."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


class Chunk:
    """The words of some texts of one language, as numbers; 0 parts pieces."""

    def __init__(self, texts: list[str]):
        numbers = _Numbers({_BREAK: 0})
        number = numbers.__getitem__
        coded = [np.zeros(1, dtype=np.int64)]
        for text in texts:
            # A break is a word of its own: no word holds its byte. Split by blanks only, the other white space parts pieces.
            words = text.encode("utf-8", "surrogatepass").translate(_BYTES).replace(_BREAK, b" . ").split()
            coded.append(np.fromiter(map(number, words), dtype=np.int64, count=len(words)))
            coded.append(coded[0])
        self.at = np.concatenate(coded)
        self.words = list(numbers)

    def slots(self, lang: str) -> tuple[np.ndarray, np.ndarray]:
        """A hash of each word and the next, and whether both are words."""
        flat = np.empty(len(self.words), dtype=object)
        flat[:] = self.words
        hashes = pd.util.hash_array(flat, categorize=False)
        salt = pd.util.hash_array(np.array([lang], dtype=object), categorize=False)[0]
        a, b = self.at[:-1], self.at[1:]
        x = hashes[a] * _K1 + hashes[b]
        x ^= x >> np.uint64(29)
        x = x * _K2 + salt
        x ^= x >> np.uint64(32)
        return ((x * _K3) >> np.uint64(24)).astype(np.int64), (a > 0) & (b > 0)

    def grams(self, places: np.ndarray, k: int) -> Iterator[tuple[list[bytes], np.ndarray]]:
        """The distinct sequences of ``k`` words at ``places`` and how often each stands there, some at a time."""
        code = self.at[places]
        for j in range(1, k):
            # Numbers of distinct beginnings stay below the number of places.
            _, code = np.unique((code << _WORD_BITS if len(self.words) < 1 << _WORD_BITS else code * len(self.words)) + self.at[places + j], return_inverse=True)
        _, first, n = np.unique(code, return_index=True, return_counts=True)
        words, first = self.words, places[first]
        for begin in range(0, len(first), ROWS_AT_ONCE):
            some = first[begin : begin + ROWS_AT_ONCE].tolist()
            yield [b" ".join([words[i] for i in self.at[p : p + k].tolist()]) for p in some], n[begin : begin + ROWS_AT_ONCE]

    def edges_and_ends(self, joined: np.ndarray, longest: int) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
        """``k``, sequences, counts: the edges for ``longest``, and the ends of runs for each shorter ``k``.

        ``joined`` says of each word whether its run goes on with the next.
        """
        word = self.at > 0
        goes_on = np.append(joined, False)
        run = np.ones(len(self.at), dtype=bool)  # longest words from here are in one run
        for j in range(longest - 1):
            run[: len(run) - j] &= goes_on[j:]
            run[len(run) - j :] = False
        yield from ((longest, *some) for some in self.grams(np.flatnonzero(run), longest))
        ends = np.flatnonzero(word & ~goes_on)
        for k in range(1, longest):
            yield from ((k, *some) for some in self.grams(ends - (k - 1), k))
            before = ends - k
            ends = ends[(before >= 0) & goes_on[np.maximum(before, 0)]]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    """Texts by language, up to CHARS_PER_CHUNK characters at a time."""
    held: dict[str, list[str]] = {}
    chars = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or ""
            held.setdefault(lang, []).append(text)
            chars += len(text)
            if chars >= CHARS_PER_CHUNK:
                yield from held.items()
                held, chars = {}, 0
    yield from held.items()


def _frequent_pairs(docs: DataFrame, least: int) -> np.ndarray:
    """A bit set that holds the hash of every pair of words with at least ``least`` occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _chunks(batches):
            slots, both = Chunk(texts).slots(lang)
            found, n = np.unique(slots[both], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(n, pa.int64())], names=["slot", "n"])

    from kinweave.session import materialise

    counted = docs.mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    pairs = materialise(counted.where(F.col("n") >= least).select("slot"), "ph-pairs")
    bits = min(MOST_PAIR_BITS, 1 << max(10, (10 * pairs.count()).bit_length()))
    place = F.pmod("slot", F.lit(bits))
    words = pairs.select(F.shiftright(place, 5).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(32)).cast("int")).alias("bit"))
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most bits / 32 rows
    out = np.zeros(bits // 32, dtype=np.uint32)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return out


def first_words(phrase: Column, k: int) -> Column:
    return F.substring_index(phrase, " ", k)


def last_words(phrase: Column, k: int) -> Column:
    return F.substring_index(phrase, " ", -k)


def phrase_counts(df: DataFrame, *, longest: int = 5, least: int = 100, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, k, phrase, f``: every sequence of ``k`` = 1 to ``longest`` words whose pairs may be frequent.

    A text is lowered (A-Z only), cut at ``.,;:!?`` and line ends into pieces, and these at
    blanks and tabs into words; a phrase lies within a piece, and ``f`` counts all its
    places, overlaps included. Every phrase with ``f >= least`` is there, and every word;
    of phrases of two words on, some rarer ones are missing, those that are there are exact.

    Defined cases: a null or empty text has no words; a null language is ``und``; null
    ids are not read; repeated rows count as often as they stand; an empty table gives an
    empty table; other columns are not read. Words and texts may be of any length.
    """
    from kinweave.session import materialise

    docs = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(_frequent_pairs(docs, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for lang, texts in _chunks(batches):
            chunk = Chunk(texts)
            slots, both = chunk.slots(lang)
            at = slots & (32 * len(bits) - 1)
            both &= (bits[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1
            for k, grams, n in chunk.edges_and_ends(both, longest):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array([k] * len(grams), pa.int32()), pa.array(grams, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())],
                    names=["lang", "k", "phrase", "n"],
                )

    counted = docs.mapInArrow(run, "lang string, k int, phrase string, n long").groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))
    counted = materialise(counted, "ph-edges")
    # Edges, then level by level: flow out of each node, and the ends that stand there.
    level = counted.where(F.col("k") == longest).select("lang", "phrase", F.col("n").alias("f"))
    out = level.withColumn("k", F.lit(longest))
    for k in range(longest - 1, 0, -1):
        flow = level.select("lang", first_words(F.col("phrase"), k).alias("phrase"), "f")
        ends = counted.where(F.col("k") == k).select("lang", "phrase", F.col("n").alias("f"))
        level = materialise(flow.unionByName(ends).groupBy("lang", "phrase").agg(F.sum("f").alias("f")), f"ph-{k}")
        out = out.unionByName(level.withColumn("k", F.lit(k)))
    return out.select("lang", "k", "phrase", "f")


def unary_paths(counts: DataFrame, *, longest: int = 5, least: int = 100) -> DataFrame:
    """``lang, phrase, passage, f``: each edge with ``f >= least`` and the unary path it lies on.

    Two edges follow each other on a path if the node between them has their common weight:
    all its occurrences come from the one and go on with the other. A path ends at last,
    since pieces end, so there are no circles.

    Defined cases: an edge without neighbours is its own passage; an empty table gives an
    empty table. ``counts`` is what :func:`phrase_counts` gives.
    """
    from kinweave.session import materialise

    edges = counts.where((F.col("k") == longest) & (F.col("f") >= least))
    edges = materialise(edges.select(F.monotonically_increasing_id().alias("id"), "lang", "phrase", "f"), "ph-paths")
    nodes = counts.where((F.col("k") == longest - 1) & (F.col("f") >= least)).select("lang", F.col("phrase").alias("node"), "f")
    into = edges.select("lang", last_words(F.col("phrase"), longest - 1).alias("node"), "f", "id")
    from_ = edges.select("lang", first_words(F.col("phrase"), longest - 1).alias("node"), "f", F.col("id").alias("next"))
    steps = into.join(nodes, ["lang", "node", "f"]).join(from_, ["lang", "node", "f"]).select("id", "next")
    # Every edge learns the last edge of its path and how far that is, by doubling.
    reach = edges.select("id").join(steps, "id", "left").select("id", F.coalesce("next", "id").alias("tail"), F.col("next").isNotNull().cast("long").alias("far"))
    while True:
        reach = materialise(reach, "ph-reach")
        on = reach.select(F.col("id").alias("tail"), F.col("tail").alias("then"), F.col("far").alias("more"))
        wider = materialise(reach.join(on, "tail").select("id", F.col("then").alias("tail"), (F.col("far") + F.col("more")).alias("far"), "more"), "ph-wider")
        done = not wider.where("more > 0").limit(1).count()
        reach = wider.drop("more")
        if done:
            break
    placed = reach.join(edges, "id")
    # A path lies within a piece: its edges are no more than the piece's words.
    links = F.reverse(F.array_sort(F.collect_list(F.struct("far", "phrase"))))
    whole = placed.groupBy("tail").agg(links.alias("links"))
    rest = F.transform(F.slice("links", 2, F.greatest(F.size("links") - 1, F.lit(0))), lambda e: last_words(e["phrase"], 1))
    whole = whole.select("tail", F.array_join(F.concat(F.array(F.col("links")[0]["phrase"]), rest), " ").alias("passage"))
    return placed.join(whole, "tail").select("lang", "phrase", "passage", "f")


def collocations(
    df: DataFrame, *, longest: int = 5, least: int = 100, percent: int = 100, top: int = 2000, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score, passage``: each language's first ``top`` phrases by score.

    Candidates are phrases of 2 to ``longest`` words with ``a`` occurrences, at least
    ``least``. A cut after the first words has ``l`` and ``r`` occurrences of its two
    parts, and ``floor(1000 * a * n / (l * r))`` as its score, ``n`` being all words of the
    language; the lowest-scoring cut counts (ties: the first). A candidate is dropped if a
    longer one around it has ``percent`` of its occurrences or more; the next longer are
    enough to look at, as whatever is longer still occurs no more often than they do.
    ``passage`` is the unary path of a phrase of ``longest`` words, a shorter phrase itself.

    Numbers are exact: products are decimals of 38 digits, and one beyond them fails the job.
    Defined cases are those of :func:`phrase_counts`.
    """
    from kinweave.session import materialise

    counts = phrase_counts(df, longest=longest, least=least, lang_col=lang_col, text_col=text_col)
    words = counts.where("k = 1").groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = materialise(counts.where(F.col("f") >= least), "ph-frequent")
    held = frequent.agg(F.coalesce(F.sum(F.octet_length("phrase") + 40), F.lit(0)).alias("bytes")).first().bytes
    sent = F.broadcast if held <= MOST_BYTES_SENT else (lambda d: d)
    paths = unary_paths(counts, longest=longest, least=least).select("lang", "phrase", "passage")

    # Graph view of the drop rule: the heaviest edge into or out of a node, against the node.
    longer = frequent.where("k > 2").withColumn("at", F.explode(F.array(F.lit(0), F.lit(1))))
    cut = F.when(F.col("at") == 0, F.expr("substring_index(phrase, ' ', k - 1)")).otherwise(F.expr("substring_index(phrase, ' ', 1 - k)"))
    heaviest = longer.select("lang", cut.alias("phrase"), F.col("f").alias("w")).groupBy("lang", "phrase").agg(F.max("w").alias("w"))
    wide = "decimal(38,0)"
    stays = F.col("w").isNull() | (F.lit(100) * F.col("w").cast(wide) < F.lit(percent) * F.col("f").cast(wide))
    kept = frequent.where("k > 1").join(sent(heaviest), ["lang", "phrase"], "left").where(stays).select("lang", "phrase", "k", F.col("f").alias("a"))

    cuts = kept.withColumn("cut", F.explode(F.expr("sequence(1, k - 1)")))
    cuts = cuts.select("lang", "phrase", "a", "cut", F.expr("substring_index(phrase, ' ', cut)").alias("left_part"), F.expr("substring_index(phrase, ' ', cut - k)").alias("right_part"))
    of = lambda part, name: sent(frequent.select("lang", F.col("phrase").alias(part), F.col("f").alias(name)))
    cuts = cuts.join(of("left_part", "l"), ["lang", "left_part"]).join(of("right_part", "r"), ["lang", "right_part"])
    cuts = cuts.join(sent(words), "lang")  # a language of a frequent phrase has a frequent phrase: no more rows than those
    score = F.expr(f"(cast(1000 * cast(a as decimal(19,0)) as {wide}) * cast(n as {wide})) div (cast(l as {wide}) * cast(r as {wide}))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("b")).select("lang", "phrase", "b.*")

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    salted = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top).drop("rank", "salt")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    out = ranked.join(paths, ["lang", "phrase"], "left").withColumn("passage", F.coalesce("passage", "phrase"))
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "passage")

"""Reviews of readings: an index against its records, a glossary against use, and search by prefix."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.session import materialise


def index_disagreement(index: DataFrame, records: DataFrame, register: str, name: str) -> DataFrame:
    """``register, both, only_index, only_records``: distinct names of each register on either side."""
    sides = index.select(register, name).distinct().withColumn("i", F.lit(1)).join(records.select(register, name).distinct().withColumn("r", F.lit(1)), [register, name], "full")
    i, r = F.col("i").isNotNull(), F.col("r").isNotNull()
    return sides.groupBy(register).agg(F.count_if(i & r).alias("both"), F.count_if(i & ~r).alias("only_index"), F.count_if(~i & r).alias("only_records"))


def glossary_audit(tokens: DataFrame, glossary: DataFrame, least: int = 3) -> DataFrame:
    """Glossary entries that use speaks against.

    ``tokens``: ``doc_id, word`` (repeats count); ``glossary``: ``form, target``. An entry is
    suspect if both words stand together in at least ``least`` documents, or if the form is
    the commoner. Documents are read once: the words of each are counted where they are read
    and written down, and only entries that the counts leave open are looked for in
    documents. The glossary grows with the words, so it is shuffled, never sent whole
    through the driver.
    """
    listed = materialise(glossary.select("form", "target").distinct(), "glossary")
    used = materialise(tokens.groupBy("doc_id", "word").agg(F.count("*").alias("n")), "glossary-used")
    totals = materialise(used.groupBy("word").agg(F.sum("n").alias("n"), F.count("doc_id").alias("docs")), "glossary-totals")
    side = lambda c: totals.select(F.col("word").alias(c), F.col("n").alias(f"{c}_n"), F.col("docs").alias(f"{c}_docs"))
    entries = listed.hint("merge").join(side("form"), "form").hint("merge").join(side("target"), "target")
    open_ = materialise(entries.where((F.least("form_docs", "target_docs") >= least) | (F.col("form_n") > F.col("target_n"))), "glossary-open")
    pairs = open_.select("form", "target").hint("merge").join(used.select("doc_id", F.col("word").alias("form")), "form").hint("merge").join(used.select("doc_id", F.col("word").alias("target")), ["doc_id", "target"])
    together = pairs.groupBy("form", "target").agg(F.count("*").alias("together"))
    out = (
        open_.hint("merge").join(together, ["form", "target"], "left")
        .select("form", "target", F.coalesce("together", F.lit(0)).alias("together"), "form_n", "target_n")
    )
    return out.where((F.col("together") >= least) | (F.col("form_n") > F.col("target_n")))


def search_terms(query: str) -> list[list[str]]:
    """The ways a question may match: all its words, or two neighbours written as one.

    Words of one letter are left out; of two words the first may lose its last vowel.
    """
    words = [w for w in query.lower().split() if len(w) > 1]
    ways = [words] if words else []
    for i in range(len(words) - 1):
        for glued in sorted({words[i] + words[i + 1], words[i][:-1] + words[i + 1]} - {words[i], words[i + 1]}):
            ways.append(words[:i] + [glued] + words[i + 2 :])
    return ways


def matches(query: str, words: Column) -> Column:
    """Whether an array of lower-case words matches: every term begins a word, in one of the ways."""
    one = lambda term: F.exists(words, lambda w: w.startswith(term))
    ways = [reduce(lambda a, b: a & b, [one(t) for t in way]) for way in search_terms(query)]
    return reduce(lambda a, b: a | b, ways) if ways else F.lit(False)


def uncertain_acts(acts: DataFrame) -> DataFrame:
    """Acts read with little trust or with doubts noted, the least trusted first."""
    doubt = (F.col("reliability") == "bassa") | (F.coalesce("doubts", F.lit("")) != "")
    return acts.where(F.coalesce(doubt, F.lit(False))).orderBy(F.when(F.col("reliability") == "bassa", 0).otherwise(1), "act")


def queue(rows: DataFrame, *, kind: str | None = None, most: int | None = None, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """The part of a queue that was asked for, in its order: by kind, by years, at most so many."""
    out = rows
    if kind is not None:
        out = out.where(F.col("kind") == kind)
    if first_year is not None:
        out = out.where(F.col("year") >= first_year)
    if last_year is not None:
        out = out.where(F.col("year") <= last_year)
    out = out.orderBy(F.desc("priority"), "id")
    return out if most is None else out.limit(most)


def pages_to_read_again(rows: DataFrame, heads: int = 2) -> DataFrame:
    """``image, questions, priority``: pages by their highest question; a person brings at most ``heads`` pages."""
    from pyspark.sql import Window

    order = Window.partitionBy("person").orderBy(F.desc("priority"), "image")
    kept = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= heads)
    return kept.groupBy("image").agg(F.count("*").alias("questions"), F.max("priority").alias("priority"))


def rare_near_frequent(forms: DataFrame, rare: int = 2, frequent: int = 10, least: float = 0.8) -> DataFrame:
    """``form, n, target, target_n, similarity``: forms seen at most ``rare`` times beside the most alike of those seen ``frequent`` times."""
    from kinweave.operators.corrections import dominated
    from kinweave.operators.similarity_join import weighted_pairs

    some = forms.where((F.col("n") <= rare) | (F.col("n") >= frequent))
    pairs = weighted_pairs(some, least)
    return dominated(some, pairs, ((least, frequent / max(rare, 1)),)).where((F.col("n") <= rare) & (F.col("target_n") >= frequent))


def missing_years(rows: DataFrame, group: str, year: str) -> DataFrame:
    """``group, missing``: the years between a group's first and last that have no row, "1810-1812, 1820"."""
    from pyspark.sql import Window

    held = rows.select(group, year).distinct()
    ends = held.groupBy(group).agg(F.min(year).alias("a"), F.max(year).alias("b"))
    gaps = ends.select(group, F.explode(F.sequence("a", "b")).alias(year)).join(held, [group, year], "left_anti")
    runs = gaps.withColumn("run", F.col(year) - F.row_number().over(Window.partitionBy(group).orderBy(year)))
    spans = runs.groupBy(group, "run").agg(F.min(year).alias("a"), F.max(year).alias("b"))
    text = F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat_ws("-", "a", "b"))
    return spans.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("a", text.alias("t")))).alias("s")).select(group, F.array_join(F.transform("s", lambda x: x["t"]), ", ").alias("missing"))


def word_index(docs: DataFrame, key: str, *columns: str) -> DataFrame:
    """``word, key, n``: the posting table of some text columns, lower case, letters and digits."""
    text = F.lower(F.concat_ws(" ", *columns))
    return docs.select(key, F.explode(F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))).alias("word")).groupBy("word", key).agg(F.count("*").alias("n"))


def _ranked(hits_of: Callable[[str], DataFrame], total: DataFrame, empty: DataFrame, boosts: DataFrame, question: str, key: str) -> tuple[DataFrame, DataFrame]:
    """The scores of a question, from what answers one term (``key, tf, dl``) and the corpus in one row (``docs, avgdl``)."""
    total = F.broadcast(total)  # one row
    scored = None
    for way in search_terms(question):
        hits = None
        for i, term in enumerate(way):
            one = hits_of(term)
            df = F.broadcast(one.agg(F.count("*").alias("df")))  # one row
            part = one.crossJoin(df).crossJoin(total)
            weight = F.ln(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5)) * F.col("tf") * 2.2 / (F.col("tf") + 1.2 * (0.25 + 0.75 * F.col("dl") / F.col("avgdl")))
            part = part.select(key, weight.alias(f"w{i}"))
            hits = part if hits is None else hits.join(part, key)
        rows = hits.select(key, reduce(lambda a, b: a + b, [F.col(f"w{i}") for i in range(len(way))]).alias("bm25"))
        scored = rows if scored is None else scored.unionByName(rows)
    if scored is None:
        scored = empty.select(key, F.lit(0.0).alias("bm25")).where("false")
    best = scored.groupBy(key).agg(F.max("bm25").alias("bm25")).join(boosts.select(key, "mentions", "links"), key)
    score = F.round(F.col("bm25") + 1.5 * F.log10(1 + F.col("mentions")) + 3 * F.log10(1 + F.col("links")), 6)
    return best.where("links > 0").select(key, score.alias("score")).orderBy(F.desc("score"), key), best.where("links = 0").agg(F.count("*").alias("outside"))


def search(index: DataFrame, boosts: DataFrame, question: str, key: str) -> tuple[DataFrame, DataFrame]:
    """``key, score`` of what answers a question, best first, and one row ``outside`` of the matches without a link.

    Every term begins a word, in one of the ways of ``search_terms``. BM25 (k1 1.2, b .75) plus
    1.5 and 3 times the logarithm (to 10) of one more than ``mentions`` and ``links`` of
    ``boosts``; only rows with links are ranked. The whole index is read; :func:`stored_search`
    reads the words of a question only.
    """
    sizes = index.groupBy(key).agg(F.sum("n").alias("dl"))
    hits = lambda term: index.where(F.col("word").startswith(term)).groupBy(key).agg(F.sum("n").alias("tf")).join(sizes, key)
    return _ranked(hits, sizes.agg(F.count("*").alias("docs"), F.avg("dl").alias("avgdl")), sizes, boosts, question, key)


#: Letters of a word that name its folder. Terms have two letters at least, so that one folder holds all of a term's words.
HEAD = 2


def store_postings(index: DataFrame, key: str, path: str) -> None:
    """Writes a posting table (:func:`word_index`) for questions: by the first letters of the words, in ranges of words, with the length of each document.

    A head with very many postings is cut into ranges of words and keys; words lie in order
    inside a file, so that Parquet's bounds leave out what a term cannot be in. The
    corpus's figures are a table of one row beside it. Words of one letter answer no question
    and are left out; they count in the lengths. An existing folder is an error.
    """
    sizes = index.groupBy(key).agg(F.sum("n").alias("dl"))
    sizes.agg(F.count("*").alias("docs"), F.avg("dl").alias("avgdl")).write.parquet(f"{path}/corpus")
    rows = index.where(F.char_length("word") >= HEAD).join(sizes, key).withColumn("head", F.hex(F.substring("word", 1, HEAD)))
    rows.repartitionByRange("head", "word", key).sortWithinPartitions("head", "word", key).write.partitionBy("head").parquet(f"{path}/postings")


def stored_search(spark: SparkSession, path: str, boosts: DataFrame, question: str, key: str) -> tuple[DataFrame, DataFrame]:
    """The answer of :func:`search` from postings written by :func:`store_postings`: only the folders of the question's terms are read."""
    postings = spark.read.parquet(f"{path}/postings")
    hits = lambda term: postings.where((F.col("head") == F.hex(F.lit(term[:HEAD]))) & F.col("word").startswith(term)).groupBy(key).agg(F.sum("n").alias("tf"), F.max("dl").alias("dl"))
    return _ranked(hits, spark.read.parquet(f"{path}/corpus"), postings, boosts, question, key)


def decision_context(people: DataFrame, kin: DataFrame, anomalies: DataFrame, similar: DataFrame) -> DataFrame:
    """One nested row a person: kin, open anomalies and similar people, each sorted, for whoever decides.

    ``kin``: ``id, relation, other``; ``anomalies``: ``kind, id, detail``; ``similar``: ``id, other, similarity``.
    """
    listed = lambda *c: F.array_sort(F.collect_list(F.struct(*c)))
    relatives, doubts, alike = kin.groupBy("id").agg(listed("relation", "other").alias("kin")), anomalies.groupBy("id").agg(listed("kind", "detail").alias("doubts")), similar.groupBy("id").agg(listed("similarity", "other").alias("similar"))
    return people.join(relatives, "id", "left").join(doubts, "id", "left").join(alike, "id", "left")


#: The kinds of anomaly that judging can settle; a date is settled by looking at the page.
ARBITRATED = ("DUPLICATE_PERSON", "POSSIBLE_HOMONYM", "MARITAL_ANOMALY", "IDENTITY_ANOMALY")


def judged_sets(log: DataFrame) -> DataFrame:
    """``people``: the sets of people that anyone but the algorithm has decided on, from the JSON lists of a log; lists that cannot be read are left out."""
    people = F.filter(F.from_json("entities", "array<bigint>"), lambda x: x.isNotNull())
    return log.where("decider <> 'algorithm'").select(F.array_sort(F.array_distinct(people)).alias("people")).where(F.size("people") > 0).distinct()


def arbiter_cases(cases: DataFrame, judged: DataFrame, *, inside: bool = False, kind: str | None = None, most: int | None = None) -> DataFrame:
    """The cases to put before an arbiter, by priority: of the kinds that judging settles, whose people were not judged together before.

    ``cases``: ``id, kind, people, priority``; ``judged``: ``people`` (:func:`judged_sets`). A
    case is left out if just its set of people was judged, or, with ``inside``, if a judged
    set holds all of them: then a case is asked for by the one of its people that stands in
    the fewest judged sets, so that no set is met for a person it merely shares. The order
    of people, repeats and nulls among them do not count; a case without people stays.
    """
    kinds = F.col("kind") == kind if kind else F.col("kind").isin(*ARBITRATED)
    wanted = cases.where(kinds).withColumn("_set", F.array_sort(F.array_distinct(F.filter("people", lambda x: x.isNotNull()))))
    if inside:
        members = judged.select(F.col("people").alias("_held"), F.explode("people").alias("_one"))
        often = members.groupBy("_one").agg(F.count("*").alias("_n"))
        asked = wanted.where(F.size("_set") > 0).select("_set").distinct()
        each = asked.select("_set", F.explode("_set").alias("_one")).join(often, "_one", "left")
        rarest = each.groupBy("_set").agg(F.min(F.struct("_n", "_one"))["_one"].alias("_one"), F.bool_and(F.col("_n").isNotNull()).alias("_all")).where("_all")
        done = rarest.join(members, "_one").where(F.size(F.array_except("_set", "_held")) == 0).select("_set").distinct()
    else:
        done = judged.select(F.col("people").alias("_set")).distinct()
    out = wanted.join(done, "_set", "left_anti").select(*cases.columns).orderBy(F.desc("priority"), "id")
    return out if most is None else out.limit(most)

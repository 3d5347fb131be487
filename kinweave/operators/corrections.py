"""Corrections of names and surnames: where they come from and how they are applied.

Forms are distinct spellings with how often they stand (``form, n``); a correction is a
row ``form, target``. Readings are never overwritten: the corrected value stands beside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.similarity import similarity_udf
from kinweave.functions.text import canonical, name_parts, normal
from kinweave.operators.interpret import sex_by_ending
from kinweave.operators.similarity_join import weighted_pairs

#: Rules of dominance for given names: similarity and how many times as common the target is.
NAME_RULES = ((0.80, 8.0), (0.85, 4.0), (0.92, 3.0))


def _bare(c: str) -> Column:
    return F.regexp_replace(normal(F.col(c)), " ", "")


def surname_forms(rows: DataFrame) -> DataFrame:
    """``form, n`` of surnames that were read; those derived from the rest of the act (``origin``) have no vote."""
    read = rows.where("surname is not null")
    read = read.where("origin is null") if "origin" in rows.columns else read
    return read.groupBy(F.col("surname").alias("form")).agg(F.count("*").alias("n"))


def apply_corrections(rows: DataFrame, corrections: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``column`` corrected and the reading beside it as ``{column}_read``."""
    one = corrections.groupBy(F.col("form").alias("kw_form")).agg(F.min("target").alias("kw_target"))
    out = rows.join(one, F.col(column) == F.col("kw_form"), "left").withColumn(f"{column}_read", F.col(column))
    return out.withColumn(column, F.coalesce("kw_target", column)).drop("kw_form", "kw_target")


def from_alternatives(readings: DataFrame, forms: DataFrame, least: int = 3) -> DataFrame:
    """``id, form, target``: readings whose noted alternative is a form attested ``least`` times and alike by .85.

    ``readings``: ``id, form, others``. Of several the most attested stands, then the first.
    """
    other = readings.select("id", "form", F.explode("others").alias("target")).join(forms.where(F.col("n") >= least).select(F.col("form").alias("target"), "n"), "target")
    alike = other.select("id", "form", "target", "n", _bare("form").alias("x"), _bare("target").alias("y")).where(similarity_udf("x", "y") >= 0.85)
    return alike.groupBy("id", "form").agg(F.max_by("target", F.struct("n", "target")).alias("target"))


def dominated(forms: DataFrame, pairs: DataFrame, rules: tuple[tuple[float, float], ...]) -> DataFrame:
    """``form, n, target, target_n, similarity``: forms with a neighbour that is alike and common enough by one of the rules.

    Of several targets the most alike stands, then the most common, then the first.
    """
    sides = pairs.select("a", "b", "similarity").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "similarity"))
    seen = sides.join(forms.select(F.col("form").alias("a"), "n"), "a").join(forms.select(F.col("form").alias("b"), F.col("n").alias("m")), "b")
    fits = F.lit(False)
    for least, times in rules:
        fits |= (F.col("similarity") >= least) & (F.col("m") >= times * F.col("n"))
    best = seen.where(fits).groupBy("a", "n").agg(F.min_by(F.struct("b", "m", "similarity"), F.struct(-F.col("similarity"), -F.col("m"), "b")).alias("t"))
    return best.select(F.col("a").alias("form"), "n", F.col("t.b").alias("target"), F.col("t.m").alias("target_n"), F.col("t.similarity").alias("similarity"))


def name_corrections(rows: DataFrame, sexes: DataFrame) -> DataFrame:
    """``form, target, target_n`` of name parts, men's with men's and women's with women's; parts of no known sex are in both.

    A form of no known sex that finds a target in both is the most common one's.
    """
    counted = rows.select(F.explode(name_parts(F.col("name"))).alias("form")).groupBy("form").agg(F.count("*").alias("n"))
    told = counted.join(sexes.select(F.col("part").alias("form"), "sex"), "form", "left").withColumn("sex", F.coalesce("sex", sex_by_ending(F.col("form"))))
    found = None
    for sex in ("M", "F"):
        own = told.where((F.col("sex") == sex) | F.col("sex").isNull()).select("form", "n")
        one = dominated(own, weighted_pairs(own, 0.8), NAME_RULES)
        found = one if found is None else found.unionByName(one)
    return found.groupBy("form").agg(F.max(F.struct("target_n", "target")).alias("t")).select("form", F.col("t.target").alias("target"), F.col("t.target_n").alias("target_n"))


def corrected_names(rows: DataFrame, corrections: DataFrame, sexes: DataFrame) -> DataFrame:
    """``id, name``: names with their parts corrected one by one, never to a name of the other sex.

    The corrections are a closed set of saints' names: a map that every task holds
    (their number is that of distinct name parts, never of rows).
    """
    sex = sexes.select(F.col("part"), "sex")
    known = corrections.join(sex.select(F.col("part").alias("form"), F.col("sex").alias("s")), "form", "left").join(sex.select(F.col("part").alias("target"), F.col("sex").alias("t")), "target", "left")
    sound = known.where("s is null or t is null or s = t").select("form", "target")
    parts = rows.select("id", F.posexplode(name_parts(F.col("name"))).alias("i", "form")).join(sound, "form", "left").withColumn("part", F.coalesce("target", "form"))
    return parts.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "part"))), lambda x: x["part"]), " ").alias("name"))


def vocabulary(forms: DataFrame, declared: DataFrame | None = None, least: float = 0.86, times: float = 4.0) -> DataFrame:
    """``form, n, head``: each form under the most similar head ``times`` as common; a head stands for itself.

    Declared equivalences (``form, head``) come first. A form that is itself under a head
    cannot be one: whether a form is a head is settled from the commonest down, round by round.
    """
    from kinweave.session import materialise

    named = materialise(forms.select("form", "n", _bare("form").alias("key")), "vocabulary")
    pairs = weighted_pairs(named.select("key").distinct(), least, form="key")
    both = pairs.select(F.col("a").alias("key"), F.col("b").alias("other"), "similarity").unionByName(pairs.select(F.col("b").alias("key"), F.col("a").alias("other"), "similarity"))
    side = named.select(F.col("form").alias("over"), F.col("n").alias("m"), F.col("key").alias("other"))
    edges = materialise(named.join(both, "key").join(side, "other").where(F.col("m") >= times * F.col("n")).select("form", "over", "similarity", "m"), "vocabulary-edges")
    fixed = declared.select("form", "head") if declared is not None else None
    settled = materialise(named.join(edges, "form", "left_anti").select("form", F.col("form").alias("head")), "vocabulary-heads")
    while True:
        heads = settled.where("form = head").select(F.col("form").alias("over"))
        open_ = edges.join(settled, "form", "left_anti")
        # Settled once all that could be over it is settled: under the most similar head, or a head itself.
        waiting = open_.join(settled.select(F.col("form").alias("over")), "over", "left_anti").select("form").distinct()
        ready = open_.select("form").distinct().join(waiting, "form", "left_anti")
        if ready.isEmpty():
            break
        best = open_.join(ready, "form", "left_semi").join(heads, "over", "left_semi").groupBy("form").agg(F.min_by("over", F.struct(-F.col("similarity"), -F.col("m"), "over")).alias("head"))
        settled = materialise(settled.unionByName(ready.join(best, "form", "left").select("form", F.coalesce("head", "form").alias("head"))), "vocabulary-heads")
    out = named.join(settled, "form").select("form", "n", "head")
    if fixed is not None:
        out = out.join(fixed.withColumnRenamed("head", "said"), "form", "left").select("form", "n", F.coalesce("said", "head").alias("head"))
    return out


def family_frequencies(rows: DataFrame, heads: DataFrame, column: str) -> DataFrame:
    """``head, n``: how often each family of forms stands (``heads``: ``form, head``)."""
    return rows.join(heads.select(F.col("form").alias(column), "head"), column).groupBy("head").agg(F.count("*").alias("n"))


def rare_attributes(rows: DataFrame, heads: DataFrame, column: str, most: int = 3) -> DataFrame:
    """``id, value, head``: rows whose trade or place is rare (at most ``most``) and stands under another word."""
    odd = heads.where((F.col("n") <= most) & (F.col("form") != F.col("head"))).select(F.col("form").alias(column), "head")
    return rows.join(odd, column).select("id", F.col(column).alias("value"), "head")


def place_proposals(places: DataFrame, least: float = 0.7) -> DataFrame:
    """``form, n, target``: places whose core is alike (.70) to that of one at least four times as common; ``places``: ``form, n, core``."""
    cores = places.where("core is not null").groupBy("core").agg(F.sum("n").alias("n"))
    keyed = cores.select(F.regexp_replace("core", " ", "").alias("form"), "n").groupBy("form").agg(F.sum("n").alias("n"))
    found = dominated(keyed, weighted_pairs(keyed, least), ((least, 4.0),))
    label = places.where("core is not null").groupBy(F.regexp_replace("core", " ", "").alias("key")).agg(F.max_by("form", F.struct("n", "form")).alias("label"))
    return places.withColumn("key", F.regexp_replace("core", " ", "")).join(found.select(F.col("form").alias("key"), F.col("target").alias("over")), "key").join(label.select(F.col("key").alias("over"), F.col("label").alias("target")), "over").select("form", "n", "target")


def same_person_elsewhere(rows: DataFrame, glossary: DataFrame, tolerance: int = 2, least_age: int = 12) -> DataFrame:
    """``form, target, cases``: pairs of mentions alike but for the two forms of a surname: given name, and birth at most so far apart.

    ``rows``: ``name, surname, year, age``; ``glossary``: ``form, target``.
    """
    people = rows.where(F.col("age") >= least_age).select(F.lower("name").alias("name"), "surname", (F.col("year") - F.col("age")).alias("born")).where("name is not null and surname is not null")
    # Mentions alike in all three are one row with their number: pairs are counted, not spelled out.
    people = people.groupBy("name", "surname", "born").agg(F.count("*").alias("n"))
    # For each year, how many were born at most so far from it.
    near = people.select("name", F.col("surname").alias("target"), F.explode(F.sequence(F.col("born") - tolerance, F.col("born") + tolerance)).alias("born"), "n")
    near = near.groupBy("name", "target", "born").agg(F.sum("n").alias("others"))
    left = glossary.join(people.withColumnRenamed("surname", "form"), "form")
    return left.join(near, ["name", "target", "born"]).groupBy("form", "target").agg(F.sum(F.col("n") * F.col("others")).alias("cases"))


def family_in_one_act(rows: DataFrame, links: DataFrame, glossary: DataFrame) -> DataFrame:
    """``form, target, cases``: a father and his child in one act, read with the two forms of one surname."""
    own = rows.select("id", F.col("surname").alias("s"))
    pairs = links.where("father is not null").select("id", "father").join(own, "id").join(own.select(F.col("id").alias("father"), F.col("s").alias("t")), "father")
    both = pairs.select(F.col("s").alias("form"), F.col("t").alias("target")).unionByName(pairs.select(F.col("t").alias("form"), F.col("s").alias("target")))
    return both.join(glossary.select("form", "target"), ["form", "target"]).groupBy("form", "target").agg(F.count("*").alias("cases"))


def surname_from_father(children: DataFrame, forms: DataFrame) -> DataFrame:
    """``child, surname, target, rule``: surnames of children put right by their father's, by the first rule that holds.

    ``children``: ``child, surname, father_surname``. Rules: the father's is at least four
    times as common and alike by .80 (``dominated``); the pair of readings stands twice or
    more and is alike by .70 (``recurrent``); the child's stands at most twice in all and the
    father's three times or more, alike by .60 (``rare``); the child's stands at most three times
    and the father's eight times as often (``vanishing``).
    """
    n = lambda c, out: forms.select(F.col("form").alias(c), F.col("n").alias(out))
    differ = children.where("surname is not null and father_surname is not null and surname <> father_surname")
    pairs = differ.groupBy("surname", "father_surname").agg(F.count("*").alias("pairs"))
    pairs = pairs.join(n("surname", "own"), "surname").join(n("father_surname", "his"), "father_surname").withColumns({"x": _bare("surname"), "y": _bare("father_surname")})
    pairs = pairs.withColumn("similarity", similarity_udf("x", "y"))
    s, own, his = F.col("similarity"), F.col("own"), F.col("his")
    rule = F.when((s >= 0.8) & (his >= 4 * own), "dominated").when((s >= 0.7) & (F.col("pairs") >= 2) & (his > own), "recurrent").when((s >= 0.6) & (own <= 2) & (his >= 3), "rare").when((own <= 3) & (his >= 8 * own), "vanishing")
    judged = pairs.withColumn("rule", rule).where("rule is not null").select("surname", "father_surname", "rule")
    return differ.join(judged, ["surname", "father_surname"]).select("child", "surname", F.col("father_surname").alias("target"), "rule")


def surname_by_siblings(children: DataFrame) -> DataFrame:
    """``child, surname, target``: the surname that most brothers and sisters of one couple bear, where a child's differs and is alone.

    ``children``: ``child, father, mother, surname``. A tie decides nothing.
    """
    house = canonical(F.col("surname"))
    each = children.where("surname is not null and father is not null and mother is not null").withColumn("house", house)
    votes = each.groupBy("father", "mother", "house").agg(F.count("*").alias("n"), F.min("surname").alias("label"))
    order = Window.partitionBy("father", "mother").orderBy(F.desc("n"), "house")
    ranked = votes.withColumns({"place": F.row_number().over(order), "next": F.lead("n").over(order)})
    won = ranked.where("place = 1 and n >= 2 and (next is null or n > next)").select("father", "mother", F.col("house").alias("won"), "label")
    alone = each.join(won, ["father", "mother"]).join(votes.select("father", "mother", "house", F.col("n").alias("own")), ["father", "mother", "house"]).where("house <> won and own = 1")
    return alone.select("child", "surname", F.col("label").alias("target"))


def second_name_as_surname(rows: DataFrame, balance: DataFrame, times: float = 5.0) -> DataFrame:
    """``id``: rows whose surname is a word read ``times`` as often as a given name (balance under 1 / (times + 1))."""
    odd = balance.where(F.col("balance") * (times + 1) <= 1).select("word")
    return rows.withColumn("word", F.lower("surname")).join(odd, "word", "left_semi").select("id")

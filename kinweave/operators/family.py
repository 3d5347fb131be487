"""Family tables and the checks a family graph must pass.

Tables: ``people(id, sex, birth, death, name, surname, born, certain)`` (``certain``: the
year of birth is that of a birth record, ``born`` its day), ``parents(child, parent, kind)``
with kind ``father`` or ``mother``, ``unions(id, husband, wife, year, documented)`` and
``mentions(person, act, year, type, role, name, surname, age, at_least, status)``. Unknown
years are null, and an unknown year never contradicts anything. Every check returns the
ids it objects to; CHECKS names each with its category and the population it is measured
against. Checks of names, days or mentions ask for those columns only. Tables of people,
edges and mentions are shuffled, never sent whole through the driver: they are small on
disk and large in its memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.similarity import name_similarity_udf, unlike_udf
from kinweave.functions.text import name_parts, normal


@dataclass
class Family:
    people: DataFrame
    parents: DataFrame
    unions: DataFrame
    mentions: DataFrame | None = None

    def linked(self) -> DataFrame:
        """Parent edges with the years of both ends."""
        child = self.people.select(F.col("id").alias("child"), F.col("birth").alias("child_birth"))
        parent = self.people.select(F.col("id").alias("parent"), F.col("birth").alias("parent_birth"), F.col("death").alias("parent_death"), F.col("sex").alias("parent_sex"))
        return self.parents.hint("merge").join(child, "child").hint("merge").join(parent, "parent")

    def couples(self) -> DataFrame:
        """Unions with both spouses' sex and years."""
        side = lambda who: self.people.select(F.col("id").alias(who), *[F.col(c).alias(f"{who}_{c}") for c in ("sex", "birth", "death")])
        return self.unions.hint("merge").join(side("husband"), "husband").hint("merge").join(side("wife"), "wife")

    def spouses(self) -> DataFrame:
        """Both ends of each union in one column; a union with oneself counts once."""
        return self.unions.select(F.col("id").alias("union_id"), "year", F.explode(F.array_distinct(F.array("husband", "wife"))).alias("id"))

    def broods(self) -> DataFrame:
        """``father, mother, child`` of each child with both: every father with every mother of it."""
        side = lambda kind: self.parents.where(F.col("kind") == kind).select("child", F.col("parent").alias(kind)).distinct()
        return side("father").hint("merge").join(side("mother"), "child")

    def written(self) -> Family:
        """The same tables written down once, for checks that read them many times."""
        from kinweave.session import materialise

        return Family(*[None if t is None else materialise(t, "family") for t in (self.people, self.parents, self.unions, self.mentions)])


def several_parents(kind: str) -> Callable[[Family], DataFrame]:
    """Children with more than one father (or mother)."""

    def check(f: Family) -> DataFrame:
        held = f.parents.where(F.col("kind") == kind).groupBy("child").agg(F.count_distinct("parent").alias("n"))
        return held.where("n > 1").select(F.col("child").alias("id"))

    return check


def parent_too_young(f: Family) -> DataFrame:
    """Children of a parent under 13."""
    return f.linked().where("child_birth - parent_birth < 13").select(F.col("child").alias("id"))


def parent_too_old(f: Family) -> DataFrame:
    """Children of a mother over 52 or a father over 78."""
    return f.linked().where("child_birth - parent_birth > if(kind = 'mother', 52, 78)").select(F.col("child").alias("id"))


def born_after_death(f: Family) -> DataFrame:
    """Children born after their parent's death; a father may have died the year before."""
    return f.linked().where("child_birth > parent_death + if(kind = 'father', 1, 0)").select(F.col("child").alias("id"))


def bearing_span(f: Family) -> DataFrame:
    """Mothers whose children span more than 35 years."""
    span = f.linked().where("kind = 'mother'").groupBy("parent").agg((F.max("child_birth") - F.min("child_birth")).alias("span"))
    return span.where("span > 35").select(F.col("parent").alias("id"))


def death_before_birth(f: Family) -> DataFrame:
    return f.people.where("death < birth").select("id")


def too_long_a_life(f: Family) -> DataFrame:
    return f.people.where("death - birth > 105").select("id")


def married_to_self(f: Family) -> DataFrame:
    return f.unions.where("husband = wife").select("id")


def same_sex_union(f: Family) -> DataFrame:
    return f.couples().where("husband_sex = wife_sex").select("id")


def marrying_age(f: Family) -> DataFrame:
    """Documented unions of a spouse under 13 or over 75."""
    out = "documented and (year - husband_birth not between 13 and 75 or year - wife_birth not between 13 and 75)"
    return f.couples().where(out).select("id")


def close_kin(f: Family) -> DataFrame:
    """Unions of parent and child, or of two children of one parent."""
    edges = f.parents.select("child", "parent").distinct()
    ends = f.unions.where("husband <> wife").select("id", "husband", "wife")
    up = ends.hint("merge").join(edges, ((F.col("husband") == F.col("child")) & (F.col("wife") == F.col("parent")))).select("id")
    down = ends.hint("merge").join(edges, ((F.col("wife") == F.col("child")) & (F.col("husband") == F.col("parent")))).select("id")
    his = ends.hint("merge").join(edges.withColumnsRenamed({"child": "husband", "parent": "p"}), "husband")
    both = his.hint("merge").join(edges.withColumnsRenamed({"child": "wife", "parent": "p"}), ["wife", "p"]).select("id")
    return up.union(down).union(both).distinct()


def written_twice(f: Family) -> DataFrame:
    """Couples in more than one union row, either way round: the later rows."""
    pair = Window.partitionBy(F.least("husband", "wife"), F.greatest("husband", "wife")).orderBy("id")
    return f.unions.withColumn("n", F.row_number().over(pair)).where("n > 1").select("id")


def many_spouses(f: Family) -> DataFrame:
    """People in more than two unions."""
    return f.spouses().groupBy("id").agg(F.count("*").alias("n")).where("n > 2").select("id")


def own_ancestor(f: Family) -> DataFrame:
    """People from whom parent edges lead back to themselves."""
    from kinweave.operators.graph import cycle_nodes

    return cycle_nodes(f.parents.select(F.col("child").alias("a"), F.col("parent").alias("b"))).select(F.col("node").alias("id"))


def two_couples(f: Family) -> DataFrame:
    """Children of more than one couple of a father and a mother."""
    return f.broods().groupBy("child").agg(F.count("*").alias("n")).where("n > 1").select(F.col("child").alias("id"))


def births_too_close(f: Family) -> DataFrame:
    """Mothers of two children born on different days less than 250 days apart, once for each such pair in a row."""
    women = f.people.where("sex = 'F'").select(F.col("id").alias("parent"))
    days = f.parents.where("kind = 'mother'").hint("merge").join(women, "parent").hint("merge").join(f.people.where("certain").select(F.col("id").alias("child"), "born"), "child").select("parent", "born").where("born is not null").distinct()
    order = Window.partitionBy("parent").orderBy("born")
    return days.withColumn("gap", F.datediff("born", F.lag("born").over(order))).where("gap < 250").select(F.col("parent").alias("id"))


#: Roles in which only the living act, and words for the dead.
LIVING = ("groom", "bride", "father", "mother", "declarant", "witness")


def acts_after_death(f: Family) -> DataFrame:
    """People in a living role after the year of their death, once for each act; those called late are not counted."""
    status = F.coalesce("status", F.lit(""))
    acts = f.mentions.where(F.col("role").isin(*LIVING) & ~status.ilike("%fu%") & ~status.ilike("%defunt%"))
    return acts.hint("merge").join(f.people.select(F.col("id").alias("person"), "death"), "person").where("year > death").select(F.col("person").alias("id"))


def years_in_role(role: str) -> Callable[[Family], DataFrame]:
    """People with acts of more than one year in a role that a life has once."""

    def check(f: Family) -> DataFrame:
        held = f.mentions.where(F.col("role") == role).groupBy("person").agg(F.count_distinct("year").alias("n"))
        return held.where("n > 1").select(F.col("person").alias("id"))

    return check


def _text(f: Family, who: str) -> DataFrame:
    """``who`` and the parts of its name and surname, for comparisons."""
    return f.people.select(F.col("id").alias(who), name_parts(F.concat_ws(" ", "name", "surname")).alias(f"{who}_parts"), F.lower(F.concat_ws(" ", "name", "surname")).alias(f"{who}_text"))


def duplicate_spouses(f: Family) -> DataFrame:
    """People with two spouses of one name (similarity .80), once for each pair; not where the one had died by the other's wedding."""
    wed = f.unions.where("husband is not null and wife is not null")
    sides = wed.select(F.col("husband").alias("id"), F.col("wife").alias("s"), "year").unionByName(wed.select(F.col("wife").alias("id"), F.col("husband").alias("s"), "year"))
    once = sides.groupBy("id", "s").agg(F.min("year").alias("year"))
    dead = f.people.select(F.col("id").alias("s"), "death")
    each = once.hint("merge").join(dead, "s")
    pairs = each.select("id", F.col("s").alias("a"), F.col("year").alias("ya"), F.col("death").alias("da")).hint("merge").join(each.select("id", F.col("s").alias("b"), F.col("year").alias("yb"), F.col("death").alias("db")), "id").where("a < b")
    pairs = pairs.where(~F.coalesce(F.col("da") <= F.col("yb"), F.lit(False)) & ~F.coalesce(F.col("db") <= F.col("ya"), F.lit(False)))
    named = pairs.hint("merge").join(_text(f, "a"), "a").hint("merge").join(_text(f, "b"), "b")
    return named.where(name_similarity_udf("a_parts", "b_parts") >= 0.8).select("id")


def same_birth_homonyms(f: Family) -> DataFrame:
    """Groups of one name, surname and certain year of birth in which two share a parent's name, or one has no parents: their smallest id."""
    held = f.people.where("certain and birth is not null and name is not null and surname is not null").select("id", "name", "surname", "birth")
    parents = f.parents.hint("merge").join(f.people.select(F.col("id").alias("parent"), F.col("name").alias("pn"), F.col("surname").alias("ps")), "parent").where("pn is not null").select(F.col("child").alias("id"), "pn", "ps").distinct()
    keys = ["name", "surname", "birth"]
    groups = held.hint("merge").join(parents.select("id").distinct().withColumn("known", F.lit(1)), "id", "left").groupBy(*keys).agg(F.count("*").alias("n"), F.count("known").alias("known"), F.min("id").alias("id")).where("n > 1")
    shared = held.hint("merge").join(parents, "id").groupBy(*keys, "pn", "ps").agg(F.count_distinct("id").alias("m")).where("m > 1").select(*keys).distinct().withColumn("shared", F.lit(True))
    return groups.hint("merge").join(shared, keys, "left").where("known < n or shared").select("id")


def twin_couples(f: Family) -> DataFrame:
    """Two couples with children whose names are the same two (similarity .80): the smaller father's id, once for each pair.

    Names meet by the first three letters of both given names, and couples by pairs of like
    names, with their facts beside them: couples are shuffled, never their pairs. Left out are pairs whose
    children span more than 35 years together, whose parents were under 13 for them, who
    have two deaths or two certain births of different years, whose houses were each read
    three times or more and never crossed, or of whom one died more than a year before the
    other couple's last child.
    """
    from kinweave.operators.blocking import meet

    births = f.people.select(F.col("id").alias("child"), F.col("birth").alias("cb"))
    couples = f.broods().hint("merge").join(births, "child").groupBy("father", "mother").agg(F.min("cb").alias("first"), F.max("cb").alias("last"))
    for who in ("father", "mother"):
        facts = f.people.select(F.col("id").alias(who), *[F.col(c).alias(f"{who}_{c}") for c in ("birth", "death", "certain")])
        couples = couples.hint("merge").join(facts, who).hint("merge").join(_text(f, who), who)
    read = f.mentions.where("surname is not null").groupBy(F.col("person").alias("father"), F.lower("surname").alias("surname")).agg(F.count("*").alias("n"))
    houses = read.groupBy("father").agg(F.max_by("surname", F.struct("n", "surname")).alias("house"), F.max("n").alias("most"), F.collect_set("surname").alias("all"))
    couples = couples.hint("merge").join(houses, "father", "left")
    texts = ["father_text", "mother_text", "father_parts", "mother_parts"]
    couples = couples.withColumns({"texts": F.struct(*texts), "couple": F.struct("father", "mother")}).drop(*texts)
    # Names are compared once for each two pairs of names, either way round, so that only couples of like names meet.
    alike = lambda a, b: (name_similarity_udf(f"{a}.father_parts", f"{b}.father_parts") >= 0.8) & (name_similarity_udf(f"{a}.mother_parts", f"{b}.mother_parts") >= 0.8)
    names = couples.select("texts").distinct()
    head = F.concat_ws("|", F.substring("texts.father_text", 1, 3), F.substring("texts.mother_text", 1, 3))
    two = meet(names.withColumn("key", head), ["key"], "texts", distinct=False).unionByName(names.select(F.col("texts").alias("a"), F.col("texts").alias("b")))
    near = two.select("a", "b", alike("a", "b").alias("ab"), alike("b", "a").alias("ba")).where("ab or ba")
    ends = near.select(F.struct("a", "b", "ab", "ba").alias("block"), F.explode(F.array_distinct(F.array("a", "b"))).alias("texts"))
    pairs = meet(couples.hint("merge").join(ends, "texts"), ["block"], "couple", distinct=False, facts=[c for c in couples.columns if c != "couple"], name_block=True)
    pairs = pairs.where("(a_texts = block.a and b_texts = block.b and block.ab) or (a_texts = block.b and b_texts = block.a and block.ba)").drop("block")
    known = lambda c: F.coalesce(c, F.lit(False))
    first, last = F.least("a_first", "b_first"), F.greatest("a_last", "b_last")
    out = known(last - first > 35)
    for s in ("a", "b"):
        for who in ("father", "mother"):
            out |= known(F.col(f"{s}_{who}_certain") & (first < F.col(f"{s}_{who}_birth") + 13))
            out |= known(F.col(f"{'b' if s == 'a' else 'a'}_last") > F.col(f"{s}_{who}_death") + 1)
    for who in ("father", "mother"):
        two = known(F.col(f"a_{who}_death") != F.col(f"b_{who}_death")) | known(F.col(f"a_{who}_certain") & F.col(f"b_{who}_certain") & (F.col(f"a_{who}_birth") != F.col(f"b_{who}_birth")))
        out |= (F.col(f"a_{who}") != F.col(f"b_{who}")) & two
    pairs = pairs.where(~out)
    apart = (F.col("a_house") != F.col("b_house")) & (F.least("a_most", "b_most") >= 3) & ~F.array_contains("a_all", F.col("b_house")) & ~F.array_contains("b_all", F.col("a_house"))
    pairs = pairs.where(~known(apart & (F.col("a_father") != F.col("b_father"))))
    return pairs.select(F.least("a_father", "b_father").alias("id"))


def living_same_name_siblings(f: Family) -> DataFrame:
    """Children of a couple named like the one before them, who has no death and is seen after their birth: once for each couple."""
    seen = f.mentions.groupBy(F.col("person").alias("child")).agg(F.max("year").alias("seen"))
    baptised = f.mentions.where("role = 'newborn' and name is not null").groupBy(F.col("person").alias("child")).agg(F.collect_set(F.lower("name")).alias("given"))
    people = f.people.where("name is not null and name <> ''").select(F.col("id").alias("child"), F.lower("name").alias("key"), "birth", "death")
    rows = f.broods().hint("merge").join(people, "child").hint("merge").join(seen, "child", "left").hint("merge").join(baptised, "child", "left")
    order = Window.partitionBy("father", "mother", "key").orderBy(F.col("birth").asc_nulls_first(), "child")
    before = lambda c: F.lag(c).over(order)
    rows = rows.withColumns({"twin": before("child"), "twin_death": before("death"), "twin_seen": before("seen"), "twin_given": before("given")})
    alive = F.col("twin_death").isNull() & (F.col("birth").isNull() | (F.coalesce("twin_seen", F.lit(0)) > F.col("birth")))
    disjoint = F.coalesce(~F.arrays_overlap("twin_given", "given"), F.lit(False))
    return rows.where(F.col("twin").isNotNull() & alive & ~disjoint).select(F.col("child").alias("id"))


def irreconcilable_surnames(f: Family) -> DataFrame:
    """People with more than four surnames no two of which are alike (.72), unless they have just one spouse."""
    held = f.mentions.where("surname is not null").groupBy(F.col("person").alias("id")).agg(F.collect_set(F.regexp_replace(normal(F.col("surname")), " ", "")).alias("forms")).where("size(forms) > 4")
    wed = f.spouses().groupBy("id").agg(F.count("*").alias("n"))
    found = held.hint("merge").join(wed, "id", "left").where("coalesce(n, 0) <> 1")
    return found.where(unlike_udf("forms", 0.72) > 4).select("id")


def age_against_birth(f: Family) -> DataFrame:
    """People whose stated age is more than ten years off their birth record, once for each mention; bounds are not ages."""
    stated = f.mentions.where("age is not null and not coalesce(at_least, false)")
    return stated.hint("merge").join(f.people.where("certain").select(F.col("id").alias("person"), "birth"), "person").where("abs(year - age - birth) > 10").select(F.col("person").alias("id"))


#: name: (category, check, population)
CHECKS: dict[str, tuple[str, Callable[[Family], DataFrame], str]] = {
    "two_fathers": ("impossible", several_parents("father"), "children with a father"),
    "two_mothers": ("impossible", several_parents("mother"), "children with a mother"),
    "two_couples": ("impossible", two_couples, "children with both"),
    "births_too_close": ("impossible", births_too_close, "mothers of several"),
    "parent_too_young": ("impossible", parent_too_young, "links with both births"),
    "parent_too_old": ("impossible", parent_too_old, "links with parent's birth"),
    "bearing_span": ("impossible", bearing_span, "mothers of several"),
    "born_after_death": ("impossible", born_after_death, "links with parent's death"),
    "acts_after_death": ("impossible", acts_after_death, "mentions of the dead"),
    "two_deaths": ("impossible", years_in_role("deceased"), "dead"),
    "two_births": ("impossible", years_in_role("newborn"), "certain births"),
    "death_before_birth": ("impossible", death_before_birth, "both years known"),
    "too_long_a_life": ("impossible", too_long_a_life, "both years known"),
    "close_kin": ("impossible", close_kin, "unions"),
    "married_to_self": ("impossible", married_to_self, "unions"),
    "same_sex_union": ("impossible", same_sex_union, "unions"),
    "written_twice": ("impossible", written_twice, "unions"),
    "marrying_age": ("impossible", marrying_age, "documented unions"),
    "own_ancestor": ("impossible", own_ancestor, "children"),
    "duplicate_spouses": ("fragmentation", duplicate_spouses, "several unions"),
    "same_birth_homonyms": ("fragmentation", same_birth_homonyms, "certain births"),
    "twin_couples": ("fragmentation", twin_couples, "couples with children"),
    "living_same_name_siblings": ("fragmentation", living_same_name_siblings, "couples with children"),
    "many_spouses": ("over-merge", many_spouses, "spouses"),
    "irreconcilable_surnames": ("over-merge", irreconcilable_surnames, "several mentions"),
    "age_against_birth": ("suspect", age_against_birth, "ages of certain births"),
}


def populations(f: Family) -> dict[str, DataFrame]:
    """What each check is measured against: one row an individual, edge, union or mention."""
    linked, several = f.linked(), lambda rows, *keys: rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    child = lambda kind: f.parents.where(F.col("kind") == kind).select("child").distinct()
    people = f.people.select(F.col("id").alias("person"), "death", "certain")
    return {
        "spouses": f.spouses().select("id").distinct(),
        "several mentions": several(f.mentions, "person"),
        "children with a father": child("father"),
        "children with a mother": child("mother"),
        "children with both": child("father").intersect(child("mother")),
        "mothers of several": several(f.parents.where("kind = 'mother'").select("parent", "child").distinct(), "parent"),
        "links with both births": linked.where("child_birth is not null and parent_birth is not null"),
        "links with parent's birth": linked.where("parent_birth is not null"),
        "links with parent's death": linked.where("parent_death is not null"),
        "mentions of the dead": f.mentions.hint("merge").join(people.where("death is not null"), "person"),
        "dead": f.people.where("death is not null"),
        "certain births": f.people.where("certain"),
        "both years known": f.people.where("birth is not null and death is not null"),
        "unions": f.unions,
        "documented unions": f.unions.where("documented"),
        "children": f.parents.select("child").distinct(),
        "several unions": several(f.spouses(), "id"),
        "couples with children": f.broods().select("father", "mother").distinct(),
        "ages of certain births": f.mentions.where("age is not null").hint("merge").join(people.where("certain"), "person"),
        "people": f.people,
    }


def _counted(named: Iterable[tuple[str, DataFrame]], key: str, value: str) -> DataFrame:
    """``key, value``: the rows of each table, counted one table after the other."""
    from kinweave.session import gathered

    return gathered((rows.agg(F.count("*").alias(value)).select(F.lit(name).alias(key), value) for name, rows in named), "counted")


def scorecard(f: Family, checks: dict[str, tuple[str, Callable[[Family], DataFrame], str]] = CHECKS) -> DataFrame:
    """``check, category, found, population, size`` of every check: one row a check, counted apart."""
    f = f.written()
    sizes = _counted(((k, v) for k, v in populations(f).items() if k in {p for _, _, p in checks.values()}), "population", "size")
    names = f.people.sparkSession.createDataFrame([(name, category, population) for name, (category, _, population) in checks.items()], "check string, category string, population string")
    found = _counted(((name, check(f)) for name, (_, check, _) in checks.items()), "check", "found")
    return found.join(F.broadcast(names), "check").join(F.broadcast(sizes), "population")  # one row a check, one a population


def signed_deltas(mine: DataFrame, other: DataFrame) -> DataFrame:
    """``check, category, mine, other, delta, verdict`` of two scorecards: fewer objections are better."""
    both = mine.select("check", "category", F.col("found").alias("mine")).join(other.select("check", F.col("found").alias("other")), "check", "full")
    delta = F.coalesce("mine", F.lit(0)) - F.coalesce("other", F.lit(0))
    return both.select("check", "category", "mine", "other", delta.alias("delta"), F.when(delta < 0, "better").when(delta > 0, "worse").otherwise("same").alias("verdict"))


def linkage_metrics(f: Family) -> DataFrame:
    """``metric, value``: the twelve figures of a linkage."""
    f = f.written()
    by = f.mentions.groupBy(F.col("person").alias("id")).agg(F.count("*").alias("n"), F.max("year").alias("last"))
    seen = f.people.join(by, "id", "left")
    parents, kids = f.parents.select(F.col("child").alias("id")).distinct(), f.parents.select(F.col("parent").alias("id")).distinct()
    chain = f.parents.select("child", "parent").join(f.parents.select(F.col("child").alias("parent"), F.col("parent").alias("grandparent")), "parent")
    return _counted({
        "people": f.people,
        "single mention": seen.where("n = 1"),
        "with birth act": f.people.where("certain"),
        "born and seen again": seen.where("certain and n > 1"),
        "born and seen grown": seen.where("certain and last - birth >= 18"),
        "born with children": f.people.where("certain").join(kids, "id", "left_semi"),
        "deaths with known birth": f.people.where("death is not null and certain"),
        "with parents": parents,
        "with children": kids,
        "grandparent chains": chain,
        "couples": f.broods().select("father", "mother").distinct(),
        "documented couples": f.unions.where("documented"),
    }.items(), "metric", "value")


def largest_families(f: Family, most: int = 40) -> DataFrame:
    """``father, mother, children, first, last``: the couples with most children, ties to the smaller ids."""
    born = f.people.select(F.col("id").alias("child"), "birth")
    each = f.broods().join(born, "child").groupBy("father", "mother").agg(F.count("*").alias("children"), F.min("birth").alias("first"), F.max("birth").alias("last"))
    return each.orderBy(F.desc("children"), "father", "mother").limit(most)


def clean_parents(f: Family) -> tuple[DataFrame, DataFrame]:
    """Parent edges after the hard rules, and what was taken out with its reason.

    The rules in order: a parent of another sex than its kind, of impossible age or dead
    before the birth; then, of several of one kind, the one nearest to thirty years older.
    """
    gap = F.col("child_birth") - F.col("parent_birth")
    reason = (
        F.when((F.col("kind") == "father") != (F.col("parent_sex") == "M"), "sex")
        .when(gap < 13, "too young").when(gap > F.when(F.col("kind") == "mother", 55).otherwise(75), "too old")
        .when(F.col("child_birth") > F.col("parent_death") + F.when(F.col("kind") == "father", 1).otherwise(0), "dead")
    )
    judged = f.linked().withColumn("reason", reason)
    pick = Window.partitionBy("child", "kind").orderBy(F.abs(F.coalesce(gap, F.lit(1000)) - 30), "parent")
    sound = judged.where("reason is null").withColumn("n", F.row_number().over(pick))
    columns = ["child", "parent", "kind"]
    out = judged.where("reason is not null").select(*columns, "reason").unionByName(sound.where("n > 1").select(*columns, F.lit("second").alias("reason")))
    return sound.where("n = 1").select(*columns), out


def spaced_births(f: Family) -> tuple[DataFrame, DataFrame]:
    """Mothers' edges without children born less than 250 days after another, and those taken out: of such a pair the later."""
    days = f.people.select(F.col("id").alias("child"), "born")
    order = Window.partitionBy("parent").orderBy("born", "child")
    rows = f.parents.where("kind = 'mother'").join(days, "child").withColumn("gap", F.datediff("born", F.lag("born").over(order)))
    close = F.coalesce((F.col("gap") > 0) & (F.col("gap") < 250), F.lit(False))
    return rows.where(~close).select("child", "parent", "kind"), rows.where(close).select("child", "parent", "kind", F.lit("spacing").alias("reason"))


def within_span(members: DataFrame, group: str, value: str, most: int) -> tuple[DataFrame, DataFrame]:
    """``members`` whose values of one group span at most ``most``, and those taken out.

    Again and again the value farthest from the group's upper median goes (of two, the
    larger), until the span fits; a round takes one row of every group still too wide.
    """
    from kinweave.session import materialise

    left = materialise(members, "span")
    out = left.where("false")
    while True:
        known = left.where(F.col(value).isNotNull())
        wide = known.groupBy(group).agg(F.sort_array(F.collect_list(value)).alias("v")).where(F.element_at("v", -1) - F.element_at("v", 1) > most)  # the children of one mother
        middle = wide.select(group, F.element_at("v", F.floor(F.size("v") / 2).cast("int") + 1).alias("middle"))
        worst = Window.partitionBy(group).orderBy(F.desc(F.abs(F.col(value) - F.col("middle"))), F.desc(value), *[c for c in members.columns if c not in (group, value)])
        gone = materialise(known.join(middle, group).withColumn("n", F.row_number().over(worst)).where("n = 1").select(*members.columns), "span-out")
        if gone.isEmpty():
            return left, out
        left, out = materialise(left.join(gone, members.columns, "left_anti"), "span"), out.unionByName(gone)


def clean_unions(f: Family) -> tuple[DataFrame, DataFrame]:
    """Unions after the hard rules, and those taken out with the first reason that holds."""
    kin, twice = close_kin(f).withColumn("kin", F.lit(True)), written_twice(f).withColumn("twice", F.lit(True))
    rows = f.unions.join(f.couples().select("id", "husband_sex", "wife_sex", "husband_birth", "wife_birth"), "id", "left").join(kin, "id", "left").join(twice, "id", "left")
    age = lambda who: F.col("year") - F.col(f"{who}_birth")
    reason = (
        F.when(F.col("husband") == F.col("wife"), "self").when(F.col("kin"), "kin").when(F.col("husband_sex") == F.col("wife_sex"), "sex")
        .when(~age("husband").between(13, 75) | ~age("wife").between(13, 75), "age").when(F.col("twice"), "twice")
    )
    judged = rows.withColumn("reason", reason).select(*f.unions.columns, "reason")
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null")


def union_edges(marriages: DataFrame, children: DataFrame, people: DataFrame) -> DataFrame:
    """``husband, wife, year, origin``: one row a couple; a marriage act beats a common child, the earliest year stands.

    ``marriages``: ``husband, wife, year``; ``children``: ``father, mother, year``. The man
    stands first, by sex and else by id; couples of one sex and of one person are left out.
    """
    sex = lambda who: people.select(F.col("id").alias(who), F.col("sex").alias(f"{who}_sex"))
    said = marriages.select(F.col("husband").alias("x"), F.col("wife").alias("y"), "year", F.lit(0).alias("rank")).unionByName(children.select(F.col("father").alias("x"), F.col("mother").alias("y"), "year", F.lit(1).alias("rank")))
    rows = said.where("x is not null and y is not null and x <> y").join(sex("x"), "x").join(sex("y"), "y").where("x_sex is null or y_sex is null or x_sex <> y_sex")
    turn = F.coalesce(F.col("x_sex") == "F", F.col("y_sex") == "M", F.col("x") > F.col("y"))
    pair = rows.select(F.when(turn, F.col("y")).otherwise(F.col("x")).alias("husband"), F.when(turn, F.col("x")).otherwise(F.col("y")).alias("wife"), "year", "rank")
    best = pair.groupBy("husband", "wife").agg(F.min("rank").alias("rank"), F.min(F.struct(F.col("rank"), F.col("year").isNull().alias("unknown"), F.col("year"))).alias("first"))
    return best.select("husband", "wife", F.col("first.year").alias("year"), F.when(F.col("rank") == 0, "marriage").otherwise("child").alias("origin"))


def parent_edges(claims: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The parent of each child and kind, and the losers: ``claims`` hold ``child, kind, parent, quality`` row by row.

    The best quality wins, then the most sources, then the smallest id.
    """
    held = claims.groupBy("child", "kind", "parent").agg(F.max("quality").alias("quality"), F.count("*").alias("sources"))
    order = Window.partitionBy("child", "kind").orderBy(F.desc("quality"), F.desc("sources"), "parent")
    ranked = held.withColumn("n", F.row_number().over(order))
    return ranked.where("n = 1").drop("n"), ranked.where("n > 1").drop("n")


def individuals(mentions: DataFrame, corpus: DataFrame) -> DataFrame:
    """One row a person: the form of surname best attested in the person and the corpus, years, and how many mentions.

    A form's score is its own count times one more than the logarithm of one more than the
    corpus's (``corpus``: ``surname, total``); ties go to the larger own count, then the later form.
    """
    forms = mentions.where("surname is not null").groupBy("person", "surname").agg(F.count("*").alias("n")).join(corpus, "surname", "left")
    score = F.col("n") * (1 + F.log10(F.coalesce("total", F.lit(0)) + 1))
    chosen = forms.groupBy("person").agg(F.max_by("surname", F.struct(F.round(score, 9), "n", "surname")).alias("surname"), F.count("*").alias("forms"))
    facts = mentions.groupBy("person").agg(F.count("*").alias("mentions"), F.min("year").alias("first"), F.max("year").alias("last"), F.min(F.when(F.col("role") == "newborn", F.col("year"))).alias("birth"), F.min(F.when(F.col("role") == "deceased", F.col("year"))).alias("death"))
    return facts.join(chosen, "person", "left")

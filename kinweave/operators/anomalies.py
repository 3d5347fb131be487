"""Detectors of what a finished family graph leaves in doubt: each gives rows ``kind, id, other, detail, severity``.

They read the tables of ``family.Family``. An anomaly is a question, not a correction.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.similarity import similarity_udf
from kinweave.functions.text import canonical, name_parts, normal
from kinweave.operators.family import Family, births_too_close
from kinweave.operators.interpret import sex_by_ending


def _row(kind: str, id_: Column, other: Column, detail: Column, severity: float) -> list[Column]:
    return [F.lit(kind).alias("kind"), id_.cast("long").alias("id"), other.cast("long").alias("other"), detail.cast("string").alias("detail"), F.lit(severity).alias("severity")]


def father_of_another_house(f: Family) -> DataFrame:
    """A father whose house is that of none of his children, who are several and of one house."""
    house = lambda who: f.people.where("surname is not null").select(F.col("id").alias(who), canonical(F.col("surname")).alias(f"{who}_house"))
    each = f.parents.where("kind = 'father'").select("child", F.col("parent").alias("father")).distinct().join(house("child"), "child").join(house("father"), "father")
    found = each.groupBy("father", "father_house").agg(F.count("*").alias("n"), F.min("child_house").alias("lo"), F.max("child_house").alias("hi")).where("n > 1 and lo = hi and lo <> father_house")
    return found.select(*_row("father of another house", F.col("father"), F.lit(None), F.col("lo"), 3.0))


def same_name_siblings(f: Family) -> DataFrame:
    """Two children of a couple with one name and no death of the first in between."""
    kids = f.broods().join(f.people.where("name is not null").select(F.col("id").alias("child"), F.lower("name").alias("key"), "birth", "death"), "child")
    order = Window.partitionBy("father", "mother", "key").orderBy(F.col("birth").asc_nulls_first(), "child")
    rows = kids.withColumns({"before": F.lag("child").over(order), "gone": F.lag("death").over(order)})
    return rows.where("before is not null and (gone is null or gone > birth)").select(*_row("same name siblings", F.col("child"), F.col("before"), F.col("key"), 1.0))


def born_before_wedding(f: Family, years: int = 2) -> DataFrame:
    """Children born more than ``years`` before the documented wedding of their parents."""
    wed = f.unions.where("documented").groupBy(F.col("husband").alias("father"), F.col("wife").alias("mother")).agg(F.min("year").alias("wed"))
    rows = f.broods().join(wed, ["father", "mother"]).join(f.people.select(F.col("id").alias("child"), "birth"), "child")
    return rows.where(F.col("wed") - F.col("birth") > years).select(*_row("born before wedding", F.col("child"), F.col("father"), F.col("wed") - F.col("birth"), 1.0))


def name_of_other_sex(f: Family) -> DataFrame:
    """Fathers with a woman's name by its ending, mothers with a man's."""
    by_name = sex_by_ending(F.element_at(name_parts(F.col("name")), 1))
    rows = f.parents.select(F.col("parent").alias("id"), "kind").distinct().join(f.people.where("name is not null").select("id", "name", by_name.alias("said")), "id")
    wrong = ((F.col("kind") == "father") & (F.col("said") == "F")) | ((F.col("kind") == "mother") & (F.col("said") == "M"))
    return rows.where(wrong).select(*_row("name of other sex", F.col("id"), F.lit(None), F.col("name"), 1.0))


def life_too_long(f: Family, most: int = 100) -> DataFrame:
    """People seen in acts over more years than a life has."""
    spans = f.mentions.groupBy("person").agg(F.min("year").alias("a"), F.max("year").alias("b")).where(F.col("b") - F.col("a") > most)
    return spans.select(*_row("life too long", F.col("person"), F.lit(None), F.col("b") - F.col("a"), 3.0))


def probable_duplicates(scored: DataFrame, low: float = -1.9, high: float = -0.9) -> DataFrame:
    """Pairs ``a, b, logit`` that were neither merged nor put aside."""
    return scored.where((F.col("logit") >= low) & (F.col("logit") < high)).select(*_row("probable duplicate", F.col("a"), F.col("b"), F.round("logit", 6), 0.3))


def inconsistent_ages(f: Family, years: int = 10) -> DataFrame:
    """Mentions whose stated age is far from the birth record."""
    rows = f.mentions.where("age is not null and not coalesce(at_least, false)").join(f.people.where("certain").select(F.col("id").alias("person"), "birth"), "person")
    gap = F.abs(F.col("year") - F.col("age") - F.col("birth"))
    return rows.where(gap > years).select(*_row("inconsistent age", F.col("person"), F.col("act"), gap, 1.0))


def impossible_births(f: Family) -> DataFrame:
    """Mothers of two children less than nine months apart."""
    return births_too_close(f).select(*_row("impossible births", F.col("id"), F.lit(None), F.lit("under 250 days"), 3.0))


def spouse_periods(f: Family) -> DataFrame:
    """``id, spouse, first, last``: the years from a wedding or first child to the last child or the wedding, of each spouse."""
    kids = f.broods().join(f.people.select(F.col("id").alias("child"), F.col("birth").alias("year")), "child").select(F.col("father").alias("husband"), F.col("mother").alias("wife"), "year")
    years = f.unions.where("husband <> wife").select("husband", "wife", "year").unionByName(kids)
    both = years.select(F.col("husband").alias("id"), F.col("wife").alias("spouse"), "year").unionByName(years.select(F.col("wife").alias("id"), F.col("husband").alias("spouse"), "year"))
    return both.where("year is not null and id <> spouse").groupBy("id", "spouse").agg(F.min("year").alias("first"), F.max("year").alias("last"))


def contemporary_spouses(f: Family) -> DataFrame:
    """Spouses whose time overlaps that of the next one, who are not known to have died by then."""
    order = Window.partitionBy("id").orderBy("first", "last", "spouse")
    rows = spouse_periods(f).withColumns({"next": F.lead("spouse").over(order), "next_first": F.lead("first").over(order)})
    dead = f.people.select(F.col("id").alias("spouse"), "death")
    found = rows.where("next is not null and next_first <= last").join(dead, "spouse").where("death is null or death > next_first")
    return found.select(*_row("contemporary spouses", F.col("id"), F.col("spouse"), F.col("next"), 1.0))


def suspect_surnames(f: Family, rare: int = 3, common: int = 10) -> DataFrame:
    """Children with a rare surname whose father bears a common one."""
    n = f.mentions.where("surname is not null").groupBy("surname").agg(F.count("*").alias("n"))
    of = lambda who: f.people.select(F.col("id").alias(who), F.col("surname").alias(f"{who}_surname")).join(n.select(F.col("surname").alias(f"{who}_surname"), F.col("n").alias(f"{who}_n")), f"{who}_surname", "left")
    rows = f.parents.where("kind = 'father'").select("child", F.col("parent").alias("father")).distinct().join(of("child"), "child").join(of("father"), "father")
    found = rows.where((F.coalesce("child_n", F.lit(0)) <= rare) & (F.col("father_n") >= common) & (F.col("child_surname") != F.col("father_surname")))
    return found.select(*_row("suspect surname", F.col("child"), F.col("father"), F.col("child_surname"), 1.0))


def decisive_doubts(mentions: DataFrame) -> DataFrame:
    """People known from one mention only, whose reading was marked uncertain; ``mentions``: ``person, act, uncertain``."""
    only = mentions.groupBy("person").agg(F.count("*").alias("n"), F.min("act").alias("act"), F.max("uncertain").alias("uncertain"))
    return only.where("n = 1 and uncertain").select(*_row("decisive doubt", F.col("person"), F.col("act"), F.lit("uncertain reading"), 0.3))


def homonyms(rows: DataFrame, margin: float = 0.6) -> DataFrame:
    """Mentions with two rival entities within ``margin`` of the best: emitted, not decided; ``rows``: ``mention, entity, logit``."""
    order = Window.partitionBy("mention").orderBy(F.desc("logit"), "entity")
    ranked = rows.withColumns({"place": F.row_number().over(order), "rival": F.lead("entity").over(order), "next": F.lead("logit").over(order)})
    return ranked.where((F.col("place") == 1) & (F.col("logit") - F.col("next") < margin)).select(*_row("homonyms", F.col("mention"), F.col("rival"), F.col("entity"), 1.0))


DETECTORS = (father_of_another_house, same_name_siblings, born_before_wedding, name_of_other_sex, life_too_long, inconsistent_ages, impossible_births, contemporary_spouses, suspect_surnames)


def all_anomalies(f: Family) -> DataFrame:
    """The rows of every detector that reads the family alone."""
    f = f.written()
    return reduce(DataFrame.unionByName, [d(f) for d in DETECTORS])


def alike_houses(a: str, b: str) -> Column:
    """The similarity of two surname columns."""
    bare = lambda c: F.regexp_replace(normal(F.col(c)), " ", "")
    return similarity_udf(bare(a), bare(b))

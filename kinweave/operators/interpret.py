"""What one record says beyond its cells: relations, ages, sexes and surnames, from its rows in order.

Rows: ``id, act, row, register, type, year, role, name, surname, age, trade, place,
status, note``. Windows run inside one act, which is a page at most; what a whole corpus
teaches (how often a word is a name or a surname) comes as a small table of words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.similarity import key_similarity, similarity_udf
from kinweave.functions.text import canonical, name_parts, normal

#: Roles that tell a sex, life states that do, and the men's names that end in -a.
MALE_ROLES = ("father", "groom", "husband", "grandfather")
FEMALE_ROLES = ("mother", "bride", "wife", "midwife", "grandmother")
MALE_STATES = ("vedovo", "celibe")
FEMALE_STATES = ("defunta", "definta", "vedova", "nubile")
MALE_IN_A = ("nicola", "andrea", "luca", "battista", "elia", "mattia", "geremia", "zaccaria", "tobia", "sabba", "barnaba", "aniceta")


def name_balance(rows: DataFrame, least: int = 5) -> DataFrame:
    """``word, n, balance``: of words read at least so often as name or surname, the share in which they were surnames."""
    cells = rows.select(F.explode(F.array(F.struct(F.lower("name").alias("word"), F.lit(0).alias("s")), F.struct(F.lower("surname").alias("word"), F.lit(1).alias("s")))).alias("c")).select("c.word", "c.s")
    return cells.where("word is not null").groupBy("word").agg(F.count("*").alias("n"), F.avg("s").alias("balance")).where(F.col("n") >= least)


def swapped_columns(rows: DataFrame, balance: DataFrame) -> DataFrame:
    """``id``: rows whose name and surname stand in each other's column.

    A row is certain if its name is a surname by .9 and its surname a name by .9. In an
    act with two certain rows the others go with them, unless both their words are right.
    """
    of = lambda c, out: balance.select(F.col("word").alias(f"{c}_word"), F.col("balance").alias(out))
    seen = rows.select("id", "act", F.lower("name").alias("name_word"), F.lower("surname").alias("surname_word")).join(of("name", "nb"), "name_word", "left").join(of("surname", "sb"), "surname_word", "left")
    certain = F.coalesce((F.col("nb") >= 0.9) & (F.col("sb") <= 0.1), F.lit(False))
    straight = F.coalesce((F.col("nb") <= 0.1) & (F.col("sb") >= 0.9), F.lit(False))
    judged = seen.withColumn("certain", certain).withColumn("many", F.sum(certain.cast("int")).over(Window.partitionBy("act")))
    both = F.col("name_word").isNotNull() & F.col("surname_word").isNotNull()
    return judged.where(F.col("certain") | ((F.col("many") >= 2) & both & ~straight)).select("id")


def name_sexes(rows: DataFrame, least: int = 3, share: float = 0.85) -> DataFrame:
    """``part, sex, n``: what roles that tell a sex say of each name part; null where they disagree or say too little."""
    told = F.when(F.col("role").isin(*MALE_ROLES), "M").when(F.col("role").isin(*FEMALE_ROLES), "F")
    each = rows.select(told.alias("sex"), F.explode(name_parts(F.col("name"))).alias("part")).where("sex is not null")
    counted = each.groupBy("part").agg(F.count("*").alias("n"), F.count_if(F.col("sex") == "M").alias("men"))
    men = F.col("men") / F.col("n")
    return counted.select("part", F.when(F.col("n") >= least, F.when(men >= share, "M").when(1 - men >= share, "F")).alias("sex"), "n")


def sex_by_ending(part: Column) -> Column:
    """-a is a woman's name and -o or -i a man's, but for the exceptions."""
    return F.when(part.isin(*MALE_IN_A), "M").when(part.endswith("a"), "F").when(part.endswith("o") | part.endswith("i"), "M")


def sex_of_mentions(rows: DataFrame, sexes: DataFrame, least: int = 3) -> DataFrame:
    """``id, sex``: by role, else life state, else name (its first part first), else a woman's trade.

    A part that roles speak of enough is what they say, or undecided; one they are silent
    on goes by its ending. The first part, undecided, goes by its ending too.
    """
    parts = rows.select("id", F.posexplode(name_parts(F.col("name"))).alias("i", "part")).join(sexes, "part", "left")
    by_ending = sex_by_ending(F.col("part"))
    said = F.when(F.coalesce(F.col("n") >= least, F.lit(False)), F.coalesce(F.col("sex"), F.when(F.col("i") == 0, by_ending))).otherwise(by_ending)
    named = parts.withColumn("said", said).where("said is not null").groupBy("id").agg(F.min_by("said", "i").alias("named"))
    role = F.when(F.col("role").isin(*MALE_ROLES), "M").when(F.col("role").isin(*FEMALE_ROLES), "F")
    state = F.when(F.lower("status").isin(*FEMALE_STATES), "F").when(F.lower("status").isin(*MALE_STATES), "M")
    trade = F.when(F.lower("trade").isin("filatrice", "levatrice", "tessitrice", "lavandaia", "serva"), "F")
    return rows.join(named, "id", "left").select("id", F.coalesce(role, state, "named", trade).alias("sex"))


def act_families(rows: DataFrame) -> DataFrame:
    """``id, father, mother, spouse``: the relations of births and deaths, as ids of rows of the same act.

    The one newborn or deceased of an act has its one father and its one mother; two of a
    kind leave that parent open. Father and mother of one act are spouses, and so are the
    deceased and the one spouse the act names. Without a father's row the one declarant is
    the father of a newborn if he bears its canonical surname and no woman's name, and the
    mother is no widow.
    """
    one = lambda cond: F.when(F.count_if(cond) == 1, F.max(F.when(cond, F.col("id"))))
    role = lambda *r: F.col("role").isin(*r)
    house = canonical(F.col("surname"))
    man = F.coalesce(sex_by_ending(F.element_at(name_parts(F.col("name")), 1)) != "F", F.lit(True))
    heads = rows.where("type in ('birth', 'death')").withColumn("house", house).groupBy("act").agg(
        one(role("newborn", "deceased")).alias("subject"), one(role("father")).alias("father"), one(role("mother")).alias("mother"), one(role("spouse")).alias("partner"), one(role("declarant") & man).alias("declarant"),
        F.count_if(role("father")).alias("fathers"), F.max(F.when(role("newborn"), F.col("house"))).alias("house"), F.max(F.when(role("declarant"), F.col("house"))).alias("declared"),
        F.max(F.coalesce(role("mother") & F.lower("status").contains("vedova"), F.lit(False))).alias("widow"), F.max("type").alias("kind"),
    )
    stands_in = (F.col("fathers") == 0) & (F.col("kind") == "birth") & (F.col("house") == F.col("declared")) & ~F.col("widow")
    heads = heads.withColumn("father", F.coalesce("father", F.when(stands_in, F.col("declarant"))))
    none = F.lit(None).cast("long")
    subject = heads.where("subject is not null").select(F.col("subject").alias("id"), "father", "mother", F.when(F.col("kind") == "death", F.col("partner")).alias("spouse"))
    couple = heads.where("father is not null and mother is not null")
    sides = couple.select(F.col("father").alias("id"), none.alias("father"), none.alias("mother"), F.col("mother").alias("spouse")).unionByName(couple.select(F.col("mother").alias("id"), none.alias("father"), none.alias("mother"), F.col("father").alias("spouse")))
    partner = heads.where("kind = 'death' and partner is not null and subject is not null").select(F.col("partner").alias("id"), none.alias("father"), none.alias("mother"), F.col("subject").alias("spouse"))
    return subject.unionByName(sides).unionByName(partner)


#: The words of a note for kinship, and the roles they may point to.
KIN_WORDS = {"padre": "father_of", "madre": "mother_of", "figlio": "child_of", "figlia": "child_of", "moglie": "spouse_of", "marito": "spouse_of"}
REFERENTS = {"sposo": ("groom",), "sposa": ("bride",), "neonato": ("newborn",), "neonata": ("newborn",), "defunto": ("deceased",), "defunta": ("deceased",), "dichiarante": ("declarant",), "padre": ("father",), "madre": ("mother",)}


def kin_from_notes(rows: DataFrame) -> DataFrame:
    """``id, relation, other``: what notes such as "padre della sposa" declare, if the act has just one such person.

    "figlio del defunto Saverio" names a father of his own and points to nobody.
    """
    pattern = r"\b(?i:(" + "|".join(KIN_WORDS) + r")\s+(?:del|dello|della|dell')\s*(" + "|".join(REFERENTS) + r"))\b(?!\s+\p{Lu})"
    word, chi = F.lower(F.regexp_extract("note", pattern, 1)), F.lower(F.regexp_extract("note", pattern, 2))
    lookup = lambda d: F.create_map(*[F.lit(x) for pair in d.items() for x in pair])
    said = rows.select("id", "act", F.try_element_at(lookup(KIN_WORDS), word).alias("relation"), F.try_element_at(lookup({k: v[0] for k, v in REFERENTS.items()}), chi).alias("wanted")).where("relation is not null and wanted is not null")
    found = said.join(rows.select("act", F.col("role").alias("wanted"), F.col("id").alias("other")), ["act", "wanted"]).where("other <> id")
    single = found.groupBy("id", "relation", "wanted").agg(F.count("*").alias("n"), F.min("other").alias("other"))
    return single.where("n = 1").select("id", "relation", "other")


def birth_windows(rows: DataFrame, links: DataFrame, margin: int = 5) -> DataFrame:
    """``id, low, high, bearing``: when a parent can have been born, from the births of the children the acts give them.

    A father was 13 to 75 years older, a mother 13 to 55; an estimated year (from an age)
    widens that by ``margin``. The windows of all children are intersected. ``bearing`` is
    the least year of a child known from another act than its birth.
    """
    birth = F.when(F.col("role") == "newborn", F.col("year")).when(F.col("age").isNotNull(), F.col("year") - F.floor("age"))
    child = rows.select(F.col("id"), birth.alias("born"), (F.col("role") != "newborn").alias("estimated"), "type").where("born is not null")
    side = lambda who, oldest: links.select("id", F.col(who).alias("parent"), F.lit(oldest).alias("oldest")).where("parent is not null")
    told = side("father", 75).unionByName(side("mother", 55)).join(child, "id")
    slack = F.when(F.col("estimated"), margin).otherwise(0)
    windows = told.select("parent", (F.col("born") - F.col("oldest") - slack).alias("low"), (F.col("born") - 13 + slack).alias("high"), F.when(F.col("type") != "birth", F.col("born")).alias("bearing"))
    return windows.groupBy(F.col("parent").alias("id")).agg(F.max("low").alias("low"), F.min("high").alias("high"), F.min("bearing").alias("bearing"))


def role_bounds(rows: DataFrame) -> DataFrame:
    """``person, low, low_by, high, high_by``: the tightest bounds that roles put on a person's birth, and the role and year that say so.

    Who is wed, a parent or a witness was 13 (a witness 21) by then, and under 105. An
    "of age" bound sets the latest year only.
    """
    least = F.when(F.col("role") == "newborn", 0).when(F.col("role").isin("witness", "declarant"), 21).when(F.col("role") == "deceased", 0).otherwise(13)
    latest = F.when(F.coalesce("at_least", F.lit(False)), F.col("year") - 21).otherwise(F.col("year") - least)
    bounds = rows.select("person", latest.alias("high"), (F.col("year") - 105).alias("low"), F.concat_ws(" ", "role", "year").alias("by"), "role", "year")
    high, low = F.min(F.struct("high", "role", "year", "by")), F.max(F.struct("low", "role", "year", "by"))
    return bounds.groupBy("person").agg(high.alias("h"), low.alias("l")).select("person", F.col("l.low").alias("low"), F.col("l.by").alias("low_by"), F.col("h.high").alias("high"), F.col("h.by").alias("high_by"))


def read_twice(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``a, b``: two rows of a marriage that are one person: name and surname alike (.80), parents alike (.70) or unknown, ages at most 3 apart."""
    people = rows.where("type = 'marriage' and name is not null and surname is not null").select("id", "act", F.regexp_replace(normal(F.col("name")), " ", "").alias("n"), F.regexp_replace(normal(F.col("surname")), " ", "").alias("s"), "age")
    father = links.join(rows.select(F.col("id").alias("father"), F.regexp_replace(normal(F.col("name")), " ", "").alias("f")), "father").select("id", "f")
    people = people.join(father, "id", "left")
    pairs = people.alias("x").join(people.alias("y"), (F.col("x.act") == F.col("y.act")) & (F.col("x.id") < F.col("y.id")))
    near = F.coalesce(F.abs(F.col("x.age") - F.col("y.age")) <= 3, F.lit(True))
    cells = pairs.where(near).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), *[F.col(f"{t}.{c}").alias(f"{c}{t}") for t in "xy" for c in "nsf"])
    alike = key_similarity(similarity_udf("nx", "ny"), similarity_udf("sx", "sy")) >= 0.8
    return cells.where(alike & (F.coalesce(similarity_udf("fx", "fy"), F.lit(1.0)) >= 0.7)).select("a", "b")


def inferred_surnames(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``id, surname, origin``: surnames of rows that have none, with where they come from.

    A child takes its father's, else of an act's one declarant in a birth; a father takes
    his child's; a mother has none inferred, for she keeps her own house.
    """
    named = rows.where("surname is not null").select(F.col("id").alias("o"), F.col("surname").alias("found"))
    blank = rows.where("surname is null").select("id", "act", "role", "type")
    kids = blank.join(links.where("father is not null").select("id", F.col("father").alias("o")), "id").join(named, "o").select("id", "found", F.lit("father").alias("origin"), F.lit(0).alias("rank"))
    fathers = blank.join(links.where("father is not null").select(F.col("father").alias("id"), F.col("id").alias("o")), "id").join(named, "o").select("id", "found", F.lit("child").alias("origin"), F.lit(1).alias("rank"))
    one = rows.where("role = 'declarant' and type = 'birth' and surname is not null").groupBy("act").agg(F.count("*").alias("n"), F.min("surname").alias("found")).where("n = 1")
    declared = blank.where("role = 'newborn'").join(one, "act").select("id", "found", F.lit("declarant").alias("origin"), F.lit(2).alias("rank"))
    best = kids.unionByName(fathers).unionByName(declared).groupBy("id").agg(F.min(F.struct("rank", "found", "origin")).alias("b"))
    return best.select("id", F.col("b.found").alias("surname"), F.col("b.origin").alias("origin"))


def confirmed_houses(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``id, house``: surnames that a child and its father were both read with, in one canonical form."""
    read = rows.where("surname is not null").select("id", canonical(F.col("surname")).alias("house"))
    both = links.where("father is not null").select("id", "father").join(read, "id").join(read.select(F.col("id").alias("father"), F.col("house").alias("his")), "father")
    return both.where("house = his").select("id", "house")


def interpreted(rows: DataFrame, corrections: DataFrame) -> DataFrame:
    """The rows as they are to be understood, the readings beside them (``name_read``, ``surname_read``).

    In order: decided corrections (``id, field, value``; the value "?" takes an age away),
    alternatives in brackets, titles, what follows a name, a father in the surname cell (if
    the corpus of ``rows`` reads the word as a given name), and cells that name no person.
    """
    from kinweave.functions.text import alternatives, apposition, filiation, filiation_tail, untitled
    from kinweave.operators.facts import not_a_person

    fixed = corrections.groupBy("id").agg(*[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f"new_{f}") for f in ("name", "surname", "age")])
    out = rows.join(fixed, "id", "left").withColumns({"name_read": F.col("name"), "surname_read": F.col("surname")})
    out = out.withColumns({
        "name": F.coalesce("new_name", "name"), "surname": F.coalesce("new_surname", "surname"),
        "age": F.when(F.col("new_age") == "?", None).otherwise(F.coalesce(F.try_to_number("new_age", F.lit("999")).cast("double"), F.col("age").cast("double"))),
    })
    out = out.withColumn("s", alternatives(F.col("surname"))).withColumns({"surname": F.col("s.main"), "surname_others": F.col("s.others")})
    out = out.withColumn("t", untitled(F.col("name"))).withColumns({"name": F.col("t.name"), "title": F.col("t.title")})
    out = out.withColumn("p", apposition(F.col("name"))).withColumns({"name": F.col("p.name"), "status": F.coalesce("status", "p.status")})
    known = name_balance(rows).select(F.col("word").alias("tail"), F.col("balance").alias("tail_balance"))
    out = out.withColumn("tail", F.lower(filiation_tail(F.col("surname")))).join(known, "tail", "left")
    out = out.withColumn("f", filiation(F.col("surname"), F.col("tail_balance"))).withColumns({"surname": F.col("f.surname"), "patronymic": F.col("f.father")})
    nobody = not_a_person(F.col("name"))
    out = out.withColumns({"name": F.when(~nobody, F.col("name")), "nobody": nobody})
    return out.drop("s", "t", "p", "f", "tail", "tail_balance", "new_name", "new_surname", "new_age")


#: So many pages of a register are ordered in one task.
PAGES_A_SPAN = 1000


def neighbour_acts(acts: DataFrame) -> DataFrame:
    """``act, before, after``: the act before and after in its register, by page and place.

    A register is ordered by spans of pages, each by itself, with the last act of the span
    before and the first of the span after as its ends: a long register is not one task's.
    """
    placed = acts.select("act", "register", "page", F.floor(F.col("page") / PAGES_A_SPAN).alias("span"))
    at = F.struct("page", "act")
    spans = placed.groupBy("register", "span").agg(F.min(at).alias("first"), F.max(at).alias("last"))
    row = Window.partitionBy("register").orderBy("span")  # one row a span
    spans = spans.withColumns({"before": F.lag("last").over(row), "after": F.lead("first").over(row)})
    end = lambda side, place: spans.where(f"{side} is not null").select(F.col(f"{side}.act").alias("act"), "register", F.col(f"{side}.page").alias("page"), "span", F.lit(place).alias("place"))
    laid = placed.withColumn("place", F.lit(0)).unionByName(end("before", -1)).unionByName(end("after", 1))
    order = Window.partitionBy("register", "span").orderBy("place", "page", "act")
    return laid.select("act", "place", F.lag("act").over(order).alias("before"), F.lead("act").over(order).alias("after")).where("place = 0").drop("place")


def copied_from_neighbours(proposals: DataFrame, rows: DataFrame, acts: DataFrame, least: int = 2) -> DataFrame:
    """``act, copied``: acts for which at least ``least`` proposed values stand in the act before or after and not in their own.

    ``proposals``: ``act, value``. Such proposals were read off the wrong act.
    """
    held = rows.select("act", F.explode(F.array("name", "surname")).alias("value")).where("value is not null").distinct()
    near = neighbour_acts(acts)
    pairs = near.select("act", F.explode(F.array("before", "after")).alias("other")).where("other is not null")
    wanted = proposals.select("act", "value").distinct()
    elsewhere = wanted.join(pairs, "act").join(held.select(F.col("act").alias("other"), "value"), ["other", "value"]).select("act", "value").distinct()
    return elsewhere.join(held, ["act", "value"], "left_anti").groupBy("act").agg(F.count("*").alias("copied")).where(F.col("copied") >= least)


def attested_enough(proposals: DataFrame, forms: DataFrame, least: int = 3) -> DataFrame:
    """Proposals ``old, new`` that do not put a form nobody wrote in the place of one attested ``least`` times; ``forms``: ``form, n``."""
    n = lambda c, out: forms.select(F.col("form").alias(c), F.col("n").alias(out))
    judged = proposals.join(n("old", "old_n"), "old", "left").join(n("new", "new_n"), "new", "left")
    return judged.where("coalesce(new_n, 0) > 0 or coalesce(old_n, 0) < %d" % least).select(*proposals.columns)


def strength(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``id, strength``: how well a mention is placed: 0 with both parents, 1 with one, 2 with a spouse, 3 with an age, else 4."""
    joined = rows.select("id", "age").join(links.groupBy("id").agg(F.max("father").alias("father"), F.max("mother").alias("mother"), F.max("spouse").alias("spouse")), "id", "left")
    f, m = F.col("father").isNotNull(), F.col("mother").isNotNull()
    return joined.select("id", F.when(f & m, 0).when(f | m, 1).when(F.col("spouse").isNotNull(), 2).when(F.col("age").isNotNull(), 3).otherwise(4).alias("strength"))


def single_parent_columns(rows: DataFrame) -> DataFrame:
    """``act, father_name, mother_name`` for a table of acts: blank where an act has none or two of a kind."""
    full = F.trim(F.concat_ws(" ", "name", "surname"))
    one = lambda role: F.when(F.count_if(F.col("role") == role) == 1, F.max(F.when(F.col("role") == role, full)))
    return rows.groupBy("act").agg(one("father").alias("father_name"), one("mother").alias("mother_name"))

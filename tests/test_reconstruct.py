"""The whole linkage run on a small village whose people are known."""

import pytest
from pyspark.sql import functions as F

from kinweave.operators import interpret, linkage, reconstruct

MEN, WOMEN = ("giuseppe", "nicola", "carmine", "michele"), ("maria", "rosa", "lucia", "anna")
HOUSES = ("pellicia", "lela", "moreta")


def village():
    """Rows of acts, and who each row is: three couples with children who are born, some of whom die."""
    rows, who = [], {}

    def act(n, kind, year, *people):
        for i, (person, role, name, surname, age) in enumerate(people):
            at = n * 100 + i
            who[at] = person
            rows.append((at, n, i + 1, "r", kind, year, role, name, surname, age, "M" if role == "father" or name in MEN else "F", None if role == "newborn" else "sarto", "via Nuova", None))

    n = 0
    for h, house in enumerate(HOUSES):
        father, mother = ((f"{house} father", "father", MEN[h], house), (f"{house} mother", "mother", WOMEN[h], HOUSES[(h + 1) % 3]))
        for c in range(3):
            n += 1
            name = MEN[(h + c + 1) % 4] if c % 2 else WOMEN[(h + c + 1) % 4]
            year = 1820 + 3 * c + h
            act(n, "birth", year, (f"{house} {c}", "newborn", name, house, None), (*father, 30 + 3 * c), (*mother, 25 + 3 * c))
            if c < 2:
                n += 1
                act(n, "death", year + 2, (f"{house} {c}", "deceased", name, house, 2), (*father, 32 + 3 * c), (*mother, 27 + 3 * c))
    return rows, who


SCHEMA = "id long, act long, row int, register string, type string, year int, role string, name string, house string, age int, sex string, trade string, place string, status string"


@pytest.fixture(scope="module")
def linked(spark):
    rows, who = village()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("surname", F.col("house"))
    links = interpret.act_families(df)
    decisions = spark.createDataFrame([("separate", 101, 301), ("merge", 100, 200)], "action string, a long, b long")
    return df, links, who, reconstruct.people(df, links), reconstruct.begin(df, links, decisions.where("action = 'separate'").select("a", "b"))


def test_every_mention_once_under_its_smallest(linked):
    _, _, who, state, _ = linked
    held = {r.mention: r.entity for r in state.held.collect()}
    assert held.keys() == who.keys()
    groups = {}
    for m, e in held.items():
        groups.setdefault(e, set()).add(m)
    assert all(min(g) == e for e, g in groups.items())
    own = {r.entity: set(r.mentions) for r in state.own.collect()}
    assert own == groups


def test_people_are_found_and_no_two_are_one(linked):
    _, _, who, state, _ = linked
    held = {r.mention: r.entity for r in state.held.collect()}
    people = {}
    for m, e in held.items():
        people.setdefault(e, set()).add(who[m])
    assert all(len(p) == 1 for p in people.values())
    assert len(people) == len(set(who.values()))


def test_no_entity_holds_what_is_forbidden(linked):
    _, _, _, state, _ = linked
    inside = state.held.select("mention", "entity")
    pairs = linkage.meet(inside, ["entity"], "mention")
    assert linkage.sides(pairs, state.view(state.parts)).where(linkage.pair_veto(only=linkage.OWN_VETOES).isNotNull()).count() == 0
    assert reconstruct.contradicted(state.view(state.own)).count() == 0


def test_merged_parts_are_the_card_built_anew(linked):
    _, _, _, state, _ = linked
    of = state.held.select("mention", F.col("entity").alias("into"))
    anew = linkage.merged(state.parts.join(of, F.col("entity") == F.col("mention")).drop("mention"))
    columns = sorted(anew.columns)
    plain = lambda df: sorted(str(r) for r in df.select(*columns).collect())
    assert plain(anew) == plain(state.own)


def test_separations_are_vetoes_from_the_start(linked):
    *_, begun = linked
    pair = begun.parts.sparkSession.createDataFrame([(101, 301)], "a long, b long")
    assert linkage.sides(pair, begun.view(begun.parts)).select(linkage.pair_veto().alias("v")).first().v == "one act"

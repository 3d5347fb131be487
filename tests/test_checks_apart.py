"""The checks of a family are worked out one after the other: no plan holds them all, and no table that grows is sent through the driver."""

import datetime

import pytest
from pyspark.sql import functions as F

from kinweave.operators import family, people
from kinweave.operators.family import CHECKS, Family
from kinweave.session import gathered


@pytest.fixture(scope="module")
def village(spark):
    born = datetime.date(1820, 1, 1)
    rows = [(i, "M" if i % 2 else "F", 1800 + i % 40, 1790 + i * 7 % 120, "Nicola" if i % 3 else "Anna", "Bruno", born + datetime.timedelta(days=i * 30), i % 4 != 0) for i in range(60)] + [(None,) * 8]
    parents = [(i, i * 7 % 60, "father" if i * 7 % 2 else "mother") for i in range(60)] + [(i, i * 11 % 60, "mother") for i in range(0, 60, 2)] + [(3, None, "father")]
    unions = [(i, i % 60, i * 5 % 60, 1810 + i % 60, i % 3 == 0) for i in range(80)] + [(80, 1, None, None, None)]
    mentions = [(i % 60, i, 1800 + i * 3 % 90, "act", ("newborn", "deceased", "groom", "witness")[i % 4], "Anna", ("Bruno", "Marzo", "Quaglia", "Tedesco", "Zuccaro", "Pelliccia")[i // 60], 20 + i % 50, False, None) for i in range(360)]
    return Family(
        spark.createDataFrame(rows, "id long, sex string, birth int, death int, name string, surname string, born date, certain boolean"), spark.createDataFrame(parents, "child long, parent long, kind string"),
        spark.createDataFrame(unions, "id long, husband long, wife long, year int, documented boolean"),
        spark.createDataFrame(mentions, "person long, act long, year int, type string, role string, name string, surname string, age int, at_least boolean, status string"),
    )


def nodes(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scorecard_counts_each_check_apart(spark, village):
    some = {name: CHECKS[name] for name in ("two_mothers", "two_couples", "parent_too_old", "close_kin", "marrying_age", "many_spouses", "twin_couples", "age_against_birth")}
    got = family.scorecard(village, some)
    assert nodes(got).count("Scan") <= 3
    found = {r.check: r.found for r in got.collect()}
    assert found == {name: check(village).count() for name, (_, check, _) in some.items()}
    assert sum(n > 0 for n in found.values()) > 4


def test_questions_are_gathered_check_by_check(spark, village):
    got = people.question_queue(village)
    assert nodes(got).count("Scan") <= 12
    asked = {}
    for r in got.collect():
        asked.setdefault(r.check, set()).add(r.id)
    of = {i: {h, w} for i, h, w in village.unions.select("id", "husband", "wife").collect()}
    known = {r.id for r in village.people.collect() if r.id is not None}
    want = {}
    for name, (_, check, population) in CHECKS.items():
        ids = {r[0] for r in check(village).collect()}
        ids = {p for i in ids for p in of[i]} if population in people.OF_UNIONS else ids
        if ids & known:
            want[name] = ids & known
    assert asked == want


@pytest.mark.parametrize("name", sorted(set(CHECKS) - {"own_ancestor"}))
def test_no_check_broadcasts_a_table(village, name):
    assert "Broadcast" not in nodes(CHECKS[name][1](village.written()))


def test_gathered(spark):
    got = gathered((spark.range(n).select(F.lit(n).alias("n"), "id") for n in (2, 0, 3)), "test")
    assert sorted(map(tuple, got.collect())) == [(2, 0), (2, 1), (3, 0), (3, 1), (3, 2)]
    with pytest.raises(ValueError):
        gathered([], "test")

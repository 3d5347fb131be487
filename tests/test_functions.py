"""Scalar functions against values worked out by hand."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from kinweave.functions import text as T
from kinweave.functions import weights as W
from kinweave.functions.similarity import similarity


def values(spark, function, given):
    df = spark.createDataFrame([(i, g) for i, g in enumerate(given)], "i int, t string")
    return [r.v for r in df.orderBy("i").select(function(F.col("t")).alias("v")).collect()]


def test_canonical(spark):
    given = {"Di Nardo": "dnardo", "Dinardo": "dnardo", "De Nardo": "dnardo", "Pelliccia": "pelicia", "Lella": "lela", "Città": "cita", "Desiderio": "dsiderio", "Laudo": "ludo", "Lollo": "lo", "Della Penna": "dlapena", "d'Ettorre": "detore", "Dettorre": "dtore"}
    assert values(spark, T.canonical, list(given)) == list(given.values())


def test_doubtful(spark):
    got = values(spark, T.doubtful, ["Bracchi [?]", "[?]", "Rossi", "Rossi??", "Ro[ss]i", None, "(?) Bo"])
    assert [(r.value, r.uncertain) for r in got] == [("Bracchi", True), (None, True), ("Rossi", False), ("Rossi", True), ("Ro[ss]i", True), (None, False), ("Bo", True)]


def test_alternatives_and_names(spark):
    got = values(spark, T.alternatives, ["Sepualdo [Epaldo/Gesualdo]", "Bo [o Ba]", "Bo"])
    assert [(r.main, r.others) for r in got] == [("Sepualdo", ["Epaldo", "Gesualdo"]), ("Bo", ["Ba"]), ("Bo", [])]
    assert [tuple(r) for r in values(spark, T.patronymic, ["Giuseppe di Carmine", "Di Nardo"])] == [("Giuseppe", "Carmine"), ("Di Nardo", None)]
    assert [tuple(r) for r in values(spark, T.late, ["fu Margherita", "Fulvio"])] == [("Margherita", True), ("Fulvio", False)]
    assert values(spark, T.name_parts, ["Maria  di Teresa, la", "Giovanni detto Nanni", None]) == [["maria", "teresa", "la"], ["giovanni", "nanni"], None]


def test_age(spark):
    given = ["trentasei", "mesi nove", "trenta circa", "maggiore di eta'", "cinquanta sei", "anni 40", "giorni 73", "neonato", "", "boh", "ventuno", "cento", "ore due"]
    got = [(None if r.years is None else round(r.years, 3), r.approximate, r.at_least) for r in values(spark, W.age, given)]
    assert got == [(36, False, False), (0.75, False, False), (30, True, False), (21, True, True), (56, False, False), (40, False, False), (0.2, False, False), (0, True, False), (None, False, False), (None, False, False), (21, False, False), (100, False, False), (0, False, False)]
    words = W.number_words()
    assert sorted(set(words.values())) == list(range(110)) and words["ventotto"] == 28 and words["sessantuno"] == 61


def test_weights(spark):
    row = spark.range(1).select(
        F.round(W.age_gap(F.lit(0)), 2), F.round(W.age_gap(F.lit(6)), 2), F.round(W.age_gap(F.lit(12)), 2), W.confidence(F.lit(0.0)), W.state(F.lit(0.8)), F.round(W.rarity(F.lit(1), F.lit(1000), 0.8, 3.0), 3),
        W.birth_year(F.lit(1850), F.lit(36.9)), W.birth_year(F.lit(1850), F.lit(0.75), F.lit(3)),
    ).first()
    assert list(row) == [1.06, -0.14, -0.95, 0.5, "probable", 2.903, 1814, 1849]


@pytest.mark.parametrize("a,b,want", [("lella", "colella", 0.714), ("domenico", "domenica", 0.963), ("giyseppe", "giuseppe", 0.875), ("tommolilli", "femminilli", 0.67), ("iemminilli", "femminilli", 0.90), ("domenicoantonio", "domenicantonio", 0.933), ("angela", "angelamaria", 0.545), ("cicchillitti", "cicchillitto", 0.917), ("", "", 1.0)])
def test_similarity(a, b, want):
    assert abs(similarity(a, b) - want) < 0.005 and similarity(a, b) == similarity(b, a) and similarity(a, None) is None


def test_names_of_a_batch_are_those_of_each_pair():
    from kinweave.functions.similarity import _over_lists, _unlike, name_similarity, names_compatible

    lists = [None, [], ["maria"], ["maria", "rosa"], ["rosa", "maria"], ["mariarosa"], ["niaria"], ["gio", "batta"], ["giobatta"], ["maria", "rosa"]]
    pairs = [(x, y) for x in lists for y in lists]
    a, b = pd.Series([x for x, _ in pairs]), pd.Series([y for _, y in pairs])
    for function in (name_similarity, names_compatible):
        got = _over_lists(function)(a, b)
        for (x, y), z in zip(pairs, got):
            assert pd.isna(z) if x is None or y is None else z == function(x, y)

    def plain(forms, least):
        leaders = []
        for form in sorted(forms):
            if all(similarity(form, other) < least for other in leaders):
                leaders.append(form)
        return len(leaders)

    forms = [["rossi", "rosci", "bianchi", "verdi"], [], None, ["a", "a b", "cd"]]
    assert list(_unlike(pd.Series(forms), 0.72)) == [0 if x is None else plain(x, 0.72) for x in forms]

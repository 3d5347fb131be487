"""Names, ages, places, relations of one act, corrections, linkage and decisions, against values worked out by hand."""

import pytest
from pyspark.sql import functions as F

from kinweave.functions import text as T
from kinweave.functions import weights as W
from kinweave.functions.similarity import couple_grade, name_similarity, names_compatible, same_couple, similarity
from kinweave.operators import anomalies, corrections, decisions, facts, interpret, linkage, review
from kinweave.operators.graph import connected_components, cycle_nodes
from kinweave.operators.similarity_join import weighted_pairs
from kinweave.plans import registered
from kinweave.plans.village import mentions
from kinweave.sources import pages, sinks, tables

Q = {name: query for name, (query, _) in registered().items()}


def values(spark, function, given):
    df = spark.createDataFrame([(i, g) for i, g in enumerate(given)], "i int, t string")
    return [r.v for r in df.orderBy("i").select(function(F.col("t")).alias("v")).collect()]


def test_ages_of_the_registers(spark):
    given = ["cinquanta sei compiuti", "maggior eta'", "sessandue", "vent'uno", "pochi giorni", "minore", "anni venti e due", "mesi tre", "di anni ventitre'"]
    df = spark.createDataFrame(list(enumerate(given)), "i int, t string")
    got = [r.a for r in df.orderBy("i").select(W.age(F.col("t"), W.near_number(F.col("t"))).alias("a")).collect()]
    assert [(a.years, a.approximate, a.at_least) for a in got] == [(56, False, False), (21, True, True), (62, True, False), (21, False, False), (0, True, False), (None, False, False), (22, False, False), (0.25, False, False), (23, False, False)]


def test_numbers_and_dates(spark):
    row = spark.range(1).select(
        W.age_unit(F.lit("otto"), F.lit("morto di mesi otto")), W.age_unit(F.lit("anni otto"), F.lit("di mesi otto")), W.act_number(F.lit("Num. 12")), W.act_number(F.lit("ventitre")), W.page_number(F.lit("reg_3/pag_0012.jpg")),
        W.month_of(F.lit("1 maggio 1843")), W.month_of(F.lit("1843-11-02")), W.day_of(F.lit(1843), F.lit(None).cast("int"), F.lit(4)).cast("string"), W.months_between(F.to_date(F.lit("1843-11-02")), F.to_date(F.lit("1844-02-01"))),
        W.card_confidence(F.lit(False), F.lit(0.5)), W.card_confidence(F.lit(True), F.lit(1.0)), W.card_confidence(F.lit(False), F.lit(1.0)),
    ).first()
    assert list(row) == ["mesi otto", "anni otto", 12, 23, 12, 5, 11, "1843-07-01", 3, 0.75, 1.0, 0.55]


def test_texts(spark):
    assert values(spark, T.canonical, ["di o"]) == ["do"]
    assert [(r.main, r.others) for r in values(spark, T.alternatives, ["B[e]r[t]i", "Rossi / Russi"])] == [("Berti", ["Bri"]), ("Rossi", ["Russi"])]
    assert values(spark, T.note_alternatives, ["si legge (Tommolilli / Iemminilli)", "'Pope', 'Popa'", "forse Iorzo[?] / Iorio", "forse Bianchi", None]) == [["Tommolilli", "Iemminilli"], ["Pope", "Popa"], ["Iorzo", "Iorio"], [], []]
    assert [tuple(r) for r in values(spark, lambda c: T.filiation(c, F.lit(0.1)), ["Lella fu Michele", "Di Nardo"])] == [("Lella", "Michele"), ("Di Nardo", None)]
    assert [tuple(r) for r in values(spark, lambda c: T.filiation(c, F.lit(0.9)), ["Lella fu Michele"])] == [("Lella fu Michele", None)]
    assert [tuple(r) for r in values(spark, lambda c: T.filiation(c, F.lit(None).cast("double")), ["Lella fu Michele"])] == [("Lella fu Michele", None)]
    assert [tuple(r) for r in values(spark, T.untitled, ["Don Felice Calidonio", "Signor Colapietra", "Donato", None])] == [("Felice Calidonio", "Don"), ("Colapietra", "Signor"), ("Donato", None), (None, None)]
    assert [tuple(r) for r in values(spark, T.apposition, ["Felice sua moglie", "d'Ettorre defunta", "Lella vedova", "Maria"])] == [("Felice", None), ("d'Ettorre", "defunta"), ("Lella", "vedova"), ("Maria", None)]
    assert values(spark, T.place_core, ["strada a piedi la Lama di Nuorro", "strada della Rua di Nuovo", "rua di Nuovo", "Porta da Capo", "in Torrebruna, vico Lungo, n. 3", "casa"]) == ["lama nuorro", "rua nuovo", "rua nuovo", "porta", "vico lungo", None]
    town = [tuple(r) for r in values(spark, lambda c: T.town_and_rest(c, "Torrebruna"), ["Torrebruna, strada della Trascinella", "Torrebruna", "strada di Portamurella"])]
    assert town == [("Torrebruna", "strada della Trascinella"), ("Torrebruna", None), (None, "strada di Portamurella")]
    assert values(spark, lambda c: T.street(c, "Torrebruna"), ["Torrebruna, strada Nuova", "Napoli", "Torrebruna, Piano"]) == ["strada Nuova", None, "Piano"]
    assert values(spark, lambda c: T.corrected(c, {"Lela": "Lella", "Mosco": "Mosca"}, ["Lela Ricci"]), ["LELA e Mosco, Lelano", "di Lela Ricci"]) == ["Lella e Mosca, Lelano", "di Lela Ricci"]
    assert values(spark, lambda c: T.snippet(c, F.lit("sole"), 4), ["il sole splende alto", "luna"]) == ["il sole spl…", None]
    assert values(spark, lambda c: T.place_in_text(c, F.lit("b")), ["aabb", "x"]) == [0.5, None]
    assert values(spark, T.verdict_of, ["CONFLITTO_CON_IL_CONTESTO", "conforme", "Errore di trascrizione", "CONFLITTO_CON_LA_TRASCRITTORE", "CORRETTO_DAL_CONTESTO", None]) == ["CONFLITTO_CON_IL_CONTESTO", "CONFERMATO", "CONFLITTO_CON_LA_TRASCRIZIONE", "CONFLITTO_CON_LA_TRASCRIZIONE", "CORRETTO_DAL_CONTESTO", ""] and values(spark, lambda c: T.label_of(c, {"a": "A"}), ["a", "b"]) == ["A", "b"]
    assert values(spark, T.json_block, ["ecco ```json\n{\"a\": 1}\n``` fine", "x [1, 2] y", "niente"]) == ['{"a": 1}', "[1, 2]", None]
    assert spark.range(1).select(T.joined(F.lit("a"), F.lit(" "), F.lit("b"), F.lit("a"))).first()[0] == "a | b"


def test_names():
    assert name_similarity(["angela"], ["angela", "maria"]) == 1.0 and name_similarity(["maria", "teresa"], ["maria", "giuseppa"]) < 0.7 and name_similarity([], ["a"]) == 0.0
    assert name_similarity(["domenico", "antonio"], ["domenicantonio"]) > 0.9
    assert names_compatible(["giovanni"], ["giovanni", "dottor"]) and not names_compatible(["maria", "giovanna"], ["maria", "letizia"]) and names_compatible(["anna", "maria"], ["maria", "anna"])
    assert names_compatible(["giuseppe", "antonio"], ["giuseppantonio"]) and not names_compatible(["rosa"], ["carmine"])


def test_couples(spark):
    grade = lambda n, s, u: couple_grade(F.lit(n), F.lit(s).cast("double"), F.lit(u))
    row = spark.range(1).select(grade(0.9, 0.9, False), grade(0.9, 0.3, False), grade(0.2, 1.0, False), grade(0.2, 1.0, True), same_couple(F.lit(2), F.lit(0)), same_couple(F.lit(1), F.lit(0)), same_couple(F.lit(2), F.lit(-1))).first()
    assert list(row) == [2, 1, -1, 0, True, False, False]


@pytest.mark.parametrize("threshold", [0.4, 0.8])
def test_weighted_pairs_are_all_pairs(spark, threshold):
    words = ["m", "iii", "iiix", "cases", "eafef", "lella", "colella", "wina", "vina", "mimma", "nininia", "di", "a", "b", "rossi", "russi", "ninna", "mma", "franchella", "trinchella"]
    want = {(a, b) for a in words for b in words if a < b and similarity(a, b) >= threshold}
    got = {(r.a, r.b) for r in weighted_pairs(spark.createDataFrame([(w,) for w in words + [None, ""]], "form string"), threshold).collect()}
    assert got == want and (threshold > 0.5 or ("iii", "m") in got)


def test_cycles_and_long_chains(spark):
    edges = [(1, 2), (2, 1), (2, 3), (3, 4), (4, 5), (5, 4), (7, 7), (8, 9), (20, 21), (21, 22), (22, 20), (22, 23), (23, 24), (24, 22)]
    df = spark.createDataFrame(edges + [(None, 1)], "a long, b long")
    assert {r.node for r in cycle_nodes(df).collect()} == {1, 2, 4, 5, 7, 20, 21, 22, 23, 24}
    path = spark.range(200).selectExpr("id as a", "id + 1 as b")
    assert {r.component for r in connected_components(path).select("component").distinct().collect()} == {0}
    assert cycle_nodes(df.where("a = 8")).count() == 0


def test_signatures_of_many_acts(spark):
    rows = spark.range(61).selectExpr("id as act", "'r' as register", "'n' as type", "1840 as year", "explode(array('x', 'y')) as name").selectExpr("*", "name as role", "name as surname")
    assert facts.same_event(rows).count() == 61 * 60 // 2


ROWS = "id long, act int, row int, type string, role string, name string, surname string, year int, age int, status string, note string"


def act(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS)


def test_declarant_as_father_and_notes(spark):
    rows = act(
        spark,
        (1, 1, 1, "birth", "newborn", "Luca", "Lella", 1840, None, None, None), (2, 1, 2, "birth", "mother", "Anna", "Rossi", 1840, 20, None, None), (3, 1, 3, "birth", "declarant", "Carlo", "Lela", 1840, 30, None, "padre del neonato"),
        (4, 2, 1, "birth", "newborn", "Rosa", "Lella", 1841, None, None, None), (5, 2, 2, "birth", "mother", "Anna", "Rossi", 1841, 21, "vedova", None), (6, 2, 3, "birth", "declarant", "Carlo", "Lella", 1841, 31, None, "figlio del defunto Saverio"),
        (7, 3, 1, "death", "deceased", "Ugo", "Bo", 1850, 70, None, None), (8, 3, 2, "death", "father", "A", "Bo", 1850, None, None, None), (9, 3, 3, "death", "father", "B", "Bo", 1850, None, None, None), (10, 3, 4, "death", "spouse", "Eva", "Ca", 1850, None, None, None),
    )
    got = {(r.id, r.father, r.mother, r.spouse) for r in interpret.act_families(rows).collect()}
    assert got == {(1, 3, 2, None), (3, None, None, 2), (2, None, None, 3), (4, None, 5, None), (7, None, None, 10), (10, None, None, 7)}
    assert [tuple(r) for r in interpret.kin_from_notes(rows).collect()] == [(3, "father_of", 1)]


def test_rows_read_twice(spark):
    rows = act(
        spark, (1, 1, 1, "marriage", "groom", "Giuseppe", "Lella", 1840, 25, None, None), (2, 1, 2, "marriage", "witness", "Giyseppe", "Lela", 1840, 26, None, None), (3, 1, 3, "marriage", "witness", "Giuseppe", "Lella", 1840, 40, None, None), (4, 1, 4, "marriage", "bride", "Anna", "Lella", 1840, 25, None, None)
    )
    none = spark.createDataFrame([], "id long, father long, mother long, spouse long")
    assert [tuple(r) for r in interpret.read_twice(rows, none).collect()] == [(1, 2)]


def test_interpretation_of_cells(spark):
    rows = spark.createDataFrame([(1, "Don Luigi", "Lella [Lela]", 30, None), (2, "Anna sua moglie", "Lella fu Michele", 20, None), (3, "padre ignoto", None, None, None)] + [(10 + i, "Michele", "Bo", 20, None) for i in range(5)], "id long, name string, surname string, age int, status string")
    fixes = spark.createDataFrame([(1, "age", "?"), (2, "name", "Rosa vedova")], "id long, field string, value string")
    got = [(r.name, r.surname, r.age, r.status, r.title, r.patronymic, r.name_read) for r in interpret.interpreted(rows, fixes).where("id < 10").orderBy("id").collect()]
    assert got == [("Luigi", "Lella", None, None, "Don", None, "Don Luigi"), ("Rosa", "Lella", 20, "vedova", None, "Michele", "Anna sua moglie"), (None, None, None, None, None, None, "padre ignoto")]


def test_corrections(spark):
    forms = spark.createDataFrame([("Lella", 40), ("Lela", 2), ("Mosca", 12), ("Moscha", 1), ("Rossi", 9), ("Lelli", 3), ("Franchella", 5)], "form string, n long")
    read = spark.createDataFrame([(1, "Franchela", ["Franchella", "Rossi"]), (2, "Bo", ["Lella"])], "id int, form string, others array<string>")
    assert [tuple(r) for r in corrections.from_alternatives(read, forms).collect()] == [(1, "Franchela", "Franchella")]
    kids = spark.createDataFrame([(1, "Lela", "Lella"), (2, "Moscha", "Mosca"), (3, "Rossi", "Lella"), (4, "Lella", "Lella")], "child int, surname string, father_surname string")
    assert sorted((r.child, r.target, r.rule) for r in corrections.surname_from_father(kids, forms).collect()) == [(1, "Lella", "dominated"), (2, "Mosca", "dominated")]
    house = spark.createDataFrame([(1, 8, 9, "Lella"), (2, 8, 9, "Lella"), (3, 8, 9, "Bruno"), (4, 7, 6, "A"), (5, 7, 6, "B")], "child int, father int, mother int, surname string")
    assert [tuple(r) for r in corrections.surname_by_siblings(house).collect()] == [(3, "Bruno", "Lella")]
    heads = {r.form: r.head for r in corrections.vocabulary(spark.createDataFrame([("contadino", 400), ("contadina", 40), ("contadinaa", 4), ("sarto", 5)], "form string, n long")).collect()}
    assert heads == {"contadino": "contadino", "contadina": "contadino", "contadinaa": "contadino", "sarto": "sarto"}
    rows = spark.createDataFrame([(1, "Giyseppe Antonio", "father"), (2, "Giuseppe", "father"), (3, "Domenica", "mother")] + [(i, "Giuseppe", "father") for i in range(4, 20)] + [(i, "Domenico", "father") for i in range(20, 60)] + [(i, "Domenica", "mother") for i in range(60, 63)], "id int, name string, role string")
    sexes = interpret.name_sexes(rows)
    fixes = corrections.name_corrections(rows, sexes)
    assert {(r.form, r.target) for r in fixes.collect()} == {("giyseppe", "giuseppe")}
    assert {r.id: r.name for r in corrections.corrected_names(rows, fixes, sexes).collect() if r.id in (1, 3)} == {1: "giuseppe antonio", 3: "domenica"}
    applied = corrections.apply_corrections(spark.createDataFrame([("Lela",), ("Bo",)], "surname string"), spark.createDataFrame([("Lela", "Lella")], "form string, target string"), "surname")
    assert {(r.surname, r.surname_read) for r in applied.collect()} == {("Lella", "Lela"), ("Bo", "Bo")}
    assert [tuple(r)[:4] for r in review.rare_near_frequent(spark.createDataFrame([("lella", 40), ("lela", 2), ("lelli", 3)], "form string, n long")).collect()] == [("lela", 2, "lella", 40)]


def test_corrected_surnames_of_the_village(spark, sf):
    rows = {r.id: r for r in mentions(spark, sf).collect()}
    links = [(r.id, r.father) for r in interpret.act_families(mentions(spark, sf)).collect() if r.father]
    n = {}
    for r in rows.values():
        n[r.surname] = n.get(r.surname, 0) + 1
    differ = [(c, rows[c].surname, rows[f].surname) for c, f in links if rows[c].surname and rows[f].surname and rows[c].surname != rows[f].surname]
    pairs = {}
    for _, s, t in differ:
        pairs[s, t] = pairs.get((s, t), 0) + 1
    bare = lambda x: x.lower().replace(" ", "")
    want = {}
    for c, s, t in differ:
        k = similarity(bare(s), bare(t))
        rule = "dominated" if k >= 0.8 and n[t] >= 4 * n[s] else "recurrent" if k >= 0.7 and pairs[s, t] >= 2 and n[t] > n[s] else "rare" if k >= 0.6 and n[s] <= 2 and n[t] >= 3 else "vanishing" if n[s] <= 3 and n[t] >= 8 * n[s] else None
        if rule:
            want[c] = (t, rule)
    assert {r.child: (r.target, r.rule) for r in Q["surnames_corrected"](spark, sf).collect()} == want


def card(**over):
    base = {"sex": "M", "sex2": "M", "confirmed": None, "births": [], "deaths": [], "acts": [], "fathers": [], "mothers": [], "spouses": [], "children": [], "names": ["a"], "trades": [], "places": [], "low": None, "high": None, "birth": None, "death": None, "first": None, "last": None, "first_child": None, "last_child": None, "bound_low": None, "bound_high": None, "mentions": [], "apart": []}
    return {**base, **over}


KINDS = "sex string, sex2 string, confirmed string, births array<long>, deaths array<long>, acts array<long>, fathers array<long>, mothers array<long>, spouses array<long>, children array<long>, names array<string>, trades array<string>, places array<string>, low int, high int, birth int, death int, first int, last int, first_child int, last_child int, bound_low int, bound_high int, mentions array<long>, apart array<long>"


def cards_of(spark, *pairs):
    rows = [(2 * i + s, *card(**c).values()) for i, pair in enumerate(pairs) for s, c in enumerate(pair)]
    cards = spark.createDataFrame(rows, "entity long, " + KINDS)
    met = spark.createDataFrame([(2 * i, 2 * i + 1) for i in range(len(pairs))], "a long, b long")
    return linkage.sides(met, cards), cards


def test_vetoes(spark):
    cases = [
        ({"sex": "F", "sex2": "F"}, {}, "sex"), ({"confirmed": "x"}, {"confirmed": "y"}, "confirmed house"), ({"births": [1]}, {"births": [2]}, "two births"), ({"deaths": [1]}, {"deaths": [2]}, "two deaths"), ({"last": 1850}, {"death": 1840}, "alive after death"),
        ({"first": 1800}, {"birth": 1810}, "before birth"), ({"birth": 1800}, {"low": 1820}, "stated age"), ({"bound_low": 1830}, {"bound_high": 1820}, "birth window"), ({"birth": 1800}, {"first_child": 1810}, "child too early"),
        ({"first_child": 1800}, {"first_child": 1801, "last_child": 1870}, "bearing span"), ({"death": 1830}, {"last_child": 1833, "first_child": 1833}, "child after death"), ({"fathers": [1], "mothers": [2]}, {"fathers": [3], "mothers": [4]}, "both parents"), ({"mentions": [1, 2], "apart": [9]}, {"mentions": [9]}, "one act"), ({"acts": [1, 2]}, {"acts": [2]}, None),
    ]
    both, _ = cards_of(spark, *[(a, b) for a, b, _ in cases])
    assert [r.v for r in both.select("a", linkage.pair_veto().alias("v")).orderBy("a").collect()] == [v for _, _, v in cases]
    given = both.where("a = 26").select(linkage.pair_veto(F.lit(0.5), F.lit(True)).alias("p"), linkage.pair_veto(None, F.lit(True)).alias("s")).first()
    assert tuple(given) == ("patronymics", "separated")


def test_graph_evidence(spark):
    both, _ = cards_of(spark, ({"children": [1], "spouses": [5]}, {"children": [1, 2], "spouses": [5]}), ({"fathers": [1], "mothers": [2]}, {"fathers": [1], "mothers": [2]}), ({"fathers": [1], "mothers": [2]}, {"fathers": [3], "mothers": [4]}), ({"fathers": [1]}, {"fathers": [1]}), ({"trades": ["x"]}, {"trades": ["y"], "sex": "F"}))
    terms = {**linkage.graph_terms(), **linkage.attribute_terms()}
    got = [tuple(r)[1:] for r in both.select("a", *[v.alias(k) for k, v in terms.items()]).orderBy("a").collect()]
    assert got == [(2.8, 2.4, 0.0, 1.2, 0.0, 0.0, 0.0), (0.0, 0.0, 3.0, 0.0, 0.0, 0.0, 0.0), (0.0, 0.0, -1.6, 0.0, 0.0, 0.0, 0.0), (0.0, 0.0, 0.5, 0.0, 0.0, 0.0, 0.0), (0.0, 0.0, 0.0, 0.0, -0.12, 0.0, -1.5)]


def test_incoherence(spark):
    _, cards = cards_of(spark, ({"births": [1, 2], "death": 1800, "birth": 1810}, {}), ({"spouses": [2], "fathers": [1, 2]}, {"sex2": "F"}))
    assert {r.entity: r.reasons for r in linkage.incoherence(cards).collect()} == {0: ["two births", "dead before birth"], 2: ["two fathers", "own spouse", "own parent"], 3: ["two sexes"]}


def test_splits_merges_and_decisions(spark):
    members = spark.createDataFrame([(1, 10, 5), (1, 11, 6), (1, 12, None), (2, 20, 7), (2, 21, 8)], "entity int, mention int, spouse int")
    periods = spark.createDataFrame([(1, 5, 1800, 1820), (1, 6, 1810, 1815), (2, 7, 1800, 1820), (2, 8, 1810, 1830)], "entity int, spouse int, first int, last int")
    parts = linkage.split_by_spouses(members, periods, spark.createDataFrame([(7, 1805)], "spouse int, death int"))
    assert {r.mention: r.part for r in parts.collect()} == {10: 0, 11: 1, 12: 0, 20: 0, 21: 0}
    entities = spark.createDataFrame([(i, i) for i in range(1, 6)], "mention long, entity long")
    log = spark.createDataFrame([("merge", 1, 2), ("merge", 2, 3), ("separate", 1, 3)], "action string, a long, b long")
    assert {r.mention: r.entity for r in linkage.impose(entities, log).collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}
    linked = spark.createDataFrame([(1, 10, None, None), (2, 11, None, None), (3, 12, 20, None), (3, 13, 21, None)], "entity long, father long, mother long, spouse long")
    assert {tuple(r) for r in linkage.propagate_separation(spark.createDataFrame([(1, 2)], "a long, b long"), linked).collect()} == {(1, 2), (10, 11)}
    names = spark.createDataFrame([(12, "ugo"), (13, "ugo"), (20, "eva"), (21, "ada")], "entity long, name string")
    assert [tuple(r) for r in linkage.parents_of_one(linked, names).collect()] == [(12, 13)]
    _, cards = cards_of(spark, ({"births": [1]}, {"births": [2]}), ({}, {}))
    merges = linkage.merge_along(spark.createDataFrame([(0, 1), (2, 3)], "a long, b long"), cards, linkage.pair_veto())
    assert [tuple(r) for r in merges.collect()] == [(3, 2)]
    scored = spark.createDataFrame([(1, 2, 3.5), (3, 4, 2.0), (5, 6, 2.0), (5, 7, 1.8)], "a long, b long, score double")
    assert {(r.a, r.b) for r in linkage.fixed_merges(scored).collect()} == {(1, 2), (3, 4)}
    row = spark.range(1).select(linkage.fixed_score({"name": F.lit(True), "surname": F.lit(True), "spouse": F.lit(None).cast("boolean")}, {"parents": F.lit(True)})).first()
    assert row[0] == 1.5
    done, rounds = linkage.until_settled(spark.createDataFrame([(64,)], "n int"), lambda d: d.selectExpr("greatest(1, cast(n / 2 as int)) as n"), lambda a, b: a.first() == b.first())
    assert done.first().n == 1 and rounds == 7
    close = anomalies.homonyms(spark.createDataFrame([(1, 5, 2.0), (1, 6, 1.7), (2, 5, 2.0), (2, 7, 0.1)], "mention long, entity long, logit double"))
    assert [(r.id, r.other) for r in close.collect()] == [(1, 6)]


def test_decision_log(spark):
    log = spark.createDataFrame(
        [(1, "2024-01-01 00:00:00", "merge", 1, "f", "v", "algorithm", None), (2, "2024-01-02 00:00:00", "merge", 2, "f", "v", "algorithm", None), (3, "2024-01-03 00:00:00", "separate", 2, "f", None, "user", 1), (4, "2024-01-04 00:00:00", "merge", 9, "f", "w", "algorithm", None)],
        "id int, at string, action string, subject int, field string, value string, decider string, undoes int",
    ).withColumn("at", F.to_timestamp("at"))
    stay, gone = decisions.archived(log, keep=1)
    assert sorted(r.id for r in stay.collect()) == [1, 3, 4] and [r.id for r in gone.collect()] == [2]
    assert [(r.action, r.undoes) for r in decisions.undo(log, spark.createDataFrame([(2,), (1,)], "id int"), "user").collect()] == [("separate", 2)]
    json_log = spark.createDataFrame([(1, "[5, 7]"), (2, "[15, 25]"), (3, None)], "id int, entities string")
    assert [r.id for r in decisions.concerning(json_log, 5).collect()] == [1]
    assert decisions.naming(spark.createDataFrame([("Bo | LELA",), ("Lelano",)], "variants string"), "lela").count() == 1
    forms = spark.createDataFrame([("Lella", 9), ("Bo", 1)], "form string, n int")
    old = spark.createDataFrame([(1, 1, "Lella", "Zzz", "v2"), (2, 2, "Bo", "Lella", "v2"), (3, 3, "Bo", "Lella", "v1"), (4, 4, "Bo", "Lella", "v2")], "id int, act int, old string, new string, version string")
    assert {r.id: r.finding for r in decisions.recheck(old, forms, spark.createDataFrame([(2,)], "act int"), "v2").collect()} == {1: "unattested", 2: "copied", 3: "old version"}
    rows = spark.createDataFrame([(1, "a", "b", "a", False, 0.9), (2, "a", "b", "x", True, 0.1), (3, None, "b", None, False, None)], "id int, old string, new string, read_now string, confirmed boolean, similarity double")
    assert [r.id for r in decisions.for_review(rows).collect()] == [2, 1, 3]
    back, wait = decisions.retried(spark.createDataFrame([(1, "k"), (2, "z")], "subject int, key string"), spark.createDataFrame([(7, "k")], "id int, key string"), ["key"])
    assert [r.subject for r in back.collect()] == [7] and wait.count() == 1


def test_reviews_sinks_and_sources(spark, tmp_path):
    acts = spark.createDataFrame([(1, "alta", None), (2, "alta", "x"), (3, "bassa", None), (4, None, "")], "act int, reliability string, doubts string")
    assert [r.act for r in review.uncertain_acts(acts).collect()] == [3, 2]
    rows = spark.createDataFrame([(1, "a", 1840, 2.0), (2, "a", 1850, 3.0), (3, "b", 1850, 9.0)], "id int, kind string, year int, priority double")
    assert [r.id for r in review.queue(rows, kind="a", most=1).collect()] == [2] and review.queue(rows, first_year=1841, last_year=1860).count() == 2
    pages_ = spark.createDataFrame([("p", "i1", 1.0), ("p", "i2", 3.0), ("p", "i3", 2.0), ("q", "i1", 5.0)], "person string, image string, priority double")
    assert {(r.image, r.questions) for r in review.pages_to_read_again(pages_).collect()} == {("i1", 1), ("i2", 1), ("i3", 1)}
    years = spark.createDataFrame([("r", y) for y in (1809, 1813, 1814, 1816)], "register string, year int")
    assert [tuple(r) for r in review.missing_years(years, "register", "year").collect()] == [("r", "1810-1812, 1815")]
    docs = spark.createDataFrame([(1, "Maria Giuseppa Lella"), (2, "Maria Rossi"), (3, "Mariagiuseppa Lella")], "id int, text string")
    boosts = spark.createDataFrame([(1, 3, 2), (2, 1, 1), (3, 1, 0)], "id int, mentions int, links int")
    ranked, outside = review.search(review.word_index(docs, "id", "text"), boosts, "maria giusep", "id")
    assert [r.id for r in ranked.collect()] == [1] and outside.first().outside == 1
    assert "| 1 |" in sinks.markdown("T", {"a": spark.createDataFrame([(1,), (2,)], "x int")}, most=1) and "The first 1 of 2" in sinks.markdown("T", {"a": spark.createDataFrame([(1,), (2,)], "x int")}, most=1)
    sinks.rewrite_tables({"t": docs}, str(tmp_path))
    sinks.rewrite_tables({"t": docs.limit(1)}, str(tmp_path))
    tables.attach(spark, str(tmp_path), ["t"], "old_")
    assert spark.table("old_t").count() == 1
    assert {(r.form, r.target) for r in tables.glossary(spark, {"Lella": ["Lela", "Lelia"], "Bo": ["Boo", "Lela"]}).collect()} == {("Lella", "Lella"), ("Bo", "Bo"), ("Lela", "Bo"), ("Lelia", "Lella"), ("Boo", "Bo")}
    texts = spark.createDataFrame([("INDICE ALFABETICO dei nati",), ("L'anno 1840",), (None,)], "testo_integrale string")
    assert pages.real_acts(texts).count() == 2
    ctx = review.decision_context(spark.createDataFrame([(1,)], "id int"), spark.createDataFrame([(1, "child", 5)], "id int, relation string, other int"), spark.createDataFrame([("k", 1, "d")], "kind string, id int, detail string"), spark.createDataFrame([(1, 8, 0.9)], "id int, other int, similarity double")).first()
    assert ctx.kin[0].other == 5 and ctx.doubts[0].kind == "k" and ctx.similar[0].other == 8

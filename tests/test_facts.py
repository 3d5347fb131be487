import json

from pyspark.sql import functions as F

from kinweave.operators import facts, review
from kinweave.sources import manifests


def test_manifests(spark):
    doc = {"metadata": [{"label": "Titolo", "value": "1840-1842"}, {"label": "L", "value": ["a", "b"]}, {"label": "V", "value": [{"@value": "x"}]}], "sequences": [{"canvases": [{"@id": "c1", "label": "pag. 1", "images": [{"resource": {"@id": "i1", "format": "j"}}]}, {"@id": "c2", "label": "pag. 2"}]}]}
    df = spark.createDataFrame([(1, json.dumps(doc)), (2, "{"), (3, None)], "k int, j string")
    got = [(r.k, r.place, r.canvas, r.image) for r in manifests.parse_manifests(df, "j", "k").orderBy("place").collect()]
    assert got == [(1, 0, "c1", "i1"), (1, 1, "c2", None)]
    assert manifests.parse_manifests(df, "j", "k").first().fields == {"Titolo": "1840-1842", "L": "a b", "V": "x"}
    page = spark.createDataFrame([("var manifestId = 'u/m';",), ("<a href=\"v/manifest\">",), ("",)], "h string")
    assert [r[0] for r in page.select(manifests.manifest_url(F.col("h"))).collect()] == ["u/m", "v/manifest", None]
    titles = spark.createDataFrame([("Nati 1840-1842",), ("Nati 1850",), ("x",)], "t string")
    assert [r[0] and tuple(r[0]) for r in titles.select(manifests.years_covered(F.col("t"))).collect()] == [(1840, 1842), (1850, 1850), None]


def test_catalogue_and_gaps(spark):
    schema = "slug string, first int, last int, type string"
    kept = spark.createDataFrame([("a", 1840, 1842, "nati")], schema)
    out = spark.createDataFrame([("b", 1841, 1842, "nati"), ("c", 1842, 1843, "nati"), ("d", 1840, 1840, "morti")], schema)
    assert sorted(r.slug for r in manifests.fill_gaps(kept, out).collect()) == ["c", "d"]
    old, new = spark.createDataFrame([("u1", 1)], "ark_url string, n int"), spark.createDataFrame([("u1", 9), ("u2", 2), ("u2", 2)], "ark_url string, n int")
    assert sorted((r.ark_url, r.n) for r in manifests.merge_catalogue(old, new).collect()) == [("u1", 1), ("u2", 2)]


def test_facts_and_events(spark):
    rows = [(1, "Bo?", "fabbro", True), (2, None, " ", False)]
    got = sorted((r.m, r.field, r.value, r.confidence) for r in facts.facts(spark.createDataFrame(rows, "m int, nome string, mestiere string, incerto boolean"), "m", ["nome", "mestiere"], "incerto").collect())
    assert got == [(1, "mestiere", "fabbro", 0.7), (1, "nome", "Bo", 0.7)]
    names = spark.createDataFrame([("padre ignoto",), ("Rossi",), (None,), (" ",)], "n string")
    assert [r[0] for r in names.select(facts.not_a_person(F.col("n"))).collect()] == [True, False, True, True]
    acts = [(a, "r", "n", 1840, role, n, s) for a, people in {1: "xyz", 2: "xyw", 3: "xpq"}.items() for role, n, s in [(c, c, c) for c in people]]
    found = facts.same_event(spark.createDataFrame(acts, "act int, register string, type string, year int, role string, name string, surname string"))
    assert [(r.a, r.b, r.common) for r in found.collect()] == [(1, 2, 2)]


def test_split_and_conservation(spark):
    rows = [(1, 1800), (1, 1805), (1, 1900), (1, None), (2, None), (3, 1850)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "mention int, c int, born int")
    parts = facts.split_by_span(df, "c", "born", 60)
    assert {r.mention: r.part for r in parts.collect()} == {0: 0, 1: 0, 2: 1, 3: 0, 4: 0, 5: 0}
    assert tuple(facts.conserved(df, parts.select("mention")).first()) == (6, 6, 6, 0)
    assert facts.conserved(df, parts.where("mention > 0").select("mention")).first().lost == 1


def test_search_ways():
    assert review.search_terms("maria  di x") == [["maria", "di"], ["mariadi"], ["maridi"]]
    assert review.search_terms("a") == []

"""What is shuffled: keys once, edges of a component less in each round, words of a document counted first."""

import random

from kinweave.operators.graph import connected_components
from kinweave.operators.review import glossary_audit
from kinweave.operators.similarity_join import one_edit_pairs
from tests.test_pairs_stay import shuffled


def test_one_edit_keys_are_shuffled_once(spark):
    forms = [f"w{i:04d}x" for i in range(400)]
    df = spark.createDataFrame([(f,) for f in [*forms, None, ""]], "form string")
    got = []
    assert shuffled(spark, lambda: got.extend((r.a, r.b) for r in one_edit_pairs(df).collect())) < 400 * 7 + 4 * 400 + 2 * len(got) + 8000
    near = lambda a, b: sum(x != y for x, y in zip(a, b)) == 1
    assert sorted(got) == [(a, b) for a in forms for b in forms if a < b and near(a, b)]


def test_edges_of_components_grow_fewer(spark):
    mixed = random.Random(5)
    nodes = list(range(3000))
    mixed.shuffle(nodes)
    ring = list(zip(nodes[:2000], nodes[1:2000])) + [(nodes[i], nodes[i + 7]) for i in range(1990)] + [(n, n) for n in nodes[:5]]
    stars = [(nodes[2000 + i // 50 * 50], nodes[2000 + i]) for i in range(1000)]
    df = spark.createDataFrame([*ring, *stars, *stars, (None, 1), (1, None)], "a int, b int")
    got = {}
    assert shuffled(spark, lambda: got.update((r.node, r.component) for r in connected_components(df).collect())) < 120_000
    least = {}
    for group in [nodes[:2000], *[nodes[k : k + 50] for k in range(2000, 3000, 50)]]:
        least.update(dict.fromkeys(group, min(group)))
    assert got == least


def test_words_are_counted_before_they_are_shuffled(spark):
    rows = [(d, f"w{(d + i) % 40}") for d in range(30) for i in range(25) for _ in range(40)] + [(None, "w0")] * 3
    tokens = spark.createDataFrame(rows, "doc_id int, word string").coalesce(2)
    glossary = spark.createDataFrame([("w0", "w1"), ("w0", "w1"), ("w2", "w30"), ("w5", "nowhere"), ("w3", None), ("w39", "w0")], "form string, target string")
    got = []
    assert shuffled(spark, lambda: got.extend(tuple(r) for r in glossary_audit(tokens, glossary, 12).collect())) < len(rows) / 2
    n, docs = {}, {}
    for d, w in rows:
        n[w] = n.get(w, 0) + 1
        docs.setdefault(w, set()).update(() if d is None else (d,))
    want = []
    for f, t in {("w0", "w1"), ("w2", "w30"), ("w39", "w0")}:
        together = len(docs[f] & docs[t])
        if together >= 12 or n[f] > n[t]:
            want.append((f, t, together, n[f], n[t]))
    assert sorted(got) == sorted(want) and len(want) > 1

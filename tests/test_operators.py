"""Graphs, variants, contexts, decisions and resolution on small cases and against brute force."""

import datetime
import json
import random

from pyspark.sql import functions as F

from kinweave.operators import context, decisions, graph, resolve
from kinweave.operators.similarity_join import one_edit_pairs, weighted_pairs
from kinweave.operators.variants import variant_groups, variant_targets
from kinweave.functions.similarity import similarity
from kinweave.sources import pages
from kinweave.streaming import events as stream


def union_find(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in parent}


def test_components(spark):
    rng = random.Random(0)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(i, i + 1) for i in range(200, 240)] + [(500, k) for k in range(501, 540)]
    df = spark.createDataFrame(edges + [(None, 3), (7, None)], "a int, b int")
    want = {k: v for k, v in union_find([e for e in edges if e[0] != e[1]]).items()}
    assert {r.node: r.component for r in graph.connected_components(df).collect()} == want
    assert graph.connected_components(df.limit(0)).count() == 0


def test_cycles_hops_chains(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1), (3, 5), (6, 6), (7, 8), (8, 9)], "a int, b int")
    assert sorted(r.node for r in graph.cycle_nodes(df).collect()) == [1, 2, 3, 6]
    got = {(r.node, r.depth) for r in graph.hops(df, spark.createDataFrame([(7,), (4,)], "root int").where("root = 4"), 2).collect()}
    assert got == {(4, 0), (1, 1), (2, 2)}
    chains = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("y", "x"), ("w", "x")], "source string, target string")
    assert {r.source: r.target for r in graph.resolve_chains(chains).collect()} == {"a": "d", "b": "d", "c": "d", "x": "x", "y": "x", "w": "x"}


def test_similarity_joins(spark):
    rng = random.Random(1)
    forms = sorted({"".join(rng.choice("abcm") for _ in range(rng.randint(1, 6))) for _ in range(120)})
    df = spark.createDataFrame([(f,) for f in forms] + [(None,), ("",)], "form string")

    def levenshtein(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    assert {(r.a, r.b) for r in one_edit_pairs(df).collect()} == {(a, b) for a in forms for b in forms if a < b and levenshtein(a, b) == 1}
    found = {(r.a, r.b): r.similarity for r in weighted_pairs(df, 0.8).collect()}
    assert all(abs(similarity(*p) - s) < 1e-9 and s >= 0.8 for p, s in found.items())


def test_variants(spark):
    forms = spark.createDataFrame([("rossi", 40), ("rosi", 2), ("rassi", 3), ("dinardo", 9), ("denardo", 1), ("bianchi", 5)], "form string, n long")
    pairs = spark.createDataFrame([("rosi", "rossi", 0.8), ("rassi", "rossi", 0.8)], "a string, b string, similarity double")
    groups = {r.form: r.group for r in variant_groups(forms, pairs).collect()}
    assert groups == {"rossi": "rassi", "rosi": "rassi", "rassi": "rassi", "dinardo": "denardo", "denardo": "denardo", "bianchi": "bianchi"}
    got = {r.form: (r.target, r.accepted) for r in variant_targets(forms, pairs).collect()}
    assert got == {"rosi": ("rossi", True), "rassi": ("rossi", False)}


def test_record_context(spark):
    rows = [(1, i, r, "n", s) for i, (r, s) in enumerate([("newborn", "a"), ("father", "a"), ("mother", "b")])]
    rows += [(2, i, r, "n", "x") for i, r in enumerate(["newborn", "father", "father", "mother"])]
    df = spark.createDataFrame(rows, "act int, row int, role string, name string, surname string")
    assert [(r.act, r.father_row, r.mother_row) for r in context.single_subject(df).orderBy("act").collect()] == [(1, 1, 2), (2, None, 3)]
    married = [("groom", "Rossi"), ("bride", "Neri"), ("father", "Neri"), ("mother", "x"), ("father", "Bo"), ("mother", "y")]
    df = spark.createDataFrame([(1, i, r, "n", s) for i, (r, s) in enumerate(married)], "act int, row int, role string, name string, surname string")
    got = {r.row: r.spouse_row for r in context.marriage_parents(df).collect()}
    assert got[2] == 1 and got[3] == 1  # the surname beats the place, and the mother follows


def test_stitching(spark):
    rows = [("r", "m", 1, 0, "5", "a"), ("r", "m", 2, 0, None, "b"), ("r", "m", 2, 1, "6", "c"), ("r", "m", 9, 0, None, "d"), ("r", "m", 20, 0, "5", "e")]
    df = spark.createDataFrame(rows, "register string, type string, page int, place int, number string, text string")
    got = sorted((r.page, r.number, r.parts, r.text) for r in context.stitch(df).collect())
    assert got == [(1, "5", 2, "a\n\nb"), (2, "6", 1, "c"), (9, None, 1, "d"), (20, "5", 1, "e")]


def test_decisions(spark):
    at = lambda m: datetime.datetime(2024, 1, 1, 0, m)
    rows = [(1, at(0), "set", 7, "f", "x", "human", None), (2, at(1), "set", 7, "f", "y", "human", None), (3, at(30), "undo", 7, "f", None, "human", 2), (4, at(31), "set", 8, "f", "z", "algorithm", None)]
    log = spark.createDataFrame(rows, "id long, at timestamp, action string, subject long, field string, value string, decider string, undoes long")
    assert {(r.subject, r.value) for r in decisions.latest(log).collect()} == {(7, "x"), (8, "z")}
    assert sorted((r.decider, r.n) for r in decisions.runs(log).collect()) == [("algorithm", 1), ("human", 1), ("human", 2)]
    again = log.where("id >= 4").withColumn("id", F.lit(9).cast("long"))
    assert decisions.add_new(log, again).count() == 0 and decisions.add_new(log, log.where("decider = 'human'")).count() == 3
    old = spark.createDataFrame([(7, "k"), (8, "k"), (9, "m")], "id long, key string")
    new = spark.createDataFrame([(70, "k"), (90, "m")], "id long, key string")
    found, orphans = decisions.reattach(log, old, new, ["key"])
    assert {r.subject for r in found.collect()} == {70} and {r.id for r in orphans.collect()} == {4}


def test_resolution_keeps_every_mention(spark):
    mentions = spark.createDataFrame([(i, float(i // 3 * 10 + i % 3)) for i in range(30)], "mention long, at double")
    describe = lambda held: held.groupBy("entity").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))

    def score(e):
        a, b = e.select(F.col("entity").alias("a"), F.col("lo").alias("la"), F.col("hi").alias("ha")), e.select(F.col("entity").alias("b"), F.col("lo").alias("lb"), F.col("hi").alias("hb"))
        near = a.join(b, F.floor(F.col("la") / 10) == F.floor(F.col("lb") / 10)).where("a < b")
        return near.select("a", "b", (-F.abs(F.col("la") - F.col("lb"))).alias("logit"))

    entities, log = resolve.resolve(mentions, describe, score, threshold=-5)
    rows = entities.collect()
    assert sorted(r.mention for r in rows) == list(range(30)) and {r.entity for r in rows} == set(range(0, 30, 3)) and log.count() == 20


def test_pages(spark, tmp_path):
    page = {"tipo_pagina": "atti", "_origine": {"immagine": "a\\b.jpg", "registro": "r1", "anno": 1840}, "atti": [{"numero_atto": " 1 ", "data_atto": "3 maggio 1841", "persone": [{"ruolo": "padre", "nome": "Bo [?]", "cognome": ""}]}], "extra": 1}
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "p.json").write_text(json.dumps(page))
    (tmp_path / "x" / "_skip.json").write_text(json.dumps(page))
    (tmp_path / "x" / "bad.json").write_text("{")
    found = pages.read_pages(spark, str(tmp_path))
    acts = pages.acts(found)
    assert [(r.numero_atto, r.anno, r.immagine) for r in acts.collect()] == [("1", 1841, "a/b.jpg")]
    assert [(r.nome, r.cognome, r.incerto) for r in pages.people(acts).collect()] == [("Bo", None, True)]
    wanted = spark.createDataFrame([("r2",)], "registro string")
    assert pages.admitted(found, wanted).count() == 0 and pages.index_entries(found).count() == 0


def test_stream_first_seen(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.union(events).repartition(2).write.parquet(str(tmp_path / "events.parquet"))
    once = stream.first_seen(stream.event_stream(spark, str(tmp_path / "events.parquet")))
    assert stream.run_to_table(once, "append", "once").count() == events.count()

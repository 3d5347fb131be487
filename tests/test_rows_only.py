"""Queries that SQL cannot check, against plain Python on the smallest tables."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kinweave.functions.similarity import similarity
from kinweave.plans import registered
from kinweave.plans.families import _forms, family
from kinweave.plans.village import mentions

Q = {name: query for name, (query, _) in registered().items()}


def test_own_ancestors(spark, sf):
    above = defaultdict(set)
    for r in family(spark, sf).parents.collect():
        above[r.child].add(r.parent)

    def reached(start):
        seen, front = set(), [start]
        while front:
            for x in above.get(front.pop(), ()):
                if x not in seen:
                    seen.add(x)
                    front.append(x)
        return seen

    assert {r.id for r in Q["own_ancestors"](spark, sf).collect()} == {i for i in above if i in reached(i)}


def test_weighted_edit(spark, sf):
    surnames = {r.surname for r in mentions(spark, sf).select("surname").distinct().collect()} - {None}
    forms = sorted({s.lower().replace(" ", "") for s in surnames})
    want = {(a, b): round(similarity(a, b), 6) for a in forms for b in forms if a < b and similarity(a, b) >= 0.8}
    assert {(r.a, r.b): r.similarity for r in Q["weighted_edit"](spark, sf).collect()} == want


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    short, long_ = sorted((a, b), key=len)
    i = next((k for k in range(len(short)) if short[k] != long_[k]), len(short))
    return short[i + (len(short) == len(long_)) :] == long_[i + 1 :]


@pytest.fixture(scope="module")
def forms(spark, sf):
    return {r.form: r.n for r in _forms(spark, sf).collect()}


def near(forms):
    found = defaultdict(set)
    keys = defaultdict(set)
    for w in forms:
        for k in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            keys[k].add(w)
    for group in keys.values():
        for a in group:
            found[a] |= {b for b in group if one_edit(a, b)}
    return found


def test_variant_components(spark, sf, forms):
    from kinweave.functions.text import canonical

    canon = {r.form: r.c for r in spark.createDataFrame([(f,) for f in forms], "form string").select("form", canonical(F.col("form")).alias("c")).collect()}
    parent = {f: f for f in forms}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    first = {}
    edges = [(a, b) for a, bs in near(forms).items() for b in bs] + [(first.setdefault(canon[f], f), f) for f in sorted(forms)]
    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    assert {r.form: r.group for r in Q["variant_components"](spark, sf).collect()} == {f: root(f) for f in forms}


def test_variant_corrections(spark, sf, forms):
    """The best attested most similar neighbour, accepted by rule, chains followed to their end."""
    from kinweave.functions.text import canonical

    canon = {r.form: r.c for r in spark.createDataFrame([(f,) for f in forms], "form string").select("form", canonical(F.col("form")).alias("c")).collect()}
    target = {}
    for a, others in near(forms).items():
        seen = [(1 - 1 / max(len(a), len(b)), b) for b in others if (forms[b], a) > (forms[a], b)]
        if not seen:
            continue
        top = max(s for s, _ in seen)
        best = sorted(b for s, b in seen if s == top)
        share = forms[best[0]] / forms[a]
        if len(best) == 1 and (canon[a] == canon[best[0]] or (top >= 0.85 and share >= 4) or (top >= 0.92 and share >= 3)):
            target[a] = best[0]

    def end(x):
        while x in target:
            x = target[x]
        return x

    assert {r.source: r.target for r in Q["variant_corrections"](spark, sf).collect()} == {a: end(a) for a in target}


def test_resolved_customers_keep_their_bounds(spark, sf):
    rows = Q["resolved_customers"](spark, sf).collect()
    customers = {r.c_custkey: r for r in spark.read.parquet(f"{sf}/customer.parquet").collect()}
    assert sorted(r.mention for r in rows) == sorted(customers)
    groups = defaultdict(list)
    for r in rows:
        groups[r.entity].append(customers[r.mention])
    for entity, members in groups.items():
        balances = [m.c_acctbal for m in members]
        assert entity == min(m.c_custkey for m in members) and max(balances) - min(balances) <= 60
        assert len({(m.c_nationkey, m.c_mktsegment) for m in members}) == 1


def test_stitched_acts(spark, sf):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        turns[r.conv_id].append(r)
    want = Counter()
    for conv, rows in turns.items():
        last, parts = None, defaultdict(list)
        for r in sorted(rows, key=lambda r: (r.turn // 2, r.turn)):
            page = r.turn // 2
            if r.role != "assistant":
                last, key = (str(r.turn), page), str(r.turn)
            else:
                key = last[0] if last and page - last[1] <= 2 else f"?{r.turn}"
            parts[key].append((page, r.turn, r.text))
        for key, ps in parts.items():
            number = None if key.startswith("?") else key
            want[(conv, ps[0][0], number, len(ps), hashlib.md5("\n\n".join(p[2] for p in sorted(ps)).encode()).hexdigest())] += 1
    assert Counter((r.conv_id, r.page, r.number, r.parts, r.digest) for r in Q["stitched_acts"](spark, sf).collect()) == want


def test_spans_of_bearing(spark, sf):
    f = family(spark, sf)
    births = {r.id: r.birth for r in f.people.collect()}
    kids = defaultdict(list)
    for m, c in {(r.parent, r.child) for r in f.parents.where("kind = 'mother'").collect()}:
        if c in births:
            kids[m].append((births[c], c))
    want = {}
    for m, held in kids.items():
        out = []
        while max(held)[0] - min(held)[0] > 35:
            middle = sorted(b for b, _ in held)[len(held) // 2]
            worst = min(held, key=lambda x: (-abs(x[0] - middle), -x[0], x[1]))
            held.remove(worst)
            out.append(worst[0])
        if out:
            want[m] = (len(out), sum(out))
    assert {r.parent: (r.n, r.years) for r in Q["spans_of_bearing"](spark, sf).collect()} == want

"""Pairs of a crowded block are not shuffled: what is written for a shuffle grows with the rows, not with their pairs."""

from itertools import combinations

import pytest

from kinweave.operators.blocking import meet
from kinweave.operators.family import Family, twin_couples
from kinweave.plans import relations
from kinweave.plans.relations import QUERIES


def shuffled(spark, run):
    """Records that all stages of ``run`` write for shuffles."""
    gateway, store = spark.sparkContext._gateway, spark.sparkContext._jsc.sc().statusStore()

    def total():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = total()
    run()
    return total() - before


def test_meet_with_several_keys_and_facts(spark):
    keyed = [(i, k, i * 10) for i in range(60) for k in {f"x{i % 3}", f"y{i % 5}", f"z{i % 2}", None} | {f"x{i % 3}"}] + [(1, "x1", 10)]
    df = spark.createDataFrame(keyed, "id int, key string, fact int")
    got = sorted(tuple(r) for r in meet(df, ["key"], "id", facts=["fact"]).collect())
    held = {i: {k for j, k, _ in keyed if j == i and k} for i in range(60)}
    assert got == [(a, b, a * 10, b * 10) for a, b in combinations(range(60), 2) if held[a] & held[b]]


@pytest.mark.parametrize("name", ["blocking_pairs", "evidence_logit", "veto_reason"])
def test_scored_pairs_are_not_shuffled(spark, sf, tmp_path, name):
    rows = spark.range(1200).selectExpr("id as c_custkey", "cast(id % 25 as long) as c_nationkey", "'BUILDING' as c_mktsegment", "cast(5 + id % 7 as double) as c_acctbal")
    rows.write.parquet(str(tmp_path / "customer.parquet"))
    run = lambda: QUERIES[name][0](spark, str(tmp_path)).write.format("noop").mode("overwrite").save()
    assert shuffled(spark, run) < 1200 * 40


def test_twin_couples_of_common_names(spark):
    n = 700
    people = [(i, "M", 1800 + i % 2, 1850, "Nicola", "Bruno", None, True) for i in range(n)] + [(n + i, "F", 1800, 1850, "Anna", "Marzo" if i % 2 else "Marzi", None, True) for i in range(n)]
    people += [(2 * n + i, "M", 1830, None, "Carlo", "Bruno", None, True) for i in range(n)]
    parents = [(2 * n + i, i, "father") for i in range(n)] + [(2 * n + i, n + i, "mother") for i in range(n)]
    f = Family(
        spark.createDataFrame(people, "id int, sex string, birth int, death int, name string, surname string, born date, certain boolean"), spark.createDataFrame(parents, "child int, parent int, kind string"),
        None, spark.createDataFrame([(0, "Bruno")], "person int, surname string"),
    )
    got = []
    assert shuffled(spark, lambda: got.extend(r.id for r in twin_couples(f).collect())) < n * 150
    # Fathers of one year of birth; "marzo" and "marzi" are alike by .8.
    assert sorted(got) == sorted(a for a, b in combinations(range(n), 2) if a % 2 == b % 2)


def test_best_of_a_task_are_shuffled_only(spark, sf, tmp_path):
    n = 900
    rows = spark.range(n).selectExpr("id + 1 as c_custkey", "cast(1 as long) as c_nationkey", "'BUILDING' as c_mktsegment", "cast(50 + id % 20 as double) as c_acctbal")
    rows.write.parquet(str(tmp_path / "customer.parquet"))
    from kinweave.plans.families import resolved_customers

    got = []
    assert shuffled(spark, lambda: got.extend(resolved_customers(spark, str(tmp_path)).collect())) < n * 200
    assert sorted(r.mention for r in got) == list(range(1, n + 1))


@pytest.mark.parametrize("margin", [0.0, 1e-9])
def test_mutual_best_without_a_margin(spark, margin):
    from kinweave.operators.resolve import mutual_best

    logits = {(a, b): float((a * 7 + b * 5) % 4) for a, b in combinations(range(30), 2)}
    best = {m: min((-v, p) for p, v in logits.items() if m in p)[1] for m in range(30)}
    scored = spark.createDataFrame([(a, b, v) for (a, b), v in logits.items()], "a int, b int, logit double")
    got = {(r.a, r.b) for r in mutual_best(scored, 0.0, margin).collect()}
    want = {p for p in best.values() if best[p[0]] == best[p[1]]}
    if margin:
        alone = lambda m: sum(v == logits[best[m]] for p, v in logits.items() if m in p) == 1
        want = {p for p in want if alone(p[0]) and alone(p[1])}
    assert got == want


def test_best_of_a_crowded_block_without_its_pairs(spark, tmp_path):
    rows = spark.range(1800).selectExpr(
        "id as c_custkey", "case when id % 11 > 0 then cast(id % 3 as long) end as c_nationkey", "concat('S', id % 4) as c_mktsegment",
        "case id when 7 then null when 8 then double('nan') else round(cast(xxhash64(id) % case when id < 1000 then 5000 else 4500000 end as double) / 100, 2) end as c_acctbal",
    )
    rows.write.parquet(str(tmp_path / "customer.parquet"))
    got = []
    assert shuffled(spark, lambda: got.extend(tuple(r) for r in QUERIES["mutual_best"][0](spark, str(tmp_path)).collect())) < 1800 * 60
    scored = relations._scored(spark, str(tmp_path)).where("veto is null and logit > -2").collect()
    best = {}
    for r in scored:
        for me, you in ((r.a, r.b), (r.b, r.a)):
            best.setdefault(me, []).append((-r.logit, min(me, you), max(me, you), you))
    first = {me: sorted(found)[0][3] for me, found in best.items() if len(found) == 1 or sorted(found)[1][0] - sorted(found)[0][0] >= 0.05}
    want = sorted((r.a, r.b, r.logit) for r in scored if first.get(r.a) == r.b and first.get(r.b) == r.a)
    assert want and sorted(got) == want

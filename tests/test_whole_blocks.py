"""Blocks and bands leave no allowed pair out."""

from kinweave.plans import registered
from kinweave.plans.relations import PART_ROWS, _meet

Q = {name: query for name, (query, _) in registered().items()}


def write_customers(spark, tmp_path, rows):
    spark.createDataFrame(rows, "c_custkey long, c_nationkey int, c_mktsegment string, c_acctbal double").write.parquet(str(tmp_path / "customer.parquet"))
    return str(tmp_path)


def test_crowded_blocks_keep_every_pair(spark, tmp_path):
    # 150 customers in each of two nation blocks; balances 10 apart share a band over both.
    rows = [(i, i % 2, "BUILDING", float(i % 150)) for i in range(300)]
    sf = write_customers(spark, tmp_path, rows)
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and (a[1] == b[1] or a[3] // 10 == b[3] // 10)}
    got = [(r.a, r.b) for r in Q["blocking_pairs"](spark, sf).collect()]
    assert len(got) == len(want) and set(got) == want
    assert sum(r.n for r in Q["veto_reason"](spark, sf).collect()) == len(want)
    assert Q["evidence_logit"](spark, sf).count() > 0


def test_a_block_of_several_parts(spark):
    n = 2 * PART_ROWS + 50
    keyed = spark.range(n).selectExpr("id AS c_custkey", "'k' AS key").union(spark.range(3).selectExpr("id AS c_custkey", "'again' AS key"))
    assert _meet(keyed).count() == n * (n - 1) // 2


def test_every_gap_up_to_sixty_is_resolved(spark, tmp_path):
    pairs = [(base, gap) for base in (-75, 0, 30, 49, 59) for gap in range(0, 71, 4)]
    rows = [(2 * i + side, i, "BUILDING", float(base + side * gap)) for i, (base, gap) in enumerate(pairs) for side in (0, 1)]
    entities = {r.mention: r.entity for r in Q["resolved_customers"](spark, write_customers(spark, tmp_path, rows)).collect()}
    assert entities == {2 * i + side: 2 * i + (side if gap > 60 else 0) for i, (_, gap) in enumerate(pairs) for side in (0, 1)}

"""Pairs that are only counted are not spelled out, and long groups are not one task's."""

from pyspark.sql import functions as F

from kinweave.operators import corrections, interpret, linkage


def most_rows(spark, run):
    """The most records that any stage of ``run`` reads or writes in a shuffle."""
    gateway, store = spark.sparkContext._gateway, spark.sparkContext._jsc.sc().statusStore()

    def stages():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        found = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        return {found.apply(i).stageId(): max(found.apply(i).shuffleWriteRecords(), found.apply(i).shuffleReadRecords()) for i in range(found.size())}

    before = stages()
    run()
    return max(n for i, n in stages().items() if i not in before)


def test_same_person_elsewhere_counts_mentions_alike_at_once(spark):
    n = 3000
    rows = spark.range(n).select(F.lit("Maria").alias("name"), F.when(F.col("id") % 2 == 0, "Bruno").otherwise("Bruna").alias("surname"), (1850 + F.col("id") % 3).cast("int").alias("year"), F.when(F.col("id") > 0, 30).alias("age"))
    glossary = spark.createDataFrame([("Bruna", "Bruno"), ("Bruno", "Verdi")], "form string, target string")
    got = []
    assert most_rows(spark, lambda: got.extend(tuple(r) for r in corrections.same_person_elsewhere(rows, glossary).collect())) < n
    assert got == [("Bruna", "Bruno", 1500 * 1499)]


def test_neighbours_across_the_spans_of_a_register(spark, monkeypatch):
    monkeypatch.setattr(interpret, "PAGES_A_SPAN", 10)
    acts = [(a, r, None if a % 97 == 0 else (a * 7) % 500) for a in range(400) for r in [None if a % 4 == 0 else f"r{a % 2}"]]
    got = {r.act: (r.before, r.after) for r in interpret.neighbour_acts(spark.createDataFrame(acts, "act long, register string, page long")).collect()}
    want = {}
    for register in {r for _, r, _ in acts}:
        line = [a for _, a in sorted((-1 if p is None else p, a) for a, r, p in acts if r == register)]
        want |= {a: (line[i - 1] if i else None, line[i + 1] if i + 1 < len(line) else None) for i, a in enumerate(line)}
    assert got == want


def test_a_register_is_not_one_task_s(spark):
    acts = spark.range(20000).select(F.col("id").alias("act"), F.lit("r").alias("register"), F.col("id").alias("page"))
    parts = interpret.neighbour_acts(acts).select(F.spark_partition_id().alias("p")).groupBy("p").count().agg(F.count("*"), F.max("count"))
    assert parts.first()[1] < 20000


def test_cards_gather_only_what_is_asked(spark):
    rows = spark.createDataFrame([(1, 10, "newborn", "Anna", "Bruno", 1850, None), (2, 10, "father", "Luca", "Bruno", 1850, 30), (3, 11, "deceased", "Anna", "Bruno", 1870, 20)], "id long, act long, role string, name string, surname string, year int, age int")
    rows = rows.selectExpr("*", "lower(surname) as house", "'F' as sex", "cast(null as string) as status", "cast(null as string) as trade", "'via' as place")
    links = spark.createDataFrame([(1, 2, None, None)], "id long, father long, mother long, spouse long")
    linked = linkage.refresh(rows, links, spark.createDataFrame([(1, 1), (2, 2), (3, 1)], "mention long, entity long"))
    kin = ["fathers", "mothers", "spouses", "children", "spouse_names", "first_child", "last_child"]
    whole, some = linkage.cards(rows, linked, links), linkage.cards(rows, linked, links, {"size", "births"})
    assert some.columns == ["entity", "births", "size", *kin]
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, whole.select(some.columns).collect()))
    assert "trades" not in some._jdf.queryExecution().optimizedPlan().toString()

"""What a proposed reading may not be, and the cases an arbiter is asked."""

from kinweave.functions.text import is_reading, looks_elsewhere, name_shaped
from kinweave.functions.weights import act_number
from kinweave.operators.review import arbiter_cases, judged_sets
from pyspark.sql import functions as F


def test_readings(spark):
    values = {"nulla": (False, True), "non presente (e' il neonato)": (False, False), "--": (False, True), "": (False, False), None: (False, False), "Rosa": (True, True), "Donna Federica Zara": (True, False), "Maria [?]": (True, False), "Di Luca Maria Rosa": (True, False), "padre ignoto": (True, False), "n.d.": (False, True)}
    rows = spark.createDataFrame([(v,) for v in values], "v string").select("v", is_reading(F.col("v")).alias("r"), name_shaped(F.col("v")).alias("n")).collect()
    assert {r.v: (r.r, r.n) for r in rows} == values


def test_elsewhere(spark):
    cases = [("fine dell'atto precedente", "1", True), ("contiene la parte finale dell'atto n. 1", "1", False), ("nell'atto n. 7", "8", True), ("l'atto numero sette", "7", False), ("atto sette", None, False), ("nell'atto si legge", "7", False), (None, "1", False), ("", "1", False)]
    got = spark.createDataFrame(cases, "t string, a string, want boolean").select("want", looks_elsewhere(F.col("t"), F.col("a"), act_number).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_arbiter(spark):
    log = [("[1, 2]", "anna"), ("[2, 1, 2]", "ugo"), ("[3, 4, 5]", "anna"), ("[6, 7]", "algorithm"), ("[]", "anna"), ("broken", "anna"), (None, "anna"), ("[9]", None)]
    judged = judged_sets(spark.createDataFrame(log, "entities string, decider string"))
    assert sorted(tuple(r.people) for r in judged.collect()) == [(1, 2), (3, 4, 5)]
    K = "DUPLICATE_PERSON"
    cases = [(1, K, [2, 1], 1.0), (2, K, [1, None, 2, 2], 9.0), (3, K, [3, 5], 2.0), (4, K, [1, 3], 3.0), (5, K, [6, 7], 3.0), (6, K, [], 1.0), (7, K, None, 1.0), (8, "DATE_ANOMALY", [8], 9.0), (9, "IDENTITY_ANOMALY", [4], 5.0), (10, None, [8], 5.0)]
    frame = spark.createDataFrame([(*c, "x") for c in cases], "id int, kind string, people array<bigint>, priority double, note string")
    assert [r.id for r in arbiter_cases(frame, judged).collect()] == [9, 4, 5, 3, 6, 7]
    assert [r.id for r in arbiter_cases(frame, judged, inside=True).collect()] == [4, 5, 6, 7]
    assert [r.id for r in arbiter_cases(frame, judged, kind="DATE_ANOMALY").collect()] == [8]
    assert [r.id for r in arbiter_cases(frame, judged, most=1).collect()] == [9]
    assert arbiter_cases(frame.limit(0), judged, inside=True).collect() == []

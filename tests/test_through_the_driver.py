"""Tables of words are shuffled, not sent whole through the driver, however small the planner takes them for."""

import pytest

from kinweave.operators.similarity_join import one_edit_pairs
from kinweave.plans import registered


def broadcasts(spark, run):
    """How many tables all executions that ``run`` begins broadcast."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    nodes = [store.planGraph(store.executionsList().apply(i).executionId()).allNodes() for i in range(before, store.executionsCount())]
    assert nodes
    return sum(n.apply(i).name() == "BroadcastExchange" for n in nodes for i in range(n.size()))


@pytest.mark.parametrize("name", ["glossary_audit", "variant_corrections", "variant_dominance", "variant_components"])
def test_no_table_of_words_is_broadcast(spark, sf, name):
    query = registered()[name][0]
    assert broadcasts(spark, lambda: query(spark, sf).write.format("noop").mode("overwrite").save()) == 0


def test_one_edit_pairs_of_long_forms(spark):
    long_ = "ab" * 3000
    forms = spark.createDataFrame([(long_,), (long_[:-1],), (long_[:-1] + "c",), ("a",), ("b",), ("é",)], "form string")
    got = {(r.a, r.b, r.distance) for r in one_edit_pairs(forms).collect()}
    assert got == {(long_[:-1], long_, 1), (long_[:-1], long_[:-1] + "c", 1), (long_, long_[:-1] + "c", 1), ("a", "b", 1), ("a", "é", 1), ("b", "é", 1)}

"""Walks of any depth, trees around people, children in order."""

import pytest

from kinweave.operators.trees import children_in_order, family_tree, walk


def rows(df):
    return {(r.root, r.node): (r.depth, list(r.path)) for r in df.collect()}


def test_walk(spark):
    chain = [(i, i + 1) for i in range(1, 12)] + [(12, 1), (1, 2), (5, 5), (None, 3), (3, None), (1, 3)]
    edges = spark.createDataFrame(chain, "a int, b int")
    roots = spark.createDataFrame([(1,), (1,), (99,), (None,)], "root int")
    got = rows(walk(edges, roots))
    assert got[1, 12] == (10, [1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12]) and got[1, 1] == (0, [1]) and got[99, 99] == (0, [99]) and len(got) == 13
    assert set(rows(walk(edges, roots, 1))) == {(1, 1), (1, 2), (1, 3), (99, 99)}
    assert rows(walk(edges.limit(0), roots, 3)) == {(1, 1): (0, [1]), (99, 99): (0, [99])}
    with pytest.raises(ValueError):
        walk(edges, roots, -1)


def test_least_of_the_shortest_paths(spark):
    edges = spark.createDataFrame([(1, 3), (1, 2), (3, 4), (2, 4), (4, 5)], "a int, b int")
    assert rows(walk(edges, spark.createDataFrame([(1,)], "root int")))[1, 5] == (3, [1, 2, 4, 5])


def test_tree(spark):
    # 1 and 2 have 3; 3 and 4 have 5; 5 and 6 are wed, and 6 has parents of her own; 7 is 5's child by 8; 1 wed 9.
    parents = spark.createDataFrame([(3, 1), (3, 2), (5, 3), (5, 4), (6, 10), (7, 5), (7, 8), (8, 11), (None, 1), (5, 5)], "child int, parent int")
    unions = spark.createDataFrame([(5, 6), (1, 9), (1, None), (9, 1), (4, 4)], "husband int, wife int")
    got = {r.node: (r.generation, r.relation, list(r.path)) for r in family_tree(parents, unions, spark.createDataFrame([(3,)], "root int"), 2, 2).collect()}
    assert got == {
        3: (0, "root", [3]), 1: (-1, "ancestor", [3, 1]), 2: (-1, "ancestor", [3, 2]), 5: (1, "descendant", [3, 5]), 7: (2, "descendant", [3, 5, 7]),
        4: (0, "co-parent", [3, 5, 4]), 8: (1, "co-parent", [3, 5, 7, 8]), 6: (1, "spouse", [3, 5, 6]), 9: (-1, "spouse", [3, 1, 9]),
    }


def test_branches_that_close(spark):
    # 4 is the root's grandchild and, by a mistake, the root's parent too: the nearer level counts.
    parents = spark.createDataFrame([(2, 1), (4, 2), (1, 4)], "child int, parent int")
    got = {r.node: (r.generation, r.relation) for r in family_tree(parents, spark.createDataFrame([], "husband int, wife int"), spark.createDataFrame([(1,)], "root int"), None, None).collect()}
    assert got == {1: (0, "root"), 4: (-1, "ancestor"), 2: (1, "descendant")}


def test_children(spark):
    parents = spark.createDataFrame([(3, 1), (3, 2), (4, 1), (4, 9), (5, 1), (5, 1), (6, 1), (None, 1)], "child int, parent int")
    people = spark.createDataFrame([(3, 1850, 1840), (4, None, 1845), (5, None, None)], "id int, birth int, first int")
    got = sorted((r.parent, r.place, r.child, r.other) for r in children_in_order(parents, people).collect())
    assert got == [(1, 1, 4, 9), (1, 2, 3, 2), (1, 3, 5, None), (1, 4, 6, None), (2, 1, 3, 1), (9, 1, 4, 1)]

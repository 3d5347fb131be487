"""Graph operators over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.session import materialise


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of an undirected edge table.

    The component is its smallest node. In a round every node hangs on the smallest of
    itself and its neighbours, chains of these are followed to their end (the logarithm of
    their length), and the edges are rewritten between the ends: each end has taken in a
    neighbour at least, so the nodes left are half as many or fewer, and the next round
    is that much smaller. Null ends and loops are left out; repeated edges do no harm; an
    empty table gives an empty table. Nodes and edges are shuffled in every round, never
    sent whole through the driver.
    """
    left = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b")
    left = materialise(left.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    labels = None
    while True:
        ends = left.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(left.select(F.col("b").alias("node"), F.col("a").alias("near")))
        hung = _ends_of_chains(ends.groupBy("node").agg(F.min("near").alias("m")).select("node", F.least("node", "m").alias("end")))
        if labels is None:
            labels = hung.select("node", F.col("end").alias("component"))
        else:
            moved = hung.select(F.col("node").alias("component"), "end")
            labels = materialise(labels.hint("merge").join(moved, "component", "left").select("node", F.coalesce("end", "component").alias("component")), "cc-labels")
        of = lambda side: hung.select(F.col("node").alias(side), F.col("end").alias(f"e{side}"))
        onward = left.hint("merge").join(of("a"), "a").hint("merge").join(of("b"), "b").where("ea <> eb")
        left = materialise(onward.select(F.least("ea", "eb").alias("a"), F.greatest("ea", "eb").alias("b")).distinct(), "cc-edges")
        if left.isEmpty():
            return labels


def _ends_of_chains(chains: DataFrame) -> DataFrame:
    """``node, end`` of chains ``node, end`` that lead each node to a smaller one, or to itself at the end: followed to the end by pointer jumping."""
    now = materialise(chains.select("node", "end"), "cc-hung")
    while True:
        after = now.select(F.col("node").alias("end"), F.col("end").alias("then"))
        fresh = materialise(now.hint("merge").join(after, "end").select("node", F.col("then").alias("end"), (F.col("then") != F.col("end")).alias("moved")), "cc-hung")
        now = fresh.select("node", "end")
        if not fresh.where("moved").limit(1).count():
            return now


def _peel(left: DataFrame) -> DataFrame:
    """Edges whose ends both have an edge in and an edge out, after taking away all others until none is; written down each round."""
    size = left.count()
    while True:
        outs, ins = left.select("a").distinct(), left.select(F.col("b").alias("a")).distinct()
        both = outs.hint("merge").join(ins, "a", "left_semi")
        left = materialise(left.hint("merge").join(both, "a", "left_semi").hint("merge").join(both.withColumnRenamed("a", "b"), "b", "left_semi").select("a", "b"), "peel")
        now = left.count()
        if now == size:
            return left
        size = now


def _spread(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``node, c``: the largest label among a node's own and those that edges ``a`` to ``b`` carry to it, until nothing changes.

    Labels go three edges on before they are written down.
    """
    while True:
        now = labels.select("node", "c", F.col("c").alias("was"))
        for _ in range(3):
            came = edges.hint("merge").join(now.select(F.col("node").alias("a"), "c"), "a").groupBy(F.col("b").alias("node")).agg(F.max("c").alias("m"))
            now = now.hint("merge").join(came, "node", "left").select("node", F.greatest("c", F.coalesce("m", "c")).alias("c"), "was")
        fresh = materialise(now, "spread")
        changed = fresh.where("c <> was").limit(1).count()
        labels = fresh.select("node", "c")
        if not changed:
            return labels


def cycle_nodes(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``: the nodes from which edges lead back to themselves. Loops count; nodes between two cycles do not.

    What cannot be on a cycle is peeled away. Then each node takes the largest node that
    reaches it as its colour; going back from a colour's own node along edges of one
    colour finds what it can reach and what reaches it. Those are taken out, and the rest
    is peeled and coloured again. Rounds grow with the length of paths, not with the table.
    Nodes and edges are shuffled in every round, never sent whole through the driver.
    """
    left = materialise(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null").distinct(), "peel")
    found = left.where("a = b").select(F.col("a").alias("node"))
    left = left.where("a <> b")
    while True:
        left = _peel(materialise(left, "peel"))
        if left.isEmpty():
            return materialise(found.distinct(), "cycle-nodes")
        nodes = left.select(F.col("a").alias("node")).distinct()
        colour = _spread(nodes.withColumn("c", F.col("node")), left)
        of = lambda end: colour.select(F.col("node").alias(end), F.col("c").alias(f"c{end}"))
        inside = materialise(left.hint("merge").join(of("a"), "a").hint("merge").join(of("b"), "b").where("ca = cb").select(F.col("b").alias("a"), F.col("a").alias("b"), "ca"), "cycle-inside")
        # Back from each colour's own node: 1 is reached, 0 is not.
        back = _spread(colour.select("node", F.when(F.col("node") == F.col("c"), 1).otherwise(0).alias("c")), inside)
        strong = materialise(back.where("c = 1").select("node").hint("merge").join(colour, "node"), "cycle-strong")
        several = strong.groupBy("c").agg(F.count("*").alias("n")).where("n > 1").select("c")
        found = materialise(found.unionByName(strong.hint("merge").join(several, "c", "left_semi").select("node")), "cycle-found")
        gone = strong.select("node")
        left = left.hint("merge").join(gone, left.a == gone.node, "left_anti").hint("merge").join(gone, F.col("b") == gone.node, "left_anti")


#: Each hop is one more join of one plan.
MOST_HOPS = 6


def hops(edges: DataFrame, roots: DataFrame, depth: int, a: str = "a", b: str = "b") -> DataFrame:
    """``root, node, depth``: what each root reaches in at most ``depth`` steps, at its least depth; a depth beyond 0 to 6 is an error."""
    if not 0 <= depth <= MOST_HOPS:
        raise ValueError(f"depth {depth} is not in 0 to {MOST_HOPS}; components or pointer jumping reach farther")
    step = edges.select(F.col(a).alias("node"), F.col(b).alias("next")).where("node is not null and next is not null").distinct()
    front = roots.select(F.col("root"), F.col("root").alias("node")).where("root is not null").distinct().withColumn("depth", F.lit(0))
    found = front
    for d in range(1, depth + 1):
        front = front.join(step, "node").select("root", F.col("next").alias("node")).distinct().withColumn("depth", F.lit(d))
        found = found.unionByName(front)
    return found.groupBy("root", "node").agg(F.min("depth").alias("depth"))


def resolve_chains(mapping: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """``source, target`` with chains followed to their end (a to b, b to c: a to c) by pointer jumping.

    Each source has one target. What runs into a cycle ends at the cycle's smallest member.
    Chains are shuffled in every round, never sent whole through the driver.
    """
    now = materialise(mapping.select(F.col(source).alias("s"), F.col(target).alias("t"), F.col(source).alias("low")), "chains")
    for _ in range(max(1, now.count()).bit_length() + 1):  # each jump doubles the steps taken
        after = now.select(F.col("s").alias("t"), F.col("t").alias("t2"), F.col("low").alias("low2"))
        now = materialise(now.hint("merge").join(after, "t", "left").select("s", F.coalesce("t2", "t").alias("t"), F.least("low", F.coalesce("low2", "low")).alias("low")), "chains")
    rounds = now.select(F.col("s").alias("t"), F.col("low").alias("least"))  # t is still a source only on a cycle
    return now.hint("merge").join(rounds, "t", "left").select(F.col("s").alias(source), F.coalesce("least", "t").alias(target))

"""Family trees around many people at once, and children in the order of their births."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinweave.session import materialise


def walk(edges: DataFrame, roots: DataFrame, depth: int | None = None, a: str = "a", b: str = "b") -> DataFrame:
    """``root, node, depth, path``: what each root reaches, at its least depth, by its shortest path (of several the least).

    A path begins with the root and ends with the node. Without a ``depth`` the walk goes on
    until nothing new is found, so a circle ends it too; a negative depth is an error. Each
    step joins the last step's finds only, which are written down; null ends, loops and
    repeated edges do no harm. The rows are those of the answer, whatever their number.
    """
    if depth is not None and depth < 0:
        raise ValueError(f"depth {depth} is below 0")
    step = edges.select(F.col(a).alias("node"), F.col(b).alias("next")).where("node is not null and next is not null and node <> next").distinct()
    if depth is None or depth > 1:
        step = materialise(step, "walk-edges")
    front = roots.select("root").where("root is not null").distinct().select("root", F.col("root").alias("node"), F.lit(0).alias("depth"), F.array("root").alias("path"))
    found = materialise(front, "walk")
    front, d = found, 0
    while depth is None or d < depth:
        d += 1
        came = front.join(step, "node").groupBy("root", F.col("next").alias("node")).agg(F.min(F.concat("path", F.array("next"))).alias("path"))
        fresh = came.join(found.select("root", "node"), ["root", "node"], "left_anti")
        front = materialise(fresh.select("root", "node", F.lit(d).alias("depth"), "path"), "walk")
        if front.isEmpty():
            break
        found = found.unionByName(front)
    return found


#: What a node is to the root; of several the first counts where the generation is the same.
RELATIONS = ("root", "ancestor", "descendant", "co-parent", "spouse")


def family_tree(parents: DataFrame, unions: DataFrame, roots: DataFrame, up: int | None = 3, down: int | None = 3) -> DataFrame:
    """``root, node, generation, relation, path``: the tree around each root, one row a node.

    ``parents``: ``child, parent``; ``unions``: ``husband, wife``. Generations count down to
    ancestors and up to descendants; a node on two levels takes the one nearest to the root,
    above before below. The other parent of each descendant comes in one generation above
    the child, nobody beyond; then the spouses of all who are in, on their level. Either of
    them comes by the nearest who brings them. None as a depth goes as far as there are edges.
    """
    known = parents.where("child is not null and parent is not null and child <> parent").select("child", "parent").distinct()
    above = walk(known, roots, up, "child", "parent").select("root", "node", (-F.col("depth")).alias("generation"), F.when(F.col("depth") == 0, 0).otherwise(1).alias("rank"), "path")
    below = walk(known, roots, down, "parent", "child").where("depth > 0").select("root", "node", F.col("depth").alias("generation"), F.lit(2).alias("rank"), "path")
    nearest = F.min(F.struct(F.abs("generation").alias("far"), "rank", "path", "generation")).alias("best")
    one = lambda df: df.groupBy("root", "node").agg(nearest).select("root", "node", "best.generation", "best.rank", "best.path")
    blood = materialise(one(above.unionByName(below)), "tree")
    brought = blood.where("generation > 0").join(known.withColumnRenamed("child", "node"), "node").select("root", F.col("parent").alias("node"), (F.col("generation") - 1).alias("generation"), F.lit(3).alias("rank"), F.concat("path", F.array("parent")).alias("path"))
    with_parents = materialise(blood.unionByName(one(brought.join(blood.select("root", "node"), ["root", "node"], "left_anti"))), "tree")
    couples = unions.where("husband is not null and wife is not null and husband <> wife").select("husband", "wife")
    sides = couples.toDF("node", "other").union(couples.select("wife", "husband").toDF("node", "other")).distinct()
    wed = with_parents.join(sides, "node").select("root", F.col("other").alias("node"), "generation", F.lit(4).alias("rank"), F.concat("path", F.array("other")).alias("path"))
    everyone = with_parents.unionByName(one(wed.join(with_parents.select("root", "node"), ["root", "node"], "left_anti")))
    return everyone.select("root", "node", "generation", F.get(F.array(*map(F.lit, RELATIONS)), F.col("rank")).alias("relation"), "path")


def children_in_order(parents: DataFrame, people: DataFrame) -> DataFrame:
    """``parent, child, place, other``: each person's children by birth, else by the year first seen, then by id; unknown years last.

    ``people``: ``id, birth, first``. ``other`` is the child's other parent, the least of
    several, so that children of two unions can be told apart.
    """
    links = parents.where("child is not null and parent is not null").select("child", "parent").distinct()
    # Two least parents of a child are enough to find the other one.
    least = F.min("parent").over(Window.partitionBy("child"))
    second = F.min(F.when(F.col("parent") > F.col("least"), F.col("parent"))).over(Window.partitionBy("child"))
    both = links.withColumn("least", least).withColumn("second", second)
    other = F.when(F.col("parent") == F.col("least"), F.col("second")).otherwise(F.col("least"))
    dated = both.select("parent", "child", other.alias("other")).join(people.select(F.col("id").alias("child"), F.coalesce("birth", "first").alias("_year")), "child", "left")
    order = Window.partitionBy("parent").orderBy(F.asc_nulls_last("_year"), "child")
    return dated.withColumn("place", F.row_number().over(order)).select("parent", "child", "place", "other")

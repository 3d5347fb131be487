"""Relations that one record declares, from its rows in page order.

Rows: ``act, row, role, name, surname``. Windows run inside one act, which is a page at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.text import canonical


def single_subject(rows: DataFrame, subjects: tuple[str, ...] = ("newborn", "deceased")) -> DataFrame:
    """``act, row, father_row, mother_row`` of the subject of an act, if it has just one of each.

    Two fathers (or mothers) in one act leave that parent null: nothing is decided.
    """
    one = lambda role: F.when(F.count_if(F.col("role") == role) == 1, F.max(F.when(F.col("role") == role, F.col("row"))))
    parents = rows.groupBy("act").agg(one("father").alias("father_row"), one("mother").alias("mother_row"), F.count_if(F.col("role").isin(*subjects)).alias("n"))
    subject = rows.where(F.col("role").isin(*subjects)).select("act", "row")
    return subject.join(parents.where("n = 1"), "act").select("act", "row", "father_row", "mother_row")


def marriage_parents(rows: DataFrame) -> DataFrame:
    """``act, row, role, spouse_row`` of each father and mother in a marriage.

    If both spouses stand before the first parent, the first half of the parents are the
    first spouse's; else each parent goes with the spouse last seen. A father whose surname
    is one spouse's alone goes with that spouse, and a mother with the father before her.
    """
    spouse = F.col("role").isin("groom", "bride")
    parent = F.col("role").isin("father", "mother")
    act = Window.partitionBy("act")
    upto = act.orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    keyed = rows.withColumns({
        "last_spouse": F.last(F.when(spouse, F.col("row")), True).over(upto),
        "first_parent": F.min(F.when(parent, F.col("row"))).over(act),
        "spouse_1": F.min(F.when(spouse, F.col("row"))).over(act),
        "spouse_2": F.max(F.when(spouse, F.col("row"))).over(act),
        "parents": F.sum(parent.cast("int")).over(act),
        "nth": F.sum(parent.cast("int")).over(upto),
        "key": canonical(F.col("surname")),
    })
    keyed = keyed.withColumns({
        "key_1": F.max(F.when(F.col("row") == F.col("spouse_1"), F.col("key"))).over(act),
        "key_2": F.max(F.when(F.col("row") == F.col("spouse_2"), F.col("key"))).over(act),
    })
    grouped = F.col("spouse_2") < F.col("first_parent")
    placed = F.when(grouped, F.when(F.col("nth") * 2 <= F.col("parents"), F.col("spouse_1")).otherwise(F.col("spouse_2"))).otherwise(F.col("last_spouse"))
    named = F.when(F.col("key_1") != F.col("key_2"), F.when(F.col("key") == F.col("key_1"), F.col("spouse_1")).when(F.col("key") == F.col("key_2"), F.col("spouse_2")))
    father = F.when(F.col("role") == "father", F.coalesce(named, placed))
    # A mother follows the father who comes before her, if no spouse's row lies between.
    out = keyed.withColumn("placed", placed).withColumn("father_spouse", father)
    seen = out.withColumns({
        "before": F.last(F.when(F.col("role") == "father", F.col("father_spouse")), True).over(upto),
        "before_row": F.last(F.when(F.col("role") == "father", F.col("row")), True).over(upto),
    })
    mother = F.when(F.col("before_row") > F.coalesce("last_spouse", F.lit(-1)), F.col("before"))
    return seen.where(parent).select("act", "row", "role", F.coalesce("father_spouse", mother, "placed").alias("spouse_row"))


def stitch(acts: DataFrame, reach: int = 2) -> DataFrame:
    """``register, type, page, number, parts, text``: fragments of one act put together.

    ``acts``: ``register, type, page, place, number, text``. A fragment without a number
    belongs to the last numbered act of the nearest page before, at most ``reach`` back.
    Parts of one number on pages at most ``reach`` apart are one act; a larger gap begins
    another. Texts follow in page order with a blank line between.
    """
    order = Window.partitionBy("register", "type").orderBy("page", "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    seen = acts.withColumns({
        "last_number": F.last(F.when(F.col("number").isNotNull(), F.col("number")), True).over(before),
        "last_page": F.last(F.when(F.col("number").isNotNull(), F.col("page")), True).over(before),
    })
    near = (F.col("page") - F.col("last_page")).between(0, reach)
    numbered = seen.withColumn("own", F.coalesce("number", F.when(near, F.col("last_number")))).withColumn("key", F.coalesce("own", F.concat_ws("@", F.lit("?"), "page", "place")))
    run = Window.partitionBy("register", "type", "key").orderBy("page", "place")
    islands = numbered.withColumn("new", F.when(F.col("page") - F.lag("page").over(run) <= reach, 0).otherwise(1)).withColumn("island", F.sum("new").over(run))
    parts = F.array_sort(F.collect_list(F.struct("page", "place", "text")))
    return islands.groupBy("register", "type", "key", "island").agg(
        F.min("page").alias("page"), F.max("own").alias("number"), F.count("*").alias("parts"), F.array_join(F.transform(parts, lambda p: p["text"]), "\n\n").alias("text")
    ).drop("key", "island")

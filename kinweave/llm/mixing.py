"""Mixing sources to target weights by capped water-filling.

Sources share a word budget in proportion to their weights. A source whose share
exceeds ``max_epochs`` times its own size is clamped there and its excess goes to
the others by weight, until no source is above its clamp. A source then gives
``floor(target / size)`` whole repetitions, and one more of those documents whose
seeded hash lies below the source's cut; the cut is placed on the words, not the
documents, so that a few long texts do not pull a source off its target. Equal rows
draw the same number: where the cut falls among them, as many are taken as come nearest
to the target.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
MAX_SOURCES = 200_000
BINS = 4096


def water_fill(sizes: Sequence[int], weights: Sequence[float], max_epochs: float, budget: float) -> list[float]:
    """Targets per source: clamp at ``max_epochs * size``, reshare the excess by weight until feasible."""
    targets = [0.0] * len(sizes)
    open_, left = [i for i, n in enumerate(sizes) if n > 0 and weights[i] > 0], float(budget)
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > max_epochs * sizes[i]]
        if not over:
            for i in open_:
                targets[i] = left * weights[i] / total
            break
        for i in over:
            targets[i] = float(max_epochs * sizes[i])
            left -= targets[i]
        open_ = [i for i in open_ if i not in set(over)]
    return targets


def cycle_weights(sources: Sequence[str | None]) -> list[float]:
    """Weights 1, 2, 3, repeating, over sources in code point order, null last."""
    order = sorted(range(len(sources)), key=lambda i: (sources[i] is None, sources[i] or ""))
    weights = [0.0] * len(sources)
    for place, i in enumerate(order):
        weights[i] = float(place % 3 + 1)
    return weights


def _draw(seed: int, id_col: str, text_col: str) -> Column:
    bits = F.xxhash64(F.lit(seed), F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))
    return F.shiftrightunsigned(bits, 11) / F.lit(float(1 << 53))


def mix(
    df: DataFrame,
    weigh: Callable[[Sequence[str | None]], list[float]] = cycle_weights,
    *,
    max_epochs: float = 3.0,
    budget: float | None = None,
    seed: int = 20260831,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The rows of ``df`` with ``size, source_size, target, repetitions, taken``.

    ``budget`` is in words; None means all the words of the input. Sizes count
    ``[^\\x20\\x09-\\x0D]+`` in the whole text.

    Defined cases: a null or empty text has size 0 and takes nothing; a null source is
    a source of its own, last in order; a null id is hashed like any other value;
    rows of one id and text draw the same number, and where the cut falls among them some
    are taken once more than the others, in the order of the partitions that hold them; an
    empty table gives an empty table; input columns named like an output are replaced. More
    than ``MAX_SOURCES`` sources raise ValueError: the per-source plan is held on the driver.
    """
    from kinweave.session import materialise

    spark = df.sparkSession
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = df.select(F.col(source_col).cast("string").alias("src"), size.alias("n"), _draw(seed, id_col, text_col).alias("u"))
    rows = materialise(rows, "mix-sizes")

    totals = rows.groupBy("src").agg(F.sum("n").alias("total")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    totals.sort(key=lambda r: (r.src is None, r.src or ""))
    names, sizes = [r.src for r in totals], [r.total for r in totals]
    targets = water_fill(sizes, weigh(names), max_epochs, sum(sizes) if budget is None else budget)
    whole = [int(t // n) if n else 0 for t, n in zip(targets, sizes)]
    rest = [t - w * n for t, w, n in zip(targets, whole, sizes)]
    plan = spark.createDataFrame(list(zip(names, map(float, rest))), "plan_src string, rest double")

    # The cut in two steps: the bin of the hash in which the words reach the rest, then the place in that bin.
    bins = rows.groupBy("src", F.floor(F.col("u") * BINS).cast("int").alias("bin")).agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("src").orderBy("bin"))
    edge = (
        bins.withColumn("upto", upto)
        .join(F.broadcast(plan), F.col("src").eqNullSafe(F.col("plan_src")))
        .where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") <= F.col("rest")))
        .select("src", "bin", (F.col("rest") - (F.col("upto") - F.col("n"))).alias("room"))
        .groupBy("src")
        .agg(F.min_by("bin", "bin").alias("bin"), F.min_by("room", "bin").alias("room"))
    )
    inside = rows.alias("r").join(
        F.broadcast(edge.alias("e")),
        F.col("r.src").eqNullSafe(F.col("e.src")) & (F.floor(F.col("r.u") * BINS).cast("int") == F.col("e.bin")),
    )
    # Rows of one draw are one group; the cut falls between two groups or inside one.
    groups = inside.where("r.n > 0").groupBy(F.col("r.src").alias("src"), "bin", F.col("r.u").alias("u"), "room").agg(F.sum("r.n").alias("n"), F.count("*").alias("rows"))
    groups = groups.withColumn("upto", F.sum("n").over(Window.partitionBy("src").orderBy("u")))
    groups = groups.withColumn("of", F.floor((F.col("room") - F.col("upto") + F.col("n")) * F.col("rows") / F.col("n") + 0.5).cast("long"))
    whole_group = F.col("of") >= F.col("rows")
    cuts = groups.groupBy("src", "bin").agg(
        F.max(F.when(whole_group, F.col("u"))).alias("last"),
        F.min(F.when(~whole_group & (F.col("of") > 0), F.struct("u", "of"))).alias("part"),
    )
    cut_of = {r.src: r for r in cuts.select("src", F.coalesce("last", F.col("bin") / BINS - 1e-18).alias("cut"), "part.u", "part.of").collect()}
    plan_rows = []
    for s, n, t, w in zip(names, sizes, map(float, targets), whole):
        cut = cut_of.get(s)
        plan_rows.append((s, n, t, w, cut.cut if cut else -1.0, cut.u if cut else None, cut.of if cut else None))
    final = spark.createDataFrame(plan_rows, "kw_src string, kw_source_size long, kw_target double, kw_whole int, kw_cut double, kw_part double, kw_of long")
    joined = df.join(F.broadcast(final), F.col(source_col).cast("string").eqNullSafe(F.col("kw_src")), "left")
    joined = joined.withColumns({"kw_size": size, "kw_u": _draw(seed, id_col, text_col)}).withColumn("kw_extra", (F.col("kw_u") <= F.col("kw_cut")).cast("int"))
    if any(r.u is not None for r in cut_of.values()):
        among = F.coalesce(F.col("kw_u") == F.col("kw_part"), F.lit(False))
        joined = joined.where(~among).unionByName(_some_of(joined.where(among)))
    out = joined.withColumn("kw_reps", F.col("kw_whole") + F.col("kw_extra"))
    made = {
        "size": F.col("kw_size"),
        "source_size": F.col("kw_source_size"),
        "target": F.col("kw_target"),
        "repetitions": F.when(F.col("kw_size") > 0, F.col("kw_reps")).otherwise(0),
        "taken": F.col("kw_size") * F.col("kw_reps"),
    }
    kept = [F.col(c) for c in df.columns if c not in made]
    return out.select(*kept, *(v.alias(k) for k, v in made.items()))


def _some_of(rows: DataFrame) -> DataFrame:
    """``rows`` with ``kw_extra`` 1 for the first ``kw_of`` of each source, counted partition by partition."""
    from kinweave.session import materialise

    held = materialise(rows.withColumn("kw_number", F.monotonically_increasing_id()), "mix-equal").withColumn("kw_task", F.shiftright("kw_number", 33))
    per_task = held.groupBy(F.col("kw_src").alias("kw_of_src"), F.col("kw_task").alias("kw_of_task")).agg(F.count("*").alias("kw_rows"))
    before = F.coalesce(F.sum("kw_rows").over(Window.partitionBy("kw_of_src").orderBy("kw_of_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row for each source and partition.
    per_task = per_task.select("kw_of_src", "kw_of_task", before.alias("kw_before"))
    place = F.row_number().over(Window.partitionBy("kw_src", "kw_task").orderBy("kw_number"))
    counted = held.withColumn("kw_place", place).join(per_task, F.col("kw_src").eqNullSafe(F.col("kw_of_src")) & (F.col("kw_task") == F.col("kw_of_task")))
    return counted.withColumn("kw_extra", (F.col("kw_before") + F.col("kw_place") <= F.col("kw_of")).cast("int")).select(*rows.columns)


def repeat_rows(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each row as often as the mix takes it, with ``columns`` only.

    Defined cases: rows that the mix does not take, among them all without words, have no
    copy; repeated rows each have their copies; an empty table gives an empty table.
    """
    times = F.explode(F.expr("sequence(1, repetitions)"))
    return mixed.where("repetitions > 0").select(*columns, times.alias("kw_time")).drop("kw_time")

"""Document fingerprints by spot signatures, in DataFrame functions only.

A spot is a common word (an anchor); its signature is the anchor with the next two
content words, common words between them skipped. The start of a text is an anchor too,
and so is every content word whose checksum leaves 0 by OWN_ANCHORS: a text in a language
without listed words, or a list of names, is covered throughout as well. The sorted set
of hashed signatures is the fingerprint, and the likeness of two texts is the Jaccard
share of their sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.llm.quantiles import bounds, bucket

#: Common words of English, French, German and Spanish that serve as anchors.
ANCHORS = (
    "the of and to a in is that it was for on are as with be at this have from or by not but "
    "le la les de des du et un une que qui dans pour pas au avec par sur plus est ce il "
    "der die das den dem und von zu mit sich auf für ist im nicht ein eine als auch es "
    "el los las del y en se no lo con para su al como más"
).split()

#: One content word in so many, by its checksum, is an anchor as well.
OWN_ANCHORS = 4


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _signatures(runs: Column) -> Column:
    """The hashes of every anchor with the two content words after it, from ``runs``.

    A run is a content word and the anchors (marked with #) that follow it; the word
    itself (marked with ~) may be an anchor.
    """
    three = F.arrays_zip(runs.alias("a"), F.slice(runs, F.lit(2), F.size(runs)).alias("b"), F.slice(runs, F.lit(3), F.size(runs)).alias("c"))
    whole = F.slice(three, F.lit(1), F.greatest(F.size(three) - 2, F.lit(0)))
    anchors = lambda run: F.array_distinct(F.filter(F.split(run, " "), lambda w: w.startswith("#")))
    word = lambda run: F.substring_index(run, " ", 1)
    own = lambda run: ~run.startswith("#") & (F.crc32(word(run).cast("binary")) % OWN_ANCHORS == 0)
    starts = lambda run: F.when(own(run), F.concat(anchors(run), F.array(F.concat(F.lit("~"), word(run))))).otherwise(anchors(run))
    each = F.transform(F.filter(whole, lambda x: x["a"].contains("#") | own(x["a"])), lambda x: F.transform(starts(x["a"]), lambda w: F.hash(w, word(x["b"]), word(x["c"]))))
    return F.array_sort(F.array_distinct(F.flatten(each)))


def spot_set(text: Column) -> Column:
    """The sorted distinct signature hashes of a text (array<int>), never empty.

    A null text counts as empty. A text with fewer than two content words has one
    signature, its whole word sequence; one without words, its characters. A text with
    only one signature besides has its whole word sequence as a second, so that a common
    beginning alone does not make two texts alike.
    """
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    marked = F.concat(F.lit("#^ "), F.array_join(F.transform(words, lambda w: F.when(w.isin(ANCHORS), F.concat(F.lit("#"), w)).otherwise(w)), " "))

    def whole(runs: Column) -> Column:
        line = F.array_join(runs, " ")
        return F.array(F.hash(F.lit("whole"), F.when(line == "#^ ", text).otherwise(line)))

    return _let(F.split(marked, " (?=[^#])"), lambda runs: _let(_signatures(runs), lambda s: F.when(F.size(s) > 1, s).otherwise(F.array_sort(F.array_union(s, whole(runs))))))


def as_text(spots: Column) -> Column:
    """A signature set as eight hex digits each."""
    return F.array_join(F.transform(spots, lambda h: F.right(F.concat(F.lit("00000000"), F.lower(F.hex(h))), F.lit(8))), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard share of two signature sets."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both).cast("double")


def _bucketed(df: DataFrame, id_col: str, text_col: str, rows_per_bucket: int, max_buckets: int) -> DataFrame:
    """``id, text, k, bucket``: buckets ascend with the id, cut at its approximate quantiles."""
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)))
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), key.alias("k"))
    buckets = max(1, min(max_buckets, df.count() // rows_per_bucket))
    return rows.withColumn("bucket", bucket(F.col("k"), bounds(rows, "k", buckets)))


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_bucket: int = 2000, max_buckets: int = 100_000) -> DataFrame:
    """``id_col, text, spots`` of each row with ``next_text, next_spots`` of the next row by id.

    The order is ascending id, null first, ties by text; after the last comes the first.
    Ids fall into buckets of about equally many rows, and the first row of each bucket is
    also given to the bucket before, so that one shuffle by bucket finds every next row.

    Defined cases: null texts count as empty; rows with a null id, or with one id, follow
    each other by text; repeated rows each give a row; a single row is followed by itself;
    an empty table gives an empty table; other columns are not read.
    """
    spark = df.sparkSession
    rows = _bucketed(df, id_col, text_col, rows_per_bucket, max_buckets)
    heads = sorted(map(tuple, rows.groupBy("bucket").agg(F.min("k").alias("k")).collect()))  # at most max_buckets rows
    before = [(heads[i][1], heads[i - 1][0]) for i in range(len(heads))]
    before = spark.createDataFrame(before, "k long, before int")
    placed = rows.join(F.broadcast(before), "k", "left").select(
        "id", "k", "text", F.explode(F.expr("filter(array(named_struct('b', bucket, 'guest', 0), named_struct('b', before, 'guest', 1)), x -> x.b is not null)")).alias("at")
    )
    placed = placed.select("id", "k", "text", F.col("at.b").alias("bucket"), F.col("at.guest").alias("guest"))
    placed = placed.repartition("bucket").withColumn("spots", spot_set(F.col("text")))
    order = Window.partitionBy("bucket").orderBy("guest", "k", "text")
    led = placed.withColumns({"next_text": F.lead("text").over(order), "next_spots": F.lead("spots").over(order)})
    return led.where("guest = 0").select("id", "text", "spots", "next_text", "next_spots")


def edited(text: Column, following: Column) -> Column:
    """The last half of the code points replaced by as many (or all) of the following text's first; null if either is null."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, spots, fingerprint`` of every whole text.

    Defined cases: null texts count as empty; equal texts have equal fingerprints; null
    ids stay null; repeated rows each give a row; an empty table gives an empty table;
    other columns are not read.
    """
    return df.select(id_col, spot_set(F.col(text_col)).alias("spots")).withColumn("fingerprint", as_text(F.col("spots")))


def near_pairs(prints: DataFrame, threshold: float = 0.8, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Membership and pairs: ``(id_col, class_id)`` and ``(class_a, class_b, likeness)``.

    Documents of equal signature sets are one class (``class_id`` its smallest id; rows
    with a null id take no part). Classes are partitioned by set length: sets of likeness
    ``threshold`` differ in length by at most that factor, so a set meets only its own
    length band and the next. Within a band, sets are joined on their rarest signatures
    only (of n, the first ``n - ceil(threshold * n) + 1``: a similar pair shares one), and
    likeness is then counted on whole sets. The pairs of a family of m different but
    similar sets are m * (m - 1) / 2 rows; where only groups are asked for, use ``op9``.

    Defined cases: repeated rows are members once each; an empty table gives two empty
    tables; columns other than the id and ``spots`` are not read.
    """
    rows = prints.where(F.col(id_col).isNotNull()).select(id_col, "spots", F.xxhash64("spots").alias("h"), F.hash("spots").alias("g"), F.size("spots").alias("n"))
    heads = rows.groupBy("h", "g", "n").agg(F.min(id_col).alias("class_id"))
    members = rows.select(id_col, "h", "g", "n").join(heads, ["h", "g", "n"]).select(id_col, "class_id")
    classes = rows.withColumnRenamed(id_col, "class_id").join(heads, ["h", "g", "n", "class_id"]).select("class_id", "spots", "n").dropDuplicates(["class_id"])
    each = classes.select("class_id", "n", F.explode("spots").alias("spot"))
    rare = each.groupBy("spot").agg(F.count("*").alias("df"))
    ranked = each.join(rare, "spot").withColumn("place", F.row_number().over(Window.partitionBy("class_id").orderBy("df", "spot")))
    prefix = ranked.where(F.col("place") <= F.col("n") - F.ceil(F.lit(threshold) * F.col("n")) + 1)
    band = F.floor(F.log("n") / -F.log(F.lit(threshold))).cast("int")
    left = prefix.select(F.col("class_id").alias("a"), F.col("n").alias("na"), "spot", band.alias("band"))
    right = prefix.select(F.col("class_id").alias("b"), F.col("n").alias("nb"), "spot", F.explode(F.array(band - 1, band, band + 1)).alias("band"))
    close = (F.col("a") < F.col("b")) & (F.least("na", "nb") >= F.lit(threshold) * F.greatest("na", "nb"))
    found = left.join(right, ["spot", "band"]).where(close).select("a", "b").distinct()
    sets = classes.select("class_id", "spots")
    pairs = (
        found.join(sets.select(F.col("class_id").alias("a"), F.col("spots").alias("sa")), "a")
        .join(sets.select(F.col("class_id").alias("b"), F.col("spots").alias("sb")), "b")
        .select(F.col("a").alias("class_a"), F.col("b").alias("class_b"), likeness(F.col("sa"), F.col("sb")).alias("likeness"))
        .where(F.col("likeness") >= threshold)
    )
    return members, pairs

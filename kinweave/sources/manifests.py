"""Image manifests, catalogue entries and the years they cover."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MANIFEST = (
    "metadata array<struct<label:string,value:string>>, "
    "sequences array<struct<canvases:array<struct<`@id`:string,label:string,images:array<struct<resource:struct<`@id`:string,format:string>>>>>>>"
)


def parse_manifests(rows: DataFrame, json_col: str, key: str) -> DataFrame:
    """``key, place, canvas, label, image, fields``: the canvases of each manifest in order.

    ``fields`` maps each metadata label to its value; a value may be a text, a list or an
    object with ``@value`` (lists are joined, objects reduced). What is no JSON is left out.
    """
    parsed = rows.select(key, F.from_json(json_col, MANIFEST).alias("m")).where("m is not null and m.sequences is not null")
    text = lambda v: F.coalesce(F.get_json_object(v, "$[0].@value"), F.get_json_object(v, "$.@value"), F.array_join(F.from_json(v, "array<string>"), " "), v)
    pairs = F.transform(F.coalesce("m.metadata", F.array().cast("array<struct<label:string,value:string>>")), lambda x: F.struct(x["label"], text(x["value"])))
    fields = F.map_from_entries(F.filter(pairs, lambda x: x["label"].isNotNull()))
    canvases = F.posexplode(F.get(F.col("m.sequences"), F.lit(0))["canvases"]).alias("place", "c")
    return parsed.select(key, fields.alias("fields"), canvases).select(key, "place", F.col("c.@id").alias("canvas"), "c.label", F.get(F.col("c.images"), F.lit(0))["resource"]["@id"].alias("image"), "fields")


def manifest_url(html: Column) -> Column:
    """The manifest named in a gallery page: the script's variable, else a link that ends in ``manifest``."""
    script = F.regexp_extract(html, r"manifestId\s*[=:]\s*['\"]([^'\"]+)['\"]", 1)
    link = F.regexp_extract(html, r"href=['\"]([^'\"]*manifest(?:\.json)?)['\"]", 1)
    return F.coalesce(F.nullif(script, F.lit("")), F.nullif(link, F.lit("")))


def years_covered(title: Column) -> Column:
    """``struct(first, last)`` of the years 1700..1999 in a title; one year covers itself."""
    years = F.transform(F.regexp_extract_all(title, F.lit(r"\b(1[789]\d{2})\b"), F.lit(1)), lambda y: y.cast("int"))
    return F.when(F.size(years) > 0, F.struct(F.get(years, F.lit(0)).alias("first"), F.array_max(years).alias("last")))


def merge_catalogue(old: DataFrame, new: DataFrame, key: str = "ark_url") -> DataFrame:
    """All old entries and the new ones whose key is not there; of equal new keys one stays."""
    return old.unionByName(new.dropDuplicates([key]).join(old.select(key), key, "left_anti"), allowMissingColumns=True)


def fill_gaps(kept: DataFrame, left_out: DataFrame) -> DataFrame:
    """Registers left out by kind that cover a (year, type) no kept register covers.

    Both have ``slug, first, last, type``; a register returns once, if one of its years is open.
    """
    years = lambda df: df.select("slug", "type", F.explode(F.sequence("first", "last")).alias("year"))
    open_ = years(left_out).join(years(kept).select("type", "year").distinct(), ["type", "year"], "left_anti").select("slug").distinct()
    return left_out.join(open_, "slug", "left_semi")

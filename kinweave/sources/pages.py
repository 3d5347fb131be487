"""Pages of records as nested JSON, and the tables they hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PERSON = "struct<ruolo:string,nome:string,cognome:string,eta:string,professione:string,residenza:string,stato_vitale:string,note:string>"
ACT = f"struct<numero_atto:string,tipo:string,data_atto:string,data_evento:string,ora_evento:string,luogo:string,persone:array<{PERSON}>,testo_integrale:string,parti_illeggibili:array<string>,affidabilita:string>"
ENTRY = "struct<cognome:string,nome:string,numero_atto:string>"
ORIGIN = "struct<immagine:string,registro:string,ark_url:string,anno:int,tipologia:string,contesto:string>"
#: The page document, all its fields optional.
PAGE = f"tipo_pagina string, anno_indicato string, comune_indicato string, osservazioni string, lato_pagina string, atti array<{ACT}>, voci_indice array<{ENTRY}>, _origine {ORIGIN}"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """All page files below a folder; names that begin with ``_`` are skipped, and what is no JSON.

    Adds ``file``; backslashes in image names become slashes.
    """
    rows = spark.read.schema(PAGE + ", _bad string").option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").option("columnNameOfCorruptRecord", "_bad").json(path)
    return tidy(rows.withColumn("file", F.col("_metadata.file_path")).where("_bad is null").drop("_bad"))


def parse_pages(rows: DataFrame, json_col: str) -> DataFrame:
    """Pages out of a column of JSON texts; what cannot be read is left out."""
    parsed = rows.withColumn("page", F.from_json(json_col, PAGE)).where("page is not null")
    return tidy(parsed.select(*[c for c in rows.columns if c != json_col], "page.*"))


def tidy(pages: DataFrame) -> DataFrame:
    image = F.replace(F.col("_origine.immagine"), F.lit("\\"), F.lit("/"))
    return pages.withColumn("_origine", F.col("_origine").withField("immagine", image))


def admitted(pages: DataFrame, registers: DataFrame) -> DataFrame:
    """Pages of the registers given; a page that names no register stays."""
    wanted = registers.select(F.col("registro").alias("r")).distinct().withColumn("known", F.lit(True))
    joined = pages.join(wanted, F.col("_origine.registro") == F.col("r"), "left")
    return joined.where("known or _origine.registro is null").drop("r", "known")


def acts(pages: DataFrame, key: str = "file") -> DataFrame:
    """One row an act, in page order; blank fields are null, the year is the date's or the register's."""
    each = pages.select(key, "_origine", F.posexplode("atti").alias("place", "act"))
    blank = lambda c: F.nullif(F.trim(F.col(f"act.{c}")), F.lit(""))
    year = F.nullif(F.regexp_extract(F.col("act.data_atto"), r"\b(1[78]\d{2}|19\d{2})\b", 1), F.lit("")).cast("int")
    fields = ("numero_atto", "tipo", "data_atto", "data_evento", "ora_evento", "luogo", "testo_integrale", "affidabilita")
    return each.select(
        key, "place", F.col("_origine.registro").alias("registro"), F.col("_origine.immagine").alias("immagine"),
        *[blank(c).alias(c) for c in fields], F.coalesce(year, F.col("_origine.anno")).alias("anno"),
        F.array_join("act.parti_illeggibili", " | ").alias("incertezze"), "act.persone",
    )


def people(acts_: DataFrame, key: str = "file") -> DataFrame:
    """One row a person, in act order, with the raw reading beside the cleaned one."""
    from kinweave.functions.text import doubtful

    each = acts_.select(key, "place", F.posexplode("persone").alias("row", "p"))
    name, surname = doubtful(F.col("p.nome")), doubtful(F.col("p.cognome"))
    return each.select(
        key, "place", "row", "p.ruolo", name["value"].alias("nome"), F.col("p.nome").alias("nome_letto"), surname["value"].alias("cognome"),
        F.col("p.cognome").alias("cognome_letto"), (name["uncertain"] | surname["uncertain"]).alias("incerto"), "p.eta", "p.professione", "p.residenza", "p.stato_vitale", "p.note",
    )


def index_entries(pages: DataFrame, key: str = "file") -> DataFrame:
    """One row an entry of an index page."""
    return pages.select(key, F.col("_origine.registro").alias("registro"), F.posexplode("voci_indice").alias("row", "v")).select(key, "registro", "row", "v.*")


#: Words of a page that is a table of an index and was read as an act.
INDEX_WORDS = r"(?i)\b(indice alfabetico|tavola decennale|indice annuale|numero d'ordine degli atti)\b"


def real_acts(acts_: DataFrame) -> DataFrame:
    """Acts without those that are tables of an index by their text."""
    return acts_.where(~F.coalesce(F.col("testo_integrale").rlike(INDEX_WORDS), F.lit(False)))


def registers_of(pages: DataFrame) -> DataFrame:
    """``folder, registro``: the register of each folder, as its first page names it; a folder without one has null and stays."""
    folder = F.regexp_extract("file", r"^(.*)/[^/]*$", 1)
    return pages.groupBy(folder.alias("folder")).agg(F.min_by("_origine.registro", "file").alias("registro"))


def place_of_person() -> Column:
    """A person's street, else the act's."""
    return F.coalesce("via", "via_atto")

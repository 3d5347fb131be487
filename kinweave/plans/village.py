"""Acts and their rows derived from the order lines, and what can be read in them.

An order is an act (birth, death or marriage) and its lines are the rows of the act, in
order; parts and suppliers give names and surnames, so that every rule has cases to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinweave.functions.text import MARKED, PLAIN, canonical, name_parts
from kinweave.operators import blocking, interpret
from kinweave.session import materialise
from kinweave.sources.tables import table

MEN = ("Giuseppe", "Domenico", "Nicola", "Antonio", "Vincenzo", "Michele", "Carmine", "Luca", "Andrea", "Filippo", "Celeste", "Amabile")
WOMEN = ("Maria", "Domenica", "Angela", "Lucia", "Rosa", "Filomena", "Teresa", "Carmela", "Concetta", "Anna", "Celeste", "Amabile")
HEADS = ("Pelli", "Mar", "Otta", "Bru", "Ferra", "Qua", "Zucca", "Tede", "Lel", "Moret", "Franche", "Desi", "Chiel", "Di Nar", "De Lu", "Cicchi")
TAILS = ("ccia", "zo", "viano", "no", "ndino", "glia", "ro", "sco", "la", "ta", "lla", "derio", "li", "do", "cia", "tti")
TRADES = ("contadino", "bovaro", "sarto", "fabbro", "filatrice", "pastore", "mugnaio", "notaio", "levatrice", "calzolaio", "muratore")
PLACES = ("strada della Piazza", "vico Lungo", "contrada Lame", "via Nuova", "rione Castello")


def pick(words: tuple[str, ...], at: Column) -> Column:
    """One of ``words``, by a number."""
    return F.get(F.array(*[F.lit(w) for w in words]), F.pmod(at, F.lit(len(words))).cast("int"))


def pick_sql(words: tuple[str, ...], at: str) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + f"][({at}) % {len(words)} + 1]"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of all acts: ``id, act, row, register, type, year, month, page, role, name, surname, age, trade, place, status, uncertain``."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus")
    act, part, supp = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    rows = line.withColumn("row", F.row_number().over(order)).withColumn("type", pick(("birth", "death", "marriage"), act))
    role = (
        F.when(F.col("row") > 6, "witness")
        .when(F.col("type") == "birth", F.get(F.array(*map(F.lit, ("newborn", "father", "mother", "declarant", "witness", "witness"))), F.col("row") - 1))
        .when(F.col("type") == "death", F.get(F.array(*map(F.lit, ("deceased", "father", "mother", "spouse", "declarant", "witness"))), F.col("row") - 1))
        .otherwise(F.get(F.array(*map(F.lit, ("groom", "bride", "father", "mother", "father", "mother"))), F.col("row") - 1))
    )
    rows = rows.withColumn("role", role)
    woman = F.col("role").isin("mother", "bride") | (~F.col("role").isin("father", "groom") & (part % 2 == 0))
    given = F.when(woman, pick(WOMEN, part)).otherwise(pick(MEN, part))
    house = F.concat(pick(HEADS, supp), pick(TAILS, F.when(part % 29 == 0, supp).otherwise(F.floor(supp / 16))))
    swapped = part % 23 == 0
    surname = F.when(~(F.col("role").isin("newborn", "deceased", "father") & (part % 11 == 0)), house)
    age = F.when(F.col("role") == "deceased", F.floor(F.col("l_quantity") * 1.7)).when(F.col("role") != "newborn", F.col("l_quantity") + 18)
    return rows.select(
        (act * 100 + F.col("row")).alias("id"), act.alias("act"), F.col("row").alias("row"), F.concat(F.lit("r"), F.pmod(act, F.lit(40)).cast("string")).alias("register"), "type",
        (1809 + F.pmod(act * 7, F.lit(90))).cast("int").alias("year"), (F.pmod(act, F.lit(12)) + 1).cast("int").alias("month"), F.floor(act / 40).alias("page"), "role",
        F.when(swapped & surname.isNotNull(), surname).otherwise(given).alias("name"), F.when(swapped & surname.isNotNull(), given).otherwise(surname).alias("surname"),
        F.when(part % 3 != 0, age.cast("int")).alias("age"), F.when(F.col("role") != "newborn", pick(TRADES, part)).alias("trade"), pick(PLACES, supp).alias("place"),
        F.when((F.col("l_linestatus") == "F") & (part % 5 == 0), F.when(woman, "vedova").otherwise("fu")).alias("status"), (F.col("l_returnflag") == "R").alias("uncertain"),
    )


_WOMAN = "(role IN ('mother', 'bride') OR (role NOT IN ('father', 'groom') AND l_partkey % 2 = 0))"
_VILLAGE = f"""
v0 AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus) AS "row", {pick_sql(("birth", "death", "marriage"), "l_orderkey")} AS type FROM lineitem),
v1 AS (SELECT *, CASE WHEN "row" > 6 THEN 'witness' WHEN type = 'birth' THEN ['newborn', 'father', 'mother', 'declarant', 'witness', 'witness']["row"]
  WHEN type = 'death' THEN ['deceased', 'father', 'mother', 'spouse', 'declarant', 'witness']["row"] ELSE ['groom', 'bride', 'father', 'mother', 'father', 'mother']["row"] END AS role FROM v0),
v2 AS (SELECT *, CASE WHEN {_WOMAN} THEN {pick_sql(WOMEN, "l_partkey")} ELSE {pick_sql(MEN, "l_partkey")} END AS given,
  CASE WHEN NOT (role IN ('newborn', 'deceased', 'father') AND l_partkey % 11 = 0) THEN {pick_sql(HEADS, "l_suppkey")} || {pick_sql(TAILS, "CASE WHEN l_partkey % 29 = 0 THEN l_suppkey ELSE l_suppkey // 16 END")} END AS house FROM v1),
m AS (SELECT l_orderkey * 100 + "row" AS id, l_orderkey AS act, "row", 'r' || l_orderkey % 40 AS register, type, 1809 + l_orderkey * 7 % 90 AS year, l_orderkey % 12 + 1 AS month, l_orderkey // 40 AS page, role,
  CASE WHEN l_partkey % 23 = 0 AND house IS NOT NULL THEN house ELSE given END AS name, CASE WHEN l_partkey % 23 = 0 AND house IS NOT NULL THEN given ELSE house END AS surname,
  CASE WHEN l_partkey % 3 <> 0 THEN CASE WHEN role = 'deceased' THEN CAST(floor(l_quantity * 1.7) AS INT) WHEN role <> 'newborn' THEN CAST(l_quantity + 18 AS INT) END END AS age,
  CASE WHEN role <> 'newborn' THEN {pick_sql(TRADES, "l_partkey")} END AS trade, {pick_sql(PLACES, "l_suppkey")} AS place,
  CASE WHEN l_linestatus = 'F' AND l_partkey % 5 = 0 THEN CASE WHEN {_WOMAN} THEN 'vedova' ELSE 'fu' END END AS status, l_returnflag = 'R' AS uncertain FROM v2)
"""


def _canonical_sql(c: str) -> str:
    """The canonical form of names made of the heads and tails above: marks, a prefix as one letter, no spaces, no doubled letters."""
    w = f"translate(lower({c}), '{MARKED}', '{PLAIN}')"
    cut = f"(CASE WHEN left({w}, 3) IN ('di ', 'de ', 'lo ', 'la ') OR (left({w}, 2) IN ('di', 'de', 'lo', 'la') AND length({w}) > 4) THEN left({w}, 1) || {w}[3:] ELSE {w} END)"
    return f"array_to_string(list_filter(string_split(replace({cut}, ' ', ''), ''), lambda x, i: i = 1 OR x <> string_split(replace({cut}, ' ', ''), '')[i - 1]), '')"


def frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each surname, name part, trade and place stands in the corpus."""
    rows = mentions(spark, sf_dir)
    cells = F.explode(F.concat(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in ("surname", "trade", "place")]), F.transform(name_parts(F.col("name")), lambda p: F.struct(F.lit("part").alias("kind"), p.alias("value"))))).alias("c")
    return rows.select(cells).select("c.kind", "c.value").where("value is not null").groupBy("kind", "value").agg(F.count("*").alias("n"))


FREQUENCIES = f"""WITH {_VILLAGE} SELECT kind, value, count(*) AS n FROM (SELECT 'surname' AS kind, surname AS value FROM m UNION ALL SELECT 'trade', trade FROM m UNION ALL SELECT 'place', place FROM m
  UNION ALL SELECT 'part', unnest(list_filter(string_split(lower(name), ' '), lambda p: p NOT IN ('di', 'de'))) FROM m) WHERE value IS NOT NULL GROUP BY ALL"""


def decade_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surnames of the acts of 1840 to 1869 with counts worked out anew, and their weight."""
    rows = mentions(spark, sf_dir).where("year between 1840 and 1869 and surname is not null")
    total = F.broadcast(rows.agg(F.count("*").alias("total")))  # one row
    return rows.groupBy("surname").agg(F.count("*").alias("n")).crossJoin(total).select("surname", "n", F.round(F.least(F.lit(3.0), F.log10(0.8 * F.col("total") / F.col("n"))), 6).alias("weight"))


DECADE_SUBSET = f"""WITH {_VILLAGE}, r AS (SELECT * FROM m WHERE year BETWEEN 1840 AND 1869 AND surname IS NOT NULL)
SELECT surname, count(*) AS n, round(least(3.0, log10(0.8 * (SELECT count(*) FROM r) / count(*))), 6) AS weight FROM r GROUP BY surname"""


def balance_of_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words read as name or surname, and the share in which they were surnames."""
    return interpret.name_balance(mentions(spark, sf_dir)).withColumn("balance", F.round("balance", 6))


BALANCE = f"""WITH {_VILLAGE}, c AS (SELECT lower(name) AS word, 0 AS s FROM m UNION ALL SELECT lower(surname), 1 FROM m) SELECT word, count(*) AS n, round(avg(s), 6) AS balance FROM c WHERE word IS NOT NULL GROUP BY word HAVING count(*) >= 5"""


def swapped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose name and surname changed columns."""
    rows = mentions(spark, sf_dir)
    return interpret.swapped_columns(rows, interpret.name_balance(rows))


SWAPPED = f"""WITH {_VILLAGE}, c AS (SELECT lower(name) AS word, 0 AS s FROM m UNION ALL SELECT lower(surname), 1 FROM m), b AS (SELECT word, avg(s) AS b FROM c WHERE word IS NOT NULL GROUP BY word HAVING count(*) >= 5),
j AS (SELECT m.id, act, name, surname, coalesce(x.b >= 0.9 AND y.b <= 0.1, false) AS certain, coalesce(x.b <= 0.1 AND y.b >= 0.9, false) AS straight FROM m LEFT JOIN b x ON x.word = lower(name) LEFT JOIN b y ON y.word = lower(surname))
SELECT id FROM (SELECT *, count(*) FILTER (certain) OVER (PARTITION BY act) AS many FROM j) WHERE certain OR (many >= 2 AND name IS NOT NULL AND surname IS NOT NULL AND NOT straight)"""


def sexes_of_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sex of every mention: how many of each role are of which."""
    rows = mentions(spark, sf_dir)
    found = interpret.sex_of_mentions(rows, interpret.name_sexes(rows))
    return rows.select("id", "role").join(found, "id").groupBy("role", "sex").agg(F.count("*").alias("n"))


_END = "CASE WHEN {p} IN ('nicola', 'andrea', 'luca') THEN 'M' WHEN {p} LIKE '%a' THEN 'F' WHEN {p} LIKE '%o' OR {p} LIKE '%i' THEN 'M' END"
_SEX_OF = f"""sp AS (SELECT id, role, status, trade, list_filter(string_split(lower(name), ' '), lambda x: x NOT IN ('di', 'de')) AS ps FROM m),
se AS (SELECT id, role, unnest(ps) AS part, unnest(range(len(ps))) AS i FROM sp),
ss AS (SELECT part, count(*) AS n, count(*) FILTER (role IN ('father', 'groom')) / count(*) AS men FROM se WHERE role IN ('father', 'groom', 'mother', 'bride') GROUP BY part),
sd AS (SELECT se.id, se.i, CASE WHEN coalesce(n, 0) >= 3 THEN coalesce(CASE WHEN men >= 0.85 THEN 'M' WHEN 1 - men >= 0.85 THEN 'F' END, CASE WHEN i = 0 THEN {_END.format(p="se.part")} END) ELSE {_END.format(p="se.part")} END AS said FROM se LEFT JOIN ss USING (part)),
sn0 AS (SELECT id, arg_min(said, i) AS named FROM sd WHERE said IS NOT NULL GROUP BY id),
sx AS (SELECT id, role, coalesce(CASE WHEN role IN ('father', 'groom') THEN 'M' WHEN role IN ('mother', 'bride') THEN 'F' END, CASE WHEN status = 'vedova' THEN 'F' END, named, CASE WHEN trade IN ('filatrice', 'levatrice') THEN 'F' END) AS sex
FROM sp LEFT JOIN sn0 USING (id))"""
SEXES = f"WITH {_VILLAGE}, {_SEX_OF} SELECT role, sex, count(*) AS n FROM sx GROUP BY ALL"


def act_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Father, mother and spouse of the rows of births and deaths."""
    return interpret.act_families(mentions(spark, sf_dir))


_LINKS = f"""
h AS (SELECT act, max(type) AS kind, CASE WHEN count(*) FILTER (role IN ('newborn', 'deceased')) = 1 THEN max(id) FILTER (role IN ('newborn', 'deceased')) END AS subject,
  CASE WHEN count(*) FILTER (role = 'father') = 1 THEN max(id) FILTER (role = 'father') END AS f, CASE WHEN count(*) FILTER (role = 'mother') = 1 THEN max(id) FILTER (role = 'mother') END AS mo,
  CASE WHEN count(*) FILTER (role = 'spouse') = 1 THEN max(id) FILTER (role = 'spouse') END AS partner,
  count(*) FILTER (role = 'father') AS fathers
  FROM m WHERE type IN ('birth', 'death') GROUP BY act),
links AS (SELECT subject AS id, f AS father, mo AS mother, CASE WHEN kind = 'death' THEN partner END AS spouse FROM h WHERE subject IS NOT NULL
  UNION ALL SELECT f, NULL, NULL, mo FROM h WHERE f IS NOT NULL AND mo IS NOT NULL UNION ALL SELECT mo, NULL, NULL, f FROM h WHERE f IS NOT NULL AND mo IS NOT NULL
  UNION ALL SELECT partner, NULL, NULL, subject FROM h WHERE kind = 'death' AND partner IS NOT NULL AND subject IS NOT NULL)
"""
#: Every derived birth with a declarant has a father's row before it, so no declarant stands in for one here; tests have such acts.
ACT_FAMILIES = f"WITH {_VILLAGE}, {_LINKS} SELECT * FROM links"


def birth_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When the parents that births and deaths name can have been born."""
    rows = mentions(spark, sf_dir)
    return interpret.birth_windows(rows, interpret.act_families(rows))


BIRTH_WINDOWS = f"""WITH {_VILLAGE}, {_LINKS}, c AS (SELECT id, CASE WHEN role = 'newborn' THEN year WHEN age IS NOT NULL THEN year - age END AS born, CASE WHEN role = 'newborn' THEN 0 ELSE 5 END AS slack, type FROM m),
t AS (SELECT father AS parent, 75 AS oldest, c.* FROM links JOIN c USING (id) WHERE father IS NOT NULL UNION ALL SELECT mother, 55, c.* FROM links JOIN c USING (id) WHERE mother IS NOT NULL)
SELECT parent AS id, max(born - oldest - slack) AS low, min(born - 13 + slack) AS high, min(CASE WHEN type <> 'birth' THEN born END) AS bearing FROM t WHERE born IS NOT NULL GROUP BY parent"""


def bounds_of_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tightest bounds that acts put on the birth of each name and surname taken together."""
    rows = mentions(spark, sf_dir).where("surname is not null").select(F.concat_ws(" ", "name", "surname").alias("person"), "role", "year", F.lit(False).alias("at_least"))
    return interpret.role_bounds(rows)


ROLE_BOUNDS = f"""WITH {_VILLAGE}, b AS (SELECT name || ' ' || surname AS person, role, year, year - CASE WHEN role IN ('newborn', 'deceased') THEN 0 WHEN role IN ('witness', 'declarant') THEN 21 ELSE 13 END AS high FROM m WHERE surname IS NOT NULL)
SELECT person, max(year) - 105 AS low, arg_max(role || ' ' || year, (year, role)) AS low_by, min(high) AS high, arg_min(role || ' ' || year, (high, role, year)) AS high_by FROM b GROUP BY person"""


def surnames_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surnames that the act gives to rows without one."""
    rows = mentions(spark, sf_dir)
    return interpret.inferred_surnames(rows, interpret.act_families(rows))


SURNAMES_INFERRED = f"""WITH {_VILLAGE}, {_LINKS}, b AS (SELECT * FROM m WHERE surname IS NULL), d AS (SELECT act, min(surname) AS found FROM m WHERE role = 'declarant' AND type = 'birth' AND surname IS NOT NULL GROUP BY act HAVING count(*) = 1),
a AS (SELECT b.id, o.surname AS found, 'father' AS origin, 0 AS r FROM b JOIN links l ON l.id = b.id JOIN m o ON o.id = l.father WHERE o.surname IS NOT NULL
  UNION ALL SELECT b.id, o.surname, 'child', 1 FROM b JOIN links l ON l.father = b.id JOIN m o ON o.id = l.id WHERE o.surname IS NOT NULL
  UNION ALL SELECT b.id, found, 'declarant', 2 FROM b JOIN d USING (act) WHERE role = 'newborn')
SELECT id, arg_min(found, (r, found)) AS surname, arg_min(origin, (r, found)) AS origin FROM a GROUP BY id"""


def confirmed_houses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Houses that child and father were both read with: how many of each."""
    rows = mentions(spark, sf_dir)
    return interpret.confirmed_houses(rows, interpret.act_families(rows)).groupBy("house").agg(F.count("*").alias("n"))


CONFIRMED_HOUSES = f"""WITH {_VILLAGE}, {_LINKS}, r AS (SELECT id, {_canonical_sql("surname")} AS house FROM m WHERE surname IS NOT NULL)
SELECT a.house, count(*) AS n FROM links l JOIN r a ON a.id = l.id JOIN r b ON b.id = l.father WHERE a.house = b.house GROUP BY a.house"""


def neighbour_acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The act before and after each act in its register."""
    return interpret.neighbour_acts(mentions(spark, sf_dir).select("act", "register", "page").distinct())


NEIGHBOUR_ACTS = f"""WITH {_VILLAGE} SELECT act, lag(act) OVER w AS before, lead(act) OVER w AS after FROM (SELECT DISTINCT act, register, page FROM m) WINDOW w AS (PARTITION BY register ORDER BY page, act)"""


def copied_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acts for which the surnames of the act before, proposed for them, stand in a neighbour and not in themselves."""
    rows = mentions(spark, sf_dir)
    acts = rows.select("act", "register", "page").distinct()
    before = interpret.neighbour_acts(acts).where("before is not null")
    proposals = before.join(rows.where("surname is not null").select(F.col("act").alias("before"), F.col("surname").alias("value")), "before").select("act", "value")
    return interpret.copied_from_neighbours(proposals, rows, acts)


COPIED = f"""WITH {_VILLAGE}, n AS (SELECT act, lag(act) OVER w AS before, lead(act) OVER w AS after FROM (SELECT DISTINCT act, register, page FROM m) WINDOW w AS (PARTITION BY register ORDER BY page, act)),
held AS (SELECT DISTINCT act, value FROM (SELECT act, name AS value FROM m UNION ALL SELECT act, surname FROM m) WHERE value IS NOT NULL),
p AS (SELECT DISTINCT n.act, surname AS value FROM n JOIN m ON m.act = n.before WHERE surname IS NOT NULL)
SELECT act, count(*) AS copied FROM p WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.act = p.act AND h.value = p.value) GROUP BY act HAVING count(*) >= 2"""


def strength_of_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well each mention is placed: how many of each kind of act."""
    rows = mentions(spark, sf_dir)
    return interpret.strength(rows, interpret.act_families(rows)).join(rows.select("id", "type"), "id").groupBy("type", "strength").agg(F.count("*").alias("n"))


STRENGTH = f"""WITH {_VILLAGE}, {_LINKS}, l AS (SELECT id, max(father) AS f, max(mother) AS mo, max(spouse) AS s FROM links GROUP BY id)
SELECT type, CASE WHEN f IS NOT NULL AND mo IS NOT NULL THEN 0 WHEN f IS NOT NULL OR mo IS NOT NULL THEN 1 WHEN s IS NOT NULL THEN 2 WHEN age IS NOT NULL THEN 3 ELSE 4 END AS strength, count(*) AS n FROM m LEFT JOIN l USING (id) GROUP BY ALL"""


def parent_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each act with the names of its one father and one mother."""
    return interpret.single_parent_columns(mentions(spark, sf_dir))


PARENT_COLUMNS = f"""WITH {_VILLAGE} SELECT act, CASE WHEN count(*) FILTER (role = 'father') = 1 THEN max(trim(name || coalesce(' ' || surname, ''))) FILTER (role = 'father') END AS father_name,
  CASE WHEN count(*) FILTER (role = 'mother') = 1 THEN max(trim(name || coalesce(' ' || surname, ''))) FILTER (role = 'mother') END AS mother_name FROM m GROUP BY act"""


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``kind, key, id`` of all kinds of block of the principals of acts."""
    rows = materialise(mentions(spark, sf_dir).select("id", "act", "type", "role", "name", "surname", "trade", "status"), "village")  # read six times
    links = interpret.act_families(rows)
    people = rows.select("id", canonical(F.col("surname")).alias("house"), name_parts(F.col("name")).alias("parts"), F.lower("trade").alias("office"), F.lit(None).cast("string").alias("patronymic"))
    kin = links.select("id", F.explode(F.array(F.struct(F.lit("father").alias("kind"), F.col("father").alias("other")), F.struct(F.lit("mother").alias("kind"), F.col("mother").alias("other")))).alias("k")).select("id", "k.kind", "k.other")
    named = lambda who: rows.select(F.col("id").alias(who), F.col("name").alias(f"{who}_name"))
    couples = links.where("father is not null and mother is not null").join(named("father"), "father").join(named("mother"), "mother")
    kinds = {"name": blocking.by_name(people), "kin": blocking.by_kin(kin), "couple": blocking.by_couple(couples), "office": blocking.by_office(people.where("office = 'notaio'"))}
    out = None
    for kind, blocks in kinds.items():
        one = blocks.select(F.lit(kind).alias("kind"), "key", "id")
        out = one if out is None else out.unionByName(one)
    return out


def block_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of candidates by kind: how many, how many pairs they hold, and how many are crowded."""
    sizes = _blocks(spark, sf_dir).groupBy("kind", "key").agg(F.count("*").alias("size"))
    return sizes.groupBy("kind").agg(F.count("*").alias("blocks"), F.sum(F.expr("size * (size - 1) div 2")).alias("pairs"), F.max("size").alias("largest"), F.count_if(F.col("size") >= 400).alias("crowded"))


BLOCK_SIZES = f"""WITH {_VILLAGE}, {_LINKS}, p AS (SELECT id, {_canonical_sql("surname")} AS house, list_filter(string_split(lower(name), ' '), lambda x: x NOT IN ('di', 'de')) AS parts, trade FROM m),
b AS (SELECT DISTINCT 'name' AS kind, house || '|' || unnest(parts) AS key, id FROM p WHERE house IS NOT NULL
  UNION ALL SELECT DISTINCT 'kin', 'f|' || father, id FROM links WHERE father IS NOT NULL UNION ALL SELECT DISTINCT 'kin', 'm|' || mother, id FROM links WHERE mother IS NOT NULL
  UNION ALL SELECT DISTINCT 'couple', w || '|' || string_split(lower(f.name), ' ')[1] || '+' || string_split(lower(o.name), ' ')[1], CASE w WHEN 'f' THEN f.id ELSE o.id END FROM links l JOIN m f ON f.id = l.father JOIN m o ON o.id = l.mother, (VALUES ('f'), ('m')) t(w)
  UNION ALL SELECT DISTINCT 'office', unnest(parts), id FROM p WHERE trade = 'notaio'),
s AS (SELECT kind, key, count(*) AS size FROM b GROUP BY ALL)
SELECT kind, count(*) AS blocks, CAST(sum(size * (size - 1) // 2) AS BIGINT) AS pairs, max(size) AS largest, count(*) FILTER (size >= 400) AS crowded FROM s GROUP BY kind"""


QUERIES = {
    "frequencies": (frequencies, FREQUENCIES),
    "decade_subset": (decade_subset, DECADE_SUBSET),
    "balance_of_words": (balance_of_words, BALANCE),
    "swapped_rows": (swapped_rows, SWAPPED),
    "sexes_of_mentions": (sexes_of_mentions, SEXES),
    "act_families": (act_families, ACT_FAMILIES),
    "birth_windows": (birth_windows, BIRTH_WINDOWS),
    "bounds_of_roles": (bounds_of_roles, ROLE_BOUNDS),
    "surnames_inferred": (surnames_inferred, SURNAMES_INFERRED),
    "confirmed_houses": (confirmed_houses, CONFIRMED_HOUSES),
    "neighbour_acts": (neighbour_acts, NEIGHBOUR_ACTS),
    "copied_proposals": (copied_proposals, COPIED),
    "strength_of_mentions": (strength_of_mentions, STRENGTH),
    "parent_columns": (parent_columns, PARENT_COLUMNS),
    "block_sizes": (block_sizes, BLOCK_SIZES),
}

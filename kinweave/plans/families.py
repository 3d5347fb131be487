"""Families, variants and entities derived from the given tables.

Customers stand for people and orders for the records that link them: keys, balances and
dates give sex, years, parents and unions, so that every check has cases to find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.functions.weights import age_gap
from kinweave.operators import graph, trees
from kinweave.operators.family import CHECKS, Family, clean_parents, clean_unions, individuals, largest_families, own_ancestor, scorecard, signed_deltas, union_edges, within_span
from kinweave.operators.family import linkage_metrics as metrics
from kinweave.operators.resolve import resolve
from kinweave.operators.similarity_join import one_edit_pairs, weighted_pairs
from kinweave.operators.variants import variant_groups, variant_targets
from kinweave.functions.text import normal
from kinweave.plans.records import words
from kinweave.plans.village import mentions, pick, pick_sql, quoted
from kinweave.session import materialise
from kinweave.sources.tables import table


#: Given names and surnames of the derived people: no two of a list are alike by .72 or share three letters at the head.
GIVEN = ("Giuseppe", "Maria", "Donato", "Lucrezia", "Vincenzo", "Serafina", "Pasquale", "Filomena", "Ambrogio", "Concetta", "Bartolomeo", "Zaira")
STEMS = ("Pelliccia", "Marzo", "Ottaviano", "Bruno", "Ferrandino", "Quaglia", "Zuccaro", "Tedesco")


def family(spark: SparkSession, sf_dir: str) -> Family:
    """People, parent edges and unions from customers and orders."""
    customers, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    key = F.col("c_custkey")
    birth = 1750 + F.pmod(F.floor("c_acctbal"), F.lit(140))
    people = customers.select(
        key.alias("id"), F.when(key % 2 == 0, "M").otherwise("F").alias("sex"), birth.alias("birth"), F.when(key % 3 != 0, birth + F.pmod(key * 37, F.lit(120)) - 5).alias("death"),
        pick(GIVEN, key).alias("name"), pick(STEMS, key * 5).alias("surname"), F.make_date(birth, F.pmod(key, F.lit(12)) + 1, F.pmod(key, F.lit(28)) + 1).alias("born"), (key % 4 != 0).alias("certain"),
    )
    n = F.broadcast(customers.agg(F.count("*").alias("n")))  # one row
    parent = F.pmod(F.col("o_orderkey") * 31, "n")
    kind = F.when((parent % 2 == 0) != (F.col("o_orderkey") % 10 == 3), "father").otherwise("mother")
    parents = orders.where("o_orderpriority like '1%'").crossJoin(n).select(F.col("o_custkey").alias("child"), parent.alias("parent"), kind.alias("kind"))
    unions = orders.where("o_orderpriority like '2%'").crossJoin(n).select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("husband"), F.pmod(F.col("o_orderkey") * 3, "n").alias("wife"), (F.year("o_orderdate") - 180).alias("year"), (F.col("o_orderkey") % 3 != 0).alias("documented")
    )
    act = F.col("o_orderkey")
    born = people.select(F.col("id").alias("o_custkey"), "birth", "sex", "name")
    year = F.col("birth") + F.pmod(act * 13, F.lit(110)) - 5
    role = F.get(F.array(F.lit("newborn"), F.lit("deceased"), F.when(F.col("sex") == "M", "groom").otherwise("bride"), F.when(F.col("sex") == "M", "father").otherwise("mother"), F.lit("witness")), F.pmod(act, F.lit(5)).cast("int"))
    mentions = orders.select("o_orderkey", "o_custkey").join(born, "o_custkey").select(
        F.col("o_custkey").alias("person"), act.alias("act"), year.alias("year"), F.lit("act").alias("type"), role.alias("role"), F.when(act % 6 != 0, F.col("name")).otherwise(pick(GIVEN, act)).alias("name"),
        pick(STEMS, F.col("o_custkey") * 5 + F.when(act % 9 < 6, act % 6).otherwise(0)).alias("surname"), F.when(act % 3 == 0, year - F.col("birth") + F.pmod(act, F.lit(25)) - 12).alias("age"),
        (act % 30 == 0).alias("at_least"), F.when(act % 7 == 0, "fu").alias("status"),
    )
    return Family(people, parents, unions, mentions)


_FAMILY = f"""
n AS (SELECT count(*) AS n FROM customer),
people AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS sex, 1750 + ((CAST(floor(c_acctbal) AS BIGINT) % 140) + 140) % 140 AS birth,
  CASE WHEN c_custkey % 3 <> 0 THEN 1750 + ((CAST(floor(c_acctbal) AS BIGINT) % 140) + 140) % 140 + (c_custkey * 37) % 120 - 5 END AS death,
  {pick_sql(GIVEN, "c_custkey")} AS name, {pick_sql(STEMS, "c_custkey * 5")} AS surname, make_date(1750 + ((CAST(floor(c_acctbal) AS BIGINT) % 140) + 140) % 140, c_custkey % 12 + 1, c_custkey % 28 + 1) AS born, c_custkey % 4 <> 0 AS certain FROM customer),
mentions AS (SELECT o_custkey AS person, o_orderkey AS act, birth + o_orderkey * 13 % 110 - 5 AS year,
  CASE o_orderkey % 5 WHEN 0 THEN 'newborn' WHEN 1 THEN 'deceased' WHEN 2 THEN CASE WHEN sex = 'M' THEN 'groom' ELSE 'bride' END WHEN 3 THEN CASE WHEN sex = 'M' THEN 'father' ELSE 'mother' END ELSE 'witness' END AS role,
  CASE WHEN o_orderkey % 6 <> 0 THEN name ELSE {pick_sql(GIVEN, "o_orderkey")} END AS name, {pick_sql(STEMS, "o_custkey * 5 + CASE WHEN o_orderkey % 9 < 6 THEN o_orderkey % 6 ELSE 0 END")} AS surname,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey * 13 % 110 - 5 + o_orderkey % 25 - 12 END AS age, o_orderkey % 30 = 0 AS at_least, CASE WHEN o_orderkey % 7 = 0 THEN 'fu' END AS status FROM orders JOIN people ON id = o_custkey),
parents AS (SELECT o_custkey AS child, (o_orderkey * 31) % n AS parent, CASE WHEN ((o_orderkey * 31) % n % 2 = 0) <> (o_orderkey % 10 = 3) THEN 'father' ELSE 'mother' END AS kind
  FROM orders, n WHERE o_orderpriority LIKE '1%'),
unions AS (SELECT o_orderkey AS id, o_custkey AS husband, (o_orderkey * 3) % n AS wife, year(o_orderdate) - 180 AS year, o_orderkey % 3 <> 0 AS documented FROM orders, n WHERE o_orderpriority LIKE '2%'),
linked AS (SELECT p.*, c.birth AS child_birth, q.birth AS parent_birth, q.death AS parent_death, q.sex AS parent_sex FROM parents p JOIN people c ON c.id = child JOIN people q ON q.id = parent),
couples AS (SELECT u.*, h.sex AS hs, h.birth AS hb, w.sex AS ws, w.birth AS wb FROM unions u JOIN people h ON h.id = husband JOIN people w ON w.id = wife),
spouses AS (SELECT husband AS id FROM unions UNION ALL SELECT wife FROM unions WHERE wife <> husband),
broods AS (SELECT DISTINCT f.parent AS father, m.parent AS mother, f.child FROM parents f JOIN parents m ON m.child = f.child AND m.kind = 'mother' WHERE f.kind = 'father')
"""


def quality_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check of the family graph against its population."""
    return scorecard(family(spark, sf_dir))


_KIN = """SELECT DISTINCT u.id FROM unions u WHERE husband <> wife AND (
  EXISTS (SELECT 1 FROM parents p WHERE p.child = husband AND p.parent = wife) OR EXISTS (SELECT 1 FROM parents p WHERE p.child = wife AND p.parent = husband)
  OR EXISTS (SELECT 1 FROM parents p JOIN parents q ON p.parent = q.parent WHERE p.child = husband AND q.child = wife))"""

_CHECK_SQL = {
    "two_fathers": "SELECT child FROM parents WHERE kind = 'father' GROUP BY child HAVING count(DISTINCT parent) > 1",
    "two_mothers": "SELECT child FROM parents WHERE kind = 'mother' GROUP BY child HAVING count(DISTINCT parent) > 1",
    "two_couples": "SELECT child FROM broods GROUP BY child HAVING count(*) > 1",
    "births_too_close": """SELECT parent FROM (SELECT parent, born - lag(born) OVER (PARTITION BY parent ORDER BY born) AS gap FROM (
      SELECT DISTINCT parent, c.born FROM parents JOIN people m ON m.id = parent AND m.sex = 'F' JOIN people c ON c.id = child AND c.certain WHERE kind = 'mother')) WHERE gap < 250""",
    "parent_too_young": "SELECT child FROM linked WHERE child_birth - parent_birth < 13",
    "parent_too_old": "SELECT child FROM linked WHERE child_birth - parent_birth > CASE WHEN kind = 'mother' THEN 52 ELSE 78 END",
    "bearing_span": "SELECT parent FROM linked WHERE kind = 'mother' GROUP BY parent HAVING max(child_birth) - min(child_birth) > 35",
    "born_after_death": "SELECT child FROM linked WHERE child_birth > parent_death + CASE WHEN kind = 'father' THEN 1 ELSE 0 END",
    "acts_after_death": "SELECT person FROM mentions JOIN people ON id = person WHERE role NOT IN ('newborn', 'deceased') AND coalesce(status, '') NOT ILIKE '%fu%' AND year > death",
    "two_deaths": "SELECT person FROM mentions WHERE role = 'deceased' GROUP BY person HAVING count(DISTINCT year) > 1",
    "two_births": "SELECT person FROM mentions WHERE role = 'newborn' GROUP BY person HAVING count(DISTINCT year) > 1",
    "death_before_birth": "SELECT id FROM people WHERE death < birth",
    "too_long_a_life": "SELECT id FROM people WHERE death - birth > 105",
    "close_kin": _KIN,
    "married_to_self": "SELECT id FROM unions WHERE husband = wife",
    "same_sex_union": "SELECT id FROM couples WHERE hs = ws",
    "written_twice": "SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY least(husband, wife), greatest(husband, wife) ORDER BY id) AS n FROM unions) WHERE n > 1",
    "marrying_age": "SELECT id FROM couples WHERE documented AND (year - hb NOT BETWEEN 13 AND 75 OR year - wb NOT BETWEEN 13 AND 75)",
    "own_ancestor": "SELECT DISTINCT child FROM reach WHERE child = parent",
    "duplicate_spouses": """SELECT x.id FROM (SELECT id, s, min(year) AS year FROM (SELECT husband AS id, wife AS s, year FROM unions UNION ALL SELECT wife, husband, year FROM unions) GROUP BY id, s) x
      JOIN (SELECT id, s, min(year) AS year FROM (SELECT husband AS id, wife AS s, year FROM unions UNION ALL SELECT wife, husband, year FROM unions) GROUP BY id, s) y ON x.id = y.id AND x.s < y.s
      JOIN people p ON p.id = x.s JOIN people q ON q.id = y.s WHERE p.name = q.name AND p.surname = q.surname AND coalesce(p.death > y.year, true) AND coalesce(q.death > x.year, true)""",
    "same_birth_homonyms": """SELECT min(g.id) FROM (SELECT *, EXISTS (SELECT 1 FROM parents r WHERE r.child = id AND r.parent IN (SELECT id FROM people)) AS known,
      EXISTS (SELECT 1 FROM people o JOIN parents s ON s.child = o.id JOIN people sp ON sp.id = s.parent JOIN parents t ON t.child = p.id JOIN people tp ON tp.id = t.parent
        WHERE o.certain AND o.id <> p.id AND o.name = p.name AND o.surname = p.surname AND o.birth = p.birth AND sp.name = tp.name AND sp.surname = tp.surname) AS shared
      FROM people p WHERE certain) g GROUP BY name, surname, birth HAVING count(*) > 1 AND (bool_or(NOT known) OR bool_or(shared))""",
    "twin_couples": """SELECT least(x.father, y.father) FROM spans x JOIN spans y ON (x.father < y.father OR (x.father = y.father AND x.mother < y.mother)) AND x.fn = y.fn AND x.fs = y.fs AND x.mn = y.mn AND x.ms = y.ms
      WHERE greatest(x.last, y.last) - least(x.first, y.first) <= 35
      AND NOT (x.fc AND least(x.first, y.first) < x.fb + 13) AND NOT (x.mc AND least(x.first, y.first) < x.mb + 13) AND NOT (y.fc AND least(x.first, y.first) < y.fb + 13) AND NOT (y.mc AND least(x.first, y.first) < y.mb + 13)
      AND coalesce(y.last <= x.fd + 1, true) AND coalesce(y.last <= x.md + 1, true) AND coalesce(x.last <= y.fd + 1, true) AND coalesce(x.last <= y.md + 1, true)
      AND (x.father = y.father OR (coalesce(x.fd = y.fd, true) AND NOT (x.fc AND y.fc AND x.fb <> y.fb))) AND (x.mother = y.mother OR (coalesce(x.md = y.md, true) AND NOT (x.mc AND y.mc AND x.mb <> y.mb)))
      AND NOT coalesce(x.father <> y.father AND x.house <> y.house AND least(x.most, y.most) >= 3 AND NOT list_contains(x.names, y.house) AND NOT list_contains(y.names, x.house), false)""",
    "living_same_name_siblings": """SELECT child FROM (SELECT b.child, p.birth, lag(b.child) OVER w AS twin, lag(p.death) OVER w AS td, lag(s.seen) OVER w AS ts, lag(g.given) OVER w AS tg, g.given
      FROM broods b JOIN people p ON p.id = b.child LEFT JOIN (SELECT person, max(year) AS seen FROM mentions GROUP BY person) s ON s.person = b.child
      LEFT JOIN (SELECT person, list(DISTINCT name) AS given FROM mentions WHERE role = 'newborn' GROUP BY person) g ON g.person = b.child
      WINDOW w AS (PARTITION BY father, mother, p.name ORDER BY p.birth NULLS FIRST, b.child))
      WHERE twin IS NOT NULL AND td IS NULL AND coalesce(ts, 0) > birth AND coalesce(list_has_any(tg, given), true)""",
    "many_spouses": "SELECT id FROM spouses GROUP BY id HAVING count(*) > 2",
    "irreconcilable_surnames": "SELECT person FROM mentions GROUP BY person HAVING count(DISTINCT surname) > 4 AND coalesce((SELECT count(*) FROM spouses s WHERE s.id = person), 0) <> 1",
    "age_against_birth": "SELECT person FROM mentions JOIN people ON id = person WHERE certain AND age IS NOT NULL AND NOT at_least AND abs(year - age - birth) > 10",
}
_SIZES = {
    "spouses": "SELECT DISTINCT id FROM spouses", "several mentions": "SELECT person FROM mentions GROUP BY person HAVING count(*) > 1",
    "children with a father": "SELECT DISTINCT child FROM parents WHERE kind = 'father'", "children with a mother": "SELECT DISTINCT child FROM parents WHERE kind = 'mother'",
    "children with both": "SELECT DISTINCT child FROM broods", "mothers of several": "SELECT parent FROM parents WHERE kind = 'mother' GROUP BY parent HAVING count(DISTINCT child) > 1",
    "links with both births": "SELECT 1 FROM linked WHERE child_birth IS NOT NULL AND parent_birth IS NOT NULL", "links with parent's birth": "SELECT 1 FROM linked WHERE parent_birth IS NOT NULL",
    "links with parent's death": "SELECT 1 FROM linked WHERE parent_death IS NOT NULL", "mentions of the dead": "SELECT 1 FROM mentions JOIN people ON id = person WHERE death IS NOT NULL",
    "dead": "SELECT 1 FROM people WHERE death IS NOT NULL", "certain births": "SELECT 1 FROM people WHERE certain", "both years known": "SELECT 1 FROM people WHERE death IS NOT NULL",
    "unions": "SELECT 1 FROM unions", "documented unions": "SELECT 1 FROM unions WHERE documented", "children": "SELECT DISTINCT child FROM parents", "several unions": "SELECT id FROM spouses GROUP BY id HAVING count(*) > 1",
    "couples with children": "SELECT DISTINCT father, mother FROM broods", "ages of certain births": "SELECT 1 FROM mentions JOIN people ON id = person WHERE certain AND age IS NOT NULL", "people": "SELECT 1 FROM people",
}
_SCORED = f"""WITH RECURSIVE {_FAMILY}, reach(child, parent) AS (SELECT DISTINCT child, parent FROM parents UNION SELECT r.child, p.parent FROM reach r JOIN parents p ON p.child = r.parent),
houses AS (SELECT person, arg_max(surname, (n, surname)) AS house, max(n) AS most, list(surname) AS names FROM (SELECT person, surname, count(*) AS n FROM mentions GROUP BY ALL) GROUP BY person),
spans AS (SELECT b.*, f.name AS fn, f.surname AS fs, f.birth AS fb, f.death AS fd, f.certain AS fc, m.name AS mn, m.surname AS ms, m.birth AS mb, m.death AS md, m.certain AS mc, house, most, names
  FROM (SELECT father, mother, min(birth) AS first, max(birth) AS last FROM broods JOIN people ON id = child GROUP BY ALL) b JOIN people f ON f.id = father JOIN people m ON m.id = mother LEFT JOIN houses ON person = father)
"""

QUALITY_SCORECARD = _SCORED + " UNION ALL ".join(
    f"SELECT '{name}' AS \"check\", '{category}' AS category, (SELECT count(*) FROM ({_CHECK_SQL[name]})) AS found, {quoted(of)} AS population, (SELECT count(*) FROM ({_SIZES[of]})) AS size" for name, (category, _, of) in CHECKS.items()
)


def linkage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve figures of a linkage."""
    return metrics(family(spark, sf_dir))


LINKAGE_METRICS = f"""WITH {_FAMILY}, s AS (SELECT p.*, m.n, m.last FROM people p LEFT JOIN (SELECT person, count(*) AS n, max(year) AS last FROM mentions GROUP BY person) m ON person = id)
SELECT 'people' AS metric, (SELECT count(*) FROM people) AS value UNION ALL SELECT 'single mention', (SELECT count(*) FROM s WHERE n = 1) UNION ALL SELECT 'with birth act', (SELECT count(*) FROM s WHERE certain)
UNION ALL SELECT 'born and seen again', (SELECT count(*) FROM s WHERE certain AND n > 1) UNION ALL SELECT 'born and seen grown', (SELECT count(*) FROM s WHERE certain AND last - birth >= 18)
UNION ALL SELECT 'born with children', (SELECT count(*) FROM s WHERE certain AND id IN (SELECT parent FROM parents)) UNION ALL SELECT 'deaths with known birth', (SELECT count(*) FROM s WHERE death IS NOT NULL AND certain)
UNION ALL SELECT 'with parents', (SELECT count(DISTINCT child) FROM parents) UNION ALL SELECT 'with children', (SELECT count(DISTINCT parent) FROM parents)
UNION ALL SELECT 'grandparent chains', (SELECT count(*) FROM parents a JOIN parents b ON b.child = a.parent) UNION ALL SELECT 'couples', (SELECT count(*) FROM (SELECT DISTINCT father, mother FROM broods))
UNION ALL SELECT 'documented couples', (SELECT count(*) FROM unions WHERE documented)
"""


def family_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forty couples with most children."""
    return largest_families(family(spark, sf_dir))


FAMILY_STATISTICS = f"""WITH {_FAMILY} SELECT father, mother, count(*) AS children, min(birth) AS first, max(birth) AS last FROM broods JOIN people ON id = child GROUP BY father, mother ORDER BY children DESC, father, mother LIMIT 40"""


PLAIN_CHECKS = {name: CHECKS[name] for name in ("two_fathers", "two_mothers", "parent_too_young", "parent_too_old", "born_after_death")}


def engine_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scorecard of the family as it was read against that of its cleaned parent edges, check by check."""
    f = family(spark, sf_dir).written()
    kept, _ = clean_parents(f)
    return signed_deltas(scorecard(Family(f.people, kept, f.unions, f.mentions), PLAIN_CHECKS), scorecard(f, PLAIN_CHECKS))


ENGINE_DELTAS = f"""WITH {_FAMILY}, j AS (SELECT *, child_birth - parent_birth AS gap FROM linked),
s AS (SELECT *, row_number() OVER (PARTITION BY child, kind ORDER BY abs(coalesce(gap, 1000) - 30), parent) AS n FROM j
  WHERE (kind = 'father') = (parent_sex = 'M') AND gap >= 13 AND gap <= CASE WHEN kind = 'mother' THEN 55 ELSE 75 END AND NOT coalesce(child_birth > parent_death + CASE WHEN kind = 'father' THEN 1 ELSE 0 END, false)),
k AS (SELECT * FROM s WHERE n = 1), d AS ("""+" UNION ALL ".join(
    f"SELECT '{name}' AS \"check\", (SELECT count(*) FROM ({sql.format(t='k')})) AS mine, (SELECT count(*) FROM ({sql.format(t='linked')})) AS other"
    for name, sql in {
        "two_fathers": "SELECT child FROM {t} WHERE kind = 'father' GROUP BY child HAVING count(DISTINCT parent) > 1", "two_mothers": "SELECT child FROM {t} WHERE kind = 'mother' GROUP BY child HAVING count(DISTINCT parent) > 1",
        "parent_too_young": "SELECT child FROM {t} WHERE child_birth - parent_birth < 13", "parent_too_old": "SELECT child FROM {t} WHERE child_birth - parent_birth > CASE WHEN kind = 'mother' THEN 52 ELSE 78 END",
        "born_after_death": "SELECT child FROM {t} WHERE child_birth > parent_death + CASE WHEN kind = 'father' THEN 1 ELSE 0 END",
    }.items()
)+""") SELECT *, 'impossible' AS category, mine - other AS delta, CASE WHEN mine < other THEN 'better' WHEN mine > other THEN 'worse' ELSE 'same' END AS verdict FROM d"""


def cleaned_unions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unions kept and dropped by the hard rules, by reason."""
    kept, out = clean_unions(family(spark, sf_dir))
    return kept.withColumn("reason", F.lit("kept")).unionByName(out).groupBy("reason").agg(F.count("*").alias("n"))


CLEANED_UNIONS = f"""WITH {_FAMILY}, t AS (SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY least(husband, wife), greatest(husband, wife) ORDER BY id) AS n FROM unions) WHERE n > 1),
r AS (SELECT CASE WHEN u.husband = u.wife THEN 'self' WHEN u.id IN ({_KIN}) THEN 'kin' WHEN hs = ws THEN 'sex' WHEN u.year - hb NOT BETWEEN 13 AND 75 OR u.year - wb NOT BETWEEN 13 AND 75 THEN 'age' WHEN u.id IN (SELECT id FROM t) THEN 'twice' ELSE 'kept' END AS reason
  FROM unions u LEFT JOIN couples c USING (id)) SELECT reason, count(*) AS n FROM r GROUP BY reason"""


def spans_of_bearing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mothers' children taken out until their births span at most 35 years: how many of each mother."""
    f = family(spark, sf_dir)
    rows = f.parents.where("kind = 'mother'").select("parent", "child").distinct().join(f.people.select(F.col("id").alias("child"), "birth"), "child")
    _, out = within_span(rows.select("parent", "birth", "child"), "parent", "birth", 35)
    return out.groupBy("parent").agg(F.count("*").alias("n"), F.sum("birth").alias("years"))


def documented_unions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Couples from unions and common children, one row each: a documented union first, the earliest year."""
    f = family(spark, sf_dir)
    children = f.broods().join(f.people.select(F.col("id").alias("child"), F.col("birth").alias("year")), "child")
    return union_edges(f.unions.where("documented"), children, f.people)


DOCUMENTED_UNIONS = f"""WITH {_FAMILY}, e AS (SELECT husband AS x, wife AS y, year, 0 AS r FROM unions WHERE documented UNION ALL SELECT father, mother, birth, 1 FROM broods JOIN people ON id = child),
t AS (SELECT CASE WHEN p.sex = 'F' THEN y ELSE x END AS husband, CASE WHEN p.sex = 'F' THEN x ELSE y END AS wife, year, r FROM e JOIN people p ON p.id = x JOIN people q ON q.id = y WHERE x <> y AND p.sex <> q.sex)
SELECT husband, wife, arg_min(year, (r, year)) AS year, CASE WHEN min(r) = 0 THEN 'marriage' ELSE 'child' END AS origin FROM t GROUP BY husband, wife"""


def individuals_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a person with the chosen surname and the years of its acts."""
    f = family(spark, sf_dir)
    return individuals(f.mentions, f.mentions.groupBy("surname").agg(F.count("*").alias("total")))


INDIVIDUALS = f"""WITH {_FAMILY}, t AS (SELECT surname, count(*) AS total FROM mentions GROUP BY surname), f AS (SELECT person, surname, count(*) AS n FROM mentions GROUP BY ALL),
c AS (SELECT person, arg_max(surname, (round(n * (1 + log10(total + 1)), 9), n, surname)) AS surname, count(*) AS forms FROM f JOIN t USING (surname) GROUP BY person)
SELECT m.person, count(*) AS mentions, min(year) AS first, max(year) AS last, min(year) FILTER (role = 'newborn') AS birth, min(year) FILTER (role = 'deceased') AS death, any_value(c.surname) AS surname, any_value(forms) AS forms
FROM mentions m JOIN c USING (person) GROUP BY m.person"""


def cleaned_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent edges kept and dropped by the hard rules, by reason."""
    kept, out = clean_parents(family(spark, sf_dir))
    return kept.withColumn("reason", F.lit("kept")).unionByName(out).groupBy("kind", "reason").agg(F.count("*").alias("n"))


CLEANED_PARENTS = f"""
WITH {_FAMILY}, j AS (SELECT *, child_birth - parent_birth AS gap FROM linked),
r AS (SELECT *, CASE WHEN (kind = 'father') <> (parent_sex = 'M') THEN 'sex' WHEN gap < 13 THEN 'too young' WHEN gap > CASE WHEN kind = 'mother' THEN 55 ELSE 75 END THEN 'too old'
  WHEN child_birth > parent_death + CASE WHEN kind = 'father' THEN 1 ELSE 0 END THEN 'dead' END AS reason FROM j),
s AS (SELECT kind, row_number() OVER (PARTITION BY child, kind ORDER BY abs(coalesce(gap, 1000) - 30), parent) AS n FROM r WHERE reason IS NULL)
SELECT kind, reason, count(*) AS n FROM (SELECT kind, reason FROM r WHERE reason IS NOT NULL UNION ALL SELECT kind, CASE WHEN n = 1 THEN 'kept' ELSE 'second' END FROM s) GROUP BY ALL
"""


def own_ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People who are their own ancestors by the parent edges as they were read."""
    f = family(spark, sf_dir)
    return own_ancestor(f)


OWN_ANCESTORS = _SCORED + "SELECT DISTINCT child AS id FROM reach WHERE child = parent"


def k_hop_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descendants of everyone within three generations of cleaned parent edges, by generation."""
    kept, _ = clean_parents(family(spark, sf_dir))
    edges = kept.select(F.col("parent").alias("a"), F.col("child").alias("b"))
    return graph.hops(edges, edges.select(F.col("a").alias("root")), 3)


K_HOP_TREE = f"""
WITH RECURSIVE {_FAMILY}, j AS (SELECT *, child_birth - parent_birth AS gap FROM linked),
s AS (SELECT child, parent, row_number() OVER (PARTITION BY child, kind ORDER BY abs(coalesce(gap, 1000) - 30), parent) AS n FROM j
  WHERE (kind = 'father') = (parent_sex = 'M') AND gap >= 13 AND gap <= CASE WHEN kind = 'mother' THEN 55 ELSE 75 END
  AND NOT coalesce(child_birth > parent_death + CASE WHEN kind = 'father' THEN 1 ELSE 0 END, false)),
e AS (SELECT DISTINCT parent AS a, child AS b FROM s WHERE n = 1),
w(root, node, depth) AS (SELECT DISTINCT a, a, 0 FROM e UNION SELECT root, b, depth + 1 FROM w JOIN e ON a = node WHERE depth < 3)
SELECT root, node, min(depth) AS depth FROM w GROUP BY ALL
"""


def family_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree of everyone with a parent or a child: four generations up and four down, other parents and spouses."""
    f = family(spark, sf_dir)
    kept = materialise(clean_parents(f)[0].select("child", "parent"), "kept-parents")
    return trees.family_tree(kept, f.unions, kept.select(F.col("parent").alias("root")).union(kept.select("child")), 4, 4).select("root", "node", "generation", "relation", F.array_join(F.col("path").cast("array<string>"), ">").alias("path"))


_KEPT = f"""{_FAMILY}, j AS (SELECT *, child_birth - parent_birth AS gap FROM linked),
s AS (SELECT child, parent, row_number() OVER (PARTITION BY child, kind ORDER BY abs(coalesce(gap, 1000) - 30), parent) AS n FROM j
  WHERE (kind = 'father') = (parent_sex = 'M') AND gap >= 13 AND gap <= CASE WHEN kind = 'mother' THEN 55 ELSE 75 END
  AND NOT coalesce(child_birth > parent_death + CASE WHEN kind = 'father' THEN 1 ELSE 0 END, false)),
e AS (SELECT DISTINCT parent, child FROM s WHERE n = 1)"""
FAMILY_TREES = f"""
WITH RECURSIVE {_KEPT}, roots AS (SELECT parent AS root FROM e UNION SELECT child FROM e),
u(root, node, depth, path) AS (SELECT root, root, 0, [root] FROM roots UNION ALL SELECT root, parent, depth + 1, list_append(path, parent) FROM u JOIN e ON child = node WHERE depth < 4),
d(root, node, depth, path) AS (SELECT root, root, 0, [root] FROM roots UNION ALL SELECT root, child, depth + 1, list_append(path, child) FROM d JOIN e ON parent = node WHERE depth < 4),
b AS (SELECT root, node, -depth AS generation, CASE depth WHEN 0 THEN 0 ELSE 1 END AS rank, path FROM u UNION ALL SELECT root, node, depth, 2, path FROM d WHERE depth > 0),
blood AS (SELECT root, node, arg_min(generation, (abs(generation), rank, path)) AS generation, arg_min(rank, (abs(generation), rank, path)) AS rank, arg_min(path, (abs(generation), rank, path)) AS path FROM b GROUP BY root, node),
c AS (SELECT root, parent AS node, generation - 1 AS generation, 3 AS rank, list_append(path, parent) AS path FROM blood JOIN e ON child = node WHERE generation > 0 AND NOT EXISTS (SELECT 1 FROM blood o WHERE o.root = blood.root AND o.node = parent)),
p AS (SELECT * FROM blood UNION ALL SELECT root, node, arg_min(generation, (abs(generation), path)), 3, arg_min(path, (abs(generation), path)) FROM c GROUP BY root, node),
sides AS (SELECT husband AS a, wife AS b FROM unions WHERE husband <> wife UNION SELECT wife, husband FROM unions WHERE husband <> wife),
w AS (SELECT root, b AS node, generation, list_append(path, b) AS path FROM p JOIN sides ON a = node WHERE NOT EXISTS (SELECT 1 FROM p o WHERE o.root = p.root AND o.node = b)),
everyone AS (SELECT * FROM p UNION ALL SELECT root, node, arg_min(generation, (abs(generation), path)), 4, arg_min(path, (abs(generation), path)) FROM w GROUP BY root, node)
SELECT root, node, generation, ['root', 'ancestor', 'descendant', 'co-parent', 'spouse'][rank + 1] AS relation, array_to_string(path, '>') AS path FROM everyone
"""


def children_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The children of everyone by birth, or by the year of their first act where a birth is not certain."""
    f = family(spark, sf_dir)
    first = f.mentions.groupBy(F.col("person").alias("id")).agg(F.min("year").alias("first"))
    return trees.children_in_order(f.parents, f.people.select("id", F.when(F.col("certain"), F.col("birth")).alias("birth")).join(first, "id", "left"))


CHILDREN_IN_ORDER = f"""
WITH {_FAMILY}, l AS (SELECT DISTINCT child, parent FROM parents), y AS (SELECT p.id, coalesce(CASE WHEN certain THEN birth END, (SELECT min(year) FROM mentions m WHERE m.person = p.id)) AS year FROM people p)
SELECT parent, child, row_number() OVER (PARTITION BY parent ORDER BY year NULLS LAST, child) AS place, (SELECT min(o.parent) FROM l o WHERE o.child = l.child AND o.parent <> l.parent) AS other FROM l LEFT JOIN y ON y.id = child
"""


def _forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``form, n`` of all words of the documents, written down once: the variants ask for them several times."""
    counted = words(table(spark, sf_dir, "documents")).groupBy(F.col("word").alias("form")).agg(F.count("*").alias("n"))
    return materialise(counted, "forms")


def weighted_edit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similar pairs among all surnames that the acts derived from the order lines write, by weighted edit distance."""
    forms = mentions(spark, sf_dir).select("surname").distinct().select(F.regexp_replace(normal(F.col("surname")), " ", "").alias("form"))
    return weighted_pairs(forms, 0.8).withColumn("similarity", F.round("similarity", 6))


def variant_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of attested words joined by single edits or one canonical form."""
    forms = _forms(spark, sf_dir)
    return variant_groups(forms, one_edit_pairs(forms))


def variant_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each attested word, the word it is a spelling of, chains followed to their end."""
    forms = _forms(spark, sf_dir)
    pairs = one_edit_pairs(forms).withColumn("similarity", 1 - 1 / F.greatest(F.length("a"), F.length("b")))
    found = variant_targets(forms, pairs).where("accepted").select(F.col("form").alias("source"), "target")
    return graph.resolve_chains(found)


def resolved_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers merged into entities by segment, nation and balance, in rounds of mutually best pairs."""
    mentions = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("mention"), "c_nationkey", "c_mktsegment", "c_acctbal")

    def describe(held: DataFrame) -> DataFrame:
        return held.groupBy("entity").agg(
            F.min("c_nationkey").alias("nation"), F.max("c_nationkey").alias("nation2"), F.min("c_mktsegment").alias("segment"), F.max("c_mktsegment").alias("segment2"),
            F.min("c_acctbal").alias("low"), F.max("c_acctbal").alias("high"),
        )

    def score(entities: DataFrame) -> DataFrame:
        # Neighbouring balance bands of one nation and segment meet; a band is as wide as the widest gap.
        band = F.floor(F.col("low") / 60)
        one = entities.where("nation = nation2 and segment = segment2").withColumn("band", band)
        left = one.select(F.col("entity").alias("a"), "nation", "segment", F.col("low").alias("la"), F.col("high").alias("ha"), F.col("band").alias("own"), F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"))
        right = one.select(F.col("entity").alias("b"), "nation", "segment", "band", F.col("low").alias("lb"), F.col("high").alias("hb"))
        # Two of one band meet once, and two of neighbouring bands once: no pair is there twice, none is shuffled.
        pairs = left.hint("merge").join(right, ["nation", "segment", "band"]).where("(a < b or (a <> b and own <> band)) and greatest(ha, hb) - least(la, lb) <= 60")
        gap = F.abs((F.col("la") + F.col("ha")) / 2 - (F.col("lb") + F.col("hb")) / 2)
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.round(age_gap(gap / 10), 9).alias("logit"))

    entities, log = resolve(mentions, describe, score, threshold=-0.9, margin=0.0)
    merged = log.select(F.col("merged").alias("mention"), "round", "logit")
    return entities.join(merged, "mention", "left").select("mention", "entity", F.coalesce("round", F.lit(0)).alias("round"), "logit")


QUERIES = {
    "quality_scorecard": (quality_scorecard, QUALITY_SCORECARD),
    "linkage_metrics": (linkage_metrics, LINKAGE_METRICS),
    "family_statistics": (family_statistics, FAMILY_STATISTICS),
    "engine_deltas": (engine_deltas, ENGINE_DELTAS),
    "cleaned_unions": (cleaned_unions, CLEANED_UNIONS),
    "spans_of_bearing": (spans_of_bearing, None),
    "documented_unions": (documented_unions, DOCUMENTED_UNIONS),
    "individuals_of": (individuals_of, INDIVIDUALS),
    "cleaned_parents": (cleaned_parents, CLEANED_PARENTS),
    "own_ancestors": (own_ancestors, OWN_ANCESTORS),
    "k_hop_tree": (k_hop_tree, K_HOP_TREE),
    "family_trees": (family_trees, FAMILY_TREES),
    "children_in_order": (children_in_order, CHILDREN_IN_ORDER),
    "weighted_edit": (weighted_edit, None),
    "variant_components": (variant_components, None),
    "variant_corrections": (variant_corrections, None),
    "resolved_customers": (resolved_customers, None),
}

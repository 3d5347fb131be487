"""Text of records: normal forms, doubtful readings, alternatives, names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Latin letters with marks and the plain letters they stand for.
MARKED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"

#: Name prefixes that count as one letter, in the order they are tried.
PREFIXES = ("di", "de", "lo", "la", "del", "della", "dello")

#: Particles that are not parts of a name.
PARTICLES = ("di", "de", "del", "della", "dello", "d", "da", "e", "fu", "detto", "detta")


def normal(text: Column) -> Column:
    """Lower case without marks (Latin letters), apostrophes and hyphens as spaces, single spaces."""
    plain = F.translate(F.lower(text), MARKED, PLAIN)
    return F.trim(F.regexp_replace(plain, r"['`’\-\s]+", " "))


def canonical(text: Column) -> Column:
    """The form that spellings of one surname share: prefix as one letter, no spaces, no doubled letters."""
    whole = normal(text)
    out = F.when(F.lit(False), whole)
    for p in PREFIXES:  # standing apart it counts whatever follows; written as one, from three letters on
        rest = F.substring(whole, len(p) + 1, 10_000)
        out = out.when(whole.startswith(p + " ") | (whole.startswith(p) & (F.char_length(whole) > len(p) + 2)), F.concat(F.lit(p[0]), rest))
    return F.regexp_replace(F.regexp_replace(out.otherwise(whole), " ", ""), r"(.)\1+", "$1")


def doubtful(text: Column) -> Column:
    """``struct(value, uncertain)``: marks of doubt taken out; an empty value is null."""
    marks = F.regexp_replace(text, r"\[\?\]|\(\?\)", "")
    bare = F.trim(F.regexp_replace(F.trim(marks), r"[?\s]+$", ""))
    unsure = text.rlike(r"\[\?\]|\(\?\)|\?\s*$|\[[^\]]*\]")
    return F.struct(F.nullif(bare, F.lit("")).alias("value"), F.coalesce(unsure, F.lit(False)).alias("uncertain"))


def alternatives(text: Column) -> Column:
    """``struct(main, others)`` of ``X [A/B]``, ``X [o Y]``, ``A / B`` and of letters supplied, ``B[e]r[t]i``."""
    supplied = text.rlike(r"\p{L}\[\p{L}+\]|\[\p{L}+\]\p{L}")
    inside = F.regexp_extract(text, r"\[(?:o\s+)?([^\]?]+)\]", 1)
    main = F.trim(F.regexp_replace(text, r"\s*\[[^\]]*\]", ""))
    listed = lambda c: F.filter(F.transform(F.split(c, r"\s*/\s*"), lambda x: F.trim(x)), lambda x: x != "")
    slashed = listed(text)
    whole, bare = F.regexp_replace(text, r"[\[\]]", ""), F.regexp_replace(text, r"\[[^\]]*\]", "")
    two = ~text.contains("[") & (F.size(slashed) > 1)
    main = F.when(supplied, whole).when(two, F.get(slashed, F.lit(0))).otherwise(main)
    others = F.when(supplied, F.array(bare)).when(two, F.slice(slashed, 2, F.size(slashed))).otherwise(listed(inside))
    return F.struct(F.nullif(main, F.lit("")).alias("main"), F.array_distinct(others).alias("others"))


def patronymic(text: Column) -> Column:
    """``struct(name, father)`` of "Giuseppe di Carmine"; a surname that begins with Di is left alone."""
    pattern = r"^(\p{L}{3,}(?: \p{L}{3,})*) di (\p{Lu}\p{L}{2,})$"
    found = F.regexp_extract(text, pattern, 1)
    return F.struct(
        F.when(found != "", found).otherwise(text).alias("name"),
        F.nullif(F.regexp_extract(text, pattern, 2), F.lit("")).alias("father"),
    )


def late(text: Column) -> Column:
    """``struct(name, dead)`` of "fu Margherita"."""
    dead = text.rlike(r"(?i)^fu\s+\p{L}")
    return F.struct(F.when(dead, F.regexp_replace(text, r"(?i)^fu\s+", "")).otherwise(text).alias("name"), F.coalesce(dead, F.lit(False)).alias("dead"))


def name_parts(text: Column) -> Column:
    """The parts of a name in normal form, punctuation stripped, particles left out."""
    parts = F.split(F.regexp_replace(normal(text), r"[.,;:]", ""), " ")
    return F.filter(parts, lambda p: (p != "") & ~p.isin(*PARTICLES))


def first_year(text: Column) -> Column:
    """The first year 1700..1999 in a text, or null."""
    return F.nullif(F.regexp_extract(text, r"\b(1[78]\d{2}|19\d{2})\b", 1), F.lit("")).cast("int")


def first_present(*columns: Column) -> Column:
    """The first value that is neither null nor blank."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in columns])


#: A form proposed in a note, and the ways in which a note sets two of them side by side.
NOTED_FORM = r"[A-Z][A-Za-zàèéìòù'’\[\]?. ]{2,24}"
NOTED_PAIRS = (rf"\(({NOTED_FORM})\s*/\s*({NOTED_FORM})\)", rf"'({NOTED_FORM})'\s*[,/]?\s*'({NOTED_FORM})'", rf"\b({NOTED_FORM})\s*/\s*({NOTED_FORM})\b")


def note_alternatives(note: Column) -> Column:
    """The forms a note sets side by side, both of each pair, by the first way of writing them that it uses; empty for none.

    "(Tommolilli / Iemminilli)", then "'Pope', 'Popa'", then "Iorzo[?] / Iorio"; marks of doubt are taken off.
    """
    text = F.coalesce(note, F.lit(""))
    clean = lambda x: F.regexp_replace(doubtful(x)["value"], r"^[ '’.]+|[ '’.]+$", "")

    def pairs(way: str) -> Column:
        both = F.arrays_zip(F.regexp_extract_all(text, F.lit(way), F.lit(1)).alias("x"), F.regexp_extract_all(text, F.lit(way), F.lit(2)).alias("y"))
        forms = F.transform(F.flatten(F.transform(both, lambda p: F.array(p["x"], p["y"]))), clean)
        return F.array_distinct(F.filter(forms, lambda x: x.isNotNull() & (x != "")))

    first, second, third = map(pairs, NOTED_PAIRS)
    return F.when(F.size(first) > 0, first).when(F.size(second) > 0, second).otherwise(third)


#: A father's name behind a surname, the share up to which it counts as a given name, the least length of what stays.
FILIATION = r"^(.+?)\s+(?:fu|di|de|d')\s+(\p{Lu}[\p{L}\p{N}_'’]+(?:\s+\p{Lu}[\p{L}\p{N}_'’]+)?)\s*$"
SHARE_OF_A_NAME = 0.35
LEAST_SURNAME = 3


def filiation_tail(surname: Column) -> Column:
    """What stands behind "fu" or "di" in a surname, or null: the word whose balance :func:`filiation` asks for."""
    return F.nullif(F.regexp_extract(F.trim(surname), FILIATION, 2), F.lit(""))


def filiation(surname: Column, balance: Column) -> Column:
    """``struct(surname, father)`` of "Lella fu Michele": what follows is a father if the corpus seldom reads it as a surname.

    ``balance`` is that share for :func:`filiation_tail`. A word the corpus does not know
    (null) is left alone, and so is a surname that would keep less than three letters.
    """
    head = F.trim(F.regexp_extract(F.trim(surname), FILIATION, 1))
    hit = filiation_tail(surname).isNotNull() & (F.char_length(head) >= LEAST_SURNAME) & F.coalesce(balance <= SHARE_OF_A_NAME, F.lit(False))
    return F.struct(F.when(hit, head).otherwise(surname).alias("surname"), F.when(hit, filiation_tail(surname)).alias("father"))


#: Titles before a name, and what a clerk's explanation behind a name says.
TITLES = r"(?i)^(?:donna|don|signora|signor|sigr?a?\.?)\s+"
APPOSITIONS = r"(?i)\s+(sua\s+moglie|suo\s+marito|sua\s+madre|suo\s+padre|sua\s+figlia|suo\s+figlio|defunt[oa]|vedov[oa]|nubile|celibe|coniugat[oa]|\[sic\])\s*$"
STATES = ("defunto", "defunta", "vedovo", "vedova", "nubile", "celibe", "coniugato", "coniugata")


def untitled(name: Column) -> Column:
    """``struct(name, title)``: a title before the name taken off, as it was written."""
    text = F.trim(name)
    title = F.nullif(F.trim(F.regexp_extract(text, TITLES, 0)), F.lit(""))
    return F.struct(F.when(title.isNull(), name).otherwise(F.nullif(F.trim(F.regexp_replace(text, TITLES, "")), F.lit(""))).alias("name"), title.alias("title"))


def apposition(name: Column) -> Column:
    """``struct(name, status)`` of "Felice sua moglie", "d'Ettorre defunta": what a clerk explains at the end taken off, a state of life kept."""
    said = F.lower(F.regexp_extract(name, APPOSITIONS, 1))
    return F.struct(F.when(said == "", name).otherwise(F.nullif(F.trim(F.regexp_replace(name, APPOSITIONS, "")), F.lit(""))).alias("name"), F.when(said.isin(*STATES), said).alias("status"))


#: Words that open the name of a place within a town, and words that say nothing in it.
PLACE_WORDS = ("strada", "via", "rua", "contrada", "porta", "piazza", "piano", "lama", "vico", "largo")
EMPTY_WORDS = (
    "strada", "via", "della", "delle", "dello", "degli", "del", "di", "da", "la", "il", "lo", "le", "li", "a", "al", "alla", "in", "vicino", "sotto", "sopra", "dinanzi", "davanti", "avanti", "piedi", "capo", "cima", "fuori",
    "questa", "questo", "detta", "detto", "comune", "sudetta", "suddetta", "medesima", "istessa", "nella", "nel", "e", "ed", "che",
)


def place_core(text: Column) -> Column:
    """The words that tell one place of a town from another: from the opening word to the next comma, at most 40 characters, empty words left out."""
    found = F.regexp_extract(text, r"(?i)\b(?:" + "|".join(PLACE_WORDS) + r")\b[\s\p{L}\p{N}_'’\[\]?.]{0,40}", 0)
    words = F.filter(F.split(normal(F.coalesce(doubtful(found)["value"], F.lit(""))), r"[\s.]+"), lambda w: (w != "") & ~w.isin(*EMPTY_WORDS))
    return F.nullif(F.array_join(words, " "), F.lit(""))


def town_and_rest(place: Column, town: str) -> Column:
    """``struct(town, rest)``: the town only where it stands at the head of a place."""
    n = len(town.split())
    trimmed = F.trim(place)
    words = F.split(trimmed, r"\s+")
    head = F.regexp_replace(normal(F.array_join(F.slice(words, 1, n), " ")), r"[,;:.–—]", "")
    at_head = F.trim(head) == F.lit(town.lower())
    rest = F.trim(F.regexp_replace(F.array_join(F.slice(words, n + 1, F.greatest(F.size(words) - n, F.lit(0))), " "), r"^\s*[,;:\-–—]\s*|\s*[,;:]\s*$", ""))
    return F.struct(F.when(at_head, F.lit(town)).alias("town"), F.nullif(F.when(at_head, rest).otherwise(trimmed), F.lit("")).alias("rest"))


def street(place: Column, town: str) -> Column:
    """The part of a place that says where in the town: what opens like a street, or what follows the town with a proper name."""
    parts = town_and_rest(place, town)
    opens = parts["rest"].rlike(r"(?i)\b(" + "|".join(PLACE_WORDS) + r")\b")
    return F.when(opens | (parts["town"].isNotNull() & parts["rest"].rlike(r"\b\p{Lu}\p{Ll}")), parts["rest"])


def corrected(text: Column, glossary: dict[str, str], surnames: list[str] | None = None) -> Column:
    """Wrong words of a glossary put right inside a text, longest first, whole words whatever their case.

    A word that stands inside one of the compound ``surnames`` is left alone. The glossary
    is configuration, some hundred entries; it becomes one chain of replacements.
    """
    out = text
    for wrong in sorted((w for w in glossary if w and glossary[w] != w), key=lambda w: (-len(w), w)):
        quoted = r"\Q" + wrong + r"\E"
        guard = "".join(r"(?<!\b\Q" + c[: c.lower().find(wrong.lower())] + r"\E)" for c in surnames or [] if c.lower().find(wrong.lower()) > 0)
        after = "".join(r"(?!\Q" + c[len(wrong) :] + r"\E\b)" for c in surnames or [] if c.lower().startswith(wrong.lower() + " "))
        out = F.regexp_replace(out, r"(?iu)" + guard + r"(?<![\p{L}])" + quoted + r"(?![\p{L}])" + after, glossary[wrong].replace("\\", "\\\\").replace("$", "\\$"))
    return out


def snippet(text: Column, word: Column, around: int = 90) -> Column:
    """The text around the first place of a word, with dots where it is cut; null without the word."""
    at = F.instr(F.lower(text), F.lower(word))
    begin = F.greatest(at - around, F.lit(1))
    end = F.least(at + F.char_length(word) + around, F.char_length(text) + 1)
    cut = F.concat(F.when(begin > 1, "…").otherwise(""), F.substring(text, begin, end - begin), F.when(end <= F.char_length(text), "…").otherwise(""))
    return F.when(at > 0, cut)


def place_in_text(text: Column, word: Column) -> Column:
    """Where a word first stands in a text, from 0 to 1; null if it does not."""
    at = F.instr(F.lower(text), F.lower(word))
    return F.when(at > 0, (at - 1) / F.greatest(F.char_length(text), F.lit(1)))


#: The seven verdicts of a second reading, and other words for them.
VERDICTS = ("CONFERMATO", "COMPATIBILE", "CONFLITTO_CON_LA_TRASCRIZIONE", "CONFLITTO_CON_IL_CONTESTO", "AMBIGUO", "NON_LEGGIBILE", "PROVE_INSUFFICIENTI")
SAME_VERDICT = {
    "ERRORE_TRASCRIZIONE": "CONFLITTO_CON_LA_TRASCRIZIONE", "ERRORE_DI_TRASCRIZIONE": "CONFLITTO_CON_LA_TRASCRIZIONE", "ERRORE_NELLA_TRASCRIZIONE": "CONFLITTO_CON_LA_TRASCRIZIONE",
    "CORRETTO": "CONFLITTO_CON_LA_TRASCRIZIONE", "CORRETTO_DA_IMMAGINE": "CONFLITTO_CON_LA_TRASCRIZIONE", "CORRETTO_DALL_IMMAGINE": "CONFLITTO_CON_LA_TRASCRIZIONE", "CORRETTO_DAL_GENEALOGISTA": "CONFLITTO_CON_LA_TRASCRIZIONE",
    "CONFORME": "CONFERMATO", "CONFERMATO_DA_IMMAGINE": "CONFERMATO", "CONFERMATO_DALL_IMMAGINE": "CONFERMATO", "CONFERMATO_CON_NOTE": "CONFERMATO", "CONFERMATO_CON_VARIANTE_GRAFICA": "CONFERMATO",
    "CONFERMATO_CON_DIVERGENZA": "AMBIGUO", "NON_PRESENTE_SULLA_PAGINA": "PROVE_INSUFFICIENTI",
}


def verdict_of(answer: Column) -> Column:
    """The verdict that an answer means: itself, by another word for it, or by a beginning that can mean nothing else.

    An answer that means none of the seven comes back in its written form; one that is null is empty.
    """
    said = F.regexp_replace(F.upper(F.trim(F.coalesce(answer, F.lit("")))), "[' ]", "_")
    other = F.try_element_at(F.create_map(*[F.lit(x) for pair in SAME_VERDICT.items() for x in pair]), said)
    begun = F.when(said.startswith("CONFLITTO_CON_LA_TRASC"), VERDICTS[2]).when(said.startswith("CONFLITTO_CON_IL_CONT"), VERDICTS[3])
    return F.when(said.isin(*VERDICTS), said).otherwise(F.coalesce(other, begun, said))


def label_of(code: Column, labels: dict[str, str]) -> Column:
    """The label of a code; a code without one is its own."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in labels.items() for x in pair]), code), code)


def json_block(text: Column) -> Column:
    """The JSON object or list inside a free text: what stands between fences, else from the first bracket to the last."""
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1)
    bare = F.regexp_extract(text, r"(?s)([\[{].*[\]}])", 1)
    return F.nullif(F.regexp_replace(F.when(fenced != "", fenced).otherwise(bare), r"^\s+|\s+$", ""), F.lit(""))


def joined(*columns: Column) -> Column:
    """The distinct values that are neither null nor blank, in order, with bars between."""
    kept = F.filter(F.transform(F.array(*columns), lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))
    return F.nullif(F.array_join(F.array_distinct(kept), " | "), F.lit(""))


#: Readings that say there is none, marks of doubt that no name bears, and how many words a name may have.
ABSENT = r"(?iu)^\s*(?:nulla|niente|nessun[oa]?|vuot[oa]|assente|mancante|illeggibile|in\s?bianco|n\.?d\.?|[-–—]+|\?+)\s*$|^\s*non\s+(?:presente|indicat[oa]|specificat[oa]|leggibile|riportat[oa]|c['’]?e)\b"
NO_NAME = r"(?iu)[()\[\]?\"«»]|\boppure\b|\bnel testo\b|\bignot[oa]\b|\bnessun"
HONOURS = r"(?iu)^(don|donna|signor[ae]?|sig\.?|mastro|maestro)\b"
MOST_WORDS = 3
#: An explanation that admits to another act or page, and an act it names.
ELSEWHERE = r"(?iu)att[oi]\s+(?:n\.?\s*\d+\s+)?(?:precedent|success|seguent|anterior|prima|dopo)|(?:fine|coda|inizio|principio|testa)\s+dell['’]att[oa]\s+(?:precedent|success|seguent)|pagina\s+(?:precedent|success|seguent)"
ACT_NAMED = r"(?iu)att[oi]\s+(?:n(?:umero)?\.?\s*)?([0-9]+|[a-zàèéìòù]+)"


def is_reading(value: Column) -> Column:
    """Whether a proposed value is something a page can say, and not a word for nothing; null and blank are none."""
    return F.coalesce((F.trim(value) != "") & ~F.regexp_like(value, F.lit(ABSENT)), F.lit(False))


def name_shaped(value: Column) -> Column:
    """Whether a value can be a name or a surname by its form: no marks of doubt, no title, one to three words."""
    words = F.filter(F.split(F.trim(value), r"\s+"), lambda w: w != "")
    return F.coalesce(~value.rlike(NO_NAME) & ~F.trim(value).rlike(HONOURS) & F.size(words).between(1, MOST_WORDS), F.lit(False))


def looks_elsewhere(explanation: Column, act: Column, number: Callable[[Column], Column]) -> Column:
    """Whether an explanation owns that what it read stands outside the act: by the words for it, or by naming an act of another number.

    ``number`` reads the number of an act (``weights.act_number``); an act without one is compared with none.
    """
    named = F.transform(F.regexp_extract_all(explanation, F.lit(ACT_NAMED), F.lit(1)), number)
    mine = number(act.cast("string"))
    other = mine.isNotNull() & F.exists(named, lambda n: F.coalesce(n != mine, F.lit(False)))
    return F.coalesce(explanation.rlike(ELSEWHERE) | other, F.lit(False))

"""Ages, years and the weights of evidence (log10 odds)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def number_words() -> dict[str, int]:
    """Italian number words 0..109, made from units, teens and tens with their elisions."""
    units = "zero uno due tre quattro cinque sei sette otto nove".split()
    teens = "dieci undici dodici tredici quattordici quindici sedici diciassette diciotto diciannove".split()
    tens = "venti trenta quaranta cinquanta sessanta settanta ottanta novanta".split()
    words = {w: i for i, w in enumerate(units + teens)}
    for t, ten in enumerate(tens):
        value = 20 + 10 * t
        words[ten] = value
        for u in range(1, 10):
            words[(ten[:-1] if units[u][0] in "uo" else ten) + units[u]] = value + u
    for rest, value in [("", 0), *((w, v) for w, v in list(words.items()) if 0 < v < 10)]:
        words["cento" + rest] = 100 + value
    return words


def _lookup() -> Column:
    return F.create_map(*[F.lit(x) for pair in number_words().items() for x in pair])


#: Words that go with an age and say nothing of it, and tens that may stand apart from their units.
FILLERS = r"\b(?:di|d'|dell'|eta'|eta|anni|anno|circa|incirca|presso|verso|compiuti|compiti|in|su|sui|sul|about)(?=\W|$)"
UNITS = ((r"\bme[sz]['i]?[ei]?\b", 1 / 12), (r"\bgiorn[oi]\b", 1 / 365), (r"\b(?:or[ae]|minut[oi])\b", 0.0), (r"\bsettiman[ae]\b", 7 / 365))
NEWBORN = r"\b(?:neonat[oa]|neondat[oa]|nat[oa]\s+oggi|appena\s+nat[oa]|pochi\s+giorni|poche\s+ore|di\s+giorni|giorno)\b"
TENS = ("venti", "trenta", "quaranta", "cinquanta", "sessanta", "settanta", "ottanta", "novanta")


def _age_words(text: Column) -> Column:
    """The words of an age that may be numbers: fillers and units taken out, letters joined by an apostrophe put together."""
    t = F.trim(F.translate(F.lower(text), "àèéìòù", "aeeiou"))
    bare = F.regexp_replace(t, FILLERS, " ")
    for unit, _ in UNITS:
        bare = F.regexp_replace(bare, unit, " ")
    bare = F.regexp_replace(F.regexp_replace(bare, r"(?<=[a-z])'(?=[a-z])", ""), r"[^a-z0-9 ]+", " ")
    return F.filter(F.split(bare, r" +"), lambda w: w != "")


def age(text: Column, near: Column | None = None) -> Column:
    """``struct(years, approximate, at_least)`` of a free-text age.

    Digits or Italian number words (tens may stand apart, "cinquanta sei"); months,
    days, weeks and hours are parts of a year; "circa" marks an approximation; the
    newborn are 0; "maggiore di eta" is at least 21; what cannot be read is null. ``near``
    is the number of the closest number word, if none is exact (``near_number``): then
    the age is an approximation.
    """
    t = F.trim(F.translate(F.lower(text), "àèéìòù", "aeeiou"))
    approximate = t.rlike(r"\b(circa|incirca|verso|presso|about)\b")
    factor = F.when(F.lit(False), 1.0)
    for unit, share in UNITS:
        factor = factor.when(t.rlike(unit), F.lit(share))
    factor = factor.otherwise(1.0)
    words = _age_words(text)
    digits = F.get(F.filter(words, lambda w: w.rlike(r"^\d{1,3}$") & (F.try_to_number(w, F.lit("999")) <= 120)), F.lit(0))
    look = _lookup()

    def number(w: Column, i: Column) -> Column:
        after = F.get(words, F.when(F.get(words, i + 1) == "e", i + 2).otherwise(i + 1))
        stem = F.when(after.isin("uno", "otto"), F.substring(w, F.lit(1), F.char_length(w) - 1)).otherwise(w)
        return F.coalesce(F.when(w.isin(*TENS), F.try_element_at(look, F.concat(stem, after))), F.try_element_at(look, w))

    read = F.get(F.filter(F.transform(words, number), lambda n: n.isNotNull()), F.lit(0))
    newborn = t.rlike(NEWBORN) & digits.isNull() & read.isNull()
    of_age = t.rlike(r"\bmagg?[io]or\w*\b") & digits.isNull() & read.isNull()
    close = F.lit(None).cast("int") if near is None else F.when(digits.isNull() & read.isNull(), near)
    under = t.rlike(r"\bmin[oe]r\w*\b") & (F.size(words) == 0)
    years = (
        F.when(newborn, 0.0).when(under, None).when(digits.isNotNull(), F.try_to_number(digits, F.lit("999")).cast("double") * factor)
        .when(read.isNotNull(), read * factor).when(close.isNotNull(), close * factor).when(of_age, 21.0)
    )
    bound = of_age & ~newborn & close.isNull()
    unsure = approximate | bound | newborn | close.isNotNull()
    readable = years.isNotNull()
    return F.struct(years.alias("years"), F.coalesce(unsure & readable, F.lit(False)).alias("approximate"), F.coalesce(bound & readable, F.lit(False)).alias("at_least"))


def near_number(text: Column) -> Column:
    """The number whose word is closest to a word of the text (similarity .78, five letters, lengths three apart at most), or null.

    An Arrow function over distinct words; ask it only of ages that ``age`` cannot read.
    """
    numbers = number_words()

    def run(rows: pd.Series) -> pd.Series:
        from kinweave.functions.similarity import similarities

        seen: dict[str, tuple[float, int] | None] = {}
        for w in {w for ws in rows if ws is not None for w in ws if len(w) >= 5}:
            forms = [f for f in numbers if abs(len(f) - len(w)) <= 3]
            scores = similarities([w] * len(forms), forms)
            best = int(scores.argmax()) if len(forms) else 0
            seen[w] = (float(scores[best]), numbers[forms[best]]) if len(forms) and scores[best] >= 0.78 else None
        best_of = lambda ws: max((seen[w] for w in ws if seen.get(w)), key=lambda x: x[0], default=(0, None))[1]
        return pd.Series([None if ws is None else best_of(ws) for ws in rows], dtype="Int32")

    return F.pandas_udf(run, "int")(_age_words(text))


def age_unit(age_text: Column, act_text: Column) -> Column:
    """An age whose unit the column lost, with the unit that the act gives it: "otto" and "di mesi otto"."""
    bare = F.regexp_replace(F.trim(age_text), r"[.*+?^${}()|\[\]\\]", "")
    unit = F.regexp_extract(F.lower(act_text), r"\b(mesi|mese|giorni|giorno|settimane|ore)\b", 1)
    near = F.lower(act_text).contains(F.concat(unit, F.lit(" "), F.lower(bare)))
    alone = ~F.lower(age_text).rlike(r"\b(ann|mes|giorn|settiman|or[ae])")
    return F.when((unit != "") & near & alone, F.concat(unit, F.lit(" "), bare)).otherwise(age_text)


def act_number(text: Column) -> Column:
    """The number of an act, in digits or in words; null for anything else."""
    t = F.trim(F.lower(text))
    digits = F.regexp_extract(t, r"(\d+)", 1)
    return F.coalesce(F.try_to_number(F.nullif(digits, F.lit("")), F.lit("999999999")).cast("int"), F.try_element_at(_lookup(), F.regexp_replace(t, r"[^a-z]", "")))


def page_number(image: Column) -> Column:
    """The last number in an image's name, its ending left out."""
    numbers = F.regexp_extract_all(F.regexp_replace(image, r"\.\w+$", ""), F.lit(r"(\d+)"), F.lit(1))
    return F.try_element_at(numbers, F.lit(-1)).cast("int")


#: Italian months.
MONTHS = ("gennaio", "febbraio", "marzo", "aprile", "maggio", "giugno", "luglio", "agosto", "settembre", "ottobre", "novembre", "dicembre")


def month_of(date_text: Column) -> Column:
    """The month that a date written out names, or of an ISO date; null for none."""
    named = F.coalesce(*[F.when(F.lower(date_text).rlike(rf"\b{m}\b"), F.lit(i + 1)) for i, m in enumerate(MONTHS)])
    return F.coalesce(named, F.try_to_number(F.nullif(F.regexp_extract(date_text, r"^\d{4}-(\d{2})", 1), F.lit("")), F.lit("99")).cast("int"))


def day_of(year: Column, month: Column, day: Column) -> Column:
    """A date of which parts may lack: the first of a month, the first of July of a year."""
    return F.make_date(year, F.coalesce(month, F.lit(7)), F.when(month.isNull(), F.lit(1)).otherwise(F.coalesce(day, F.lit(1))))


def months_between(a: Column, b: Column) -> Column:
    """Whole calendar months from one date to another."""
    return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)


def card_confidence(certain: Column, doubtful_share: Column) -> Column:
    """The confidence of a person's card: 1 if fixed by hand, .95 less .4 of the share of doubtful rows, at least .55."""
    return F.when(certain, 1.0).otherwise(F.greatest(F.lit(0.55), 0.95 - 0.4 * F.coalesce(doubtful_share, F.lit(0.0))))


def birth_year(year: Column, age_years: Column, month: Column | None = None) -> Column:
    """Year less whole years of age; one less if so many months reach back over the new year."""
    months = F.round(age_years * 12)
    back = F.lit(False) if month is None else (age_years < 1) & (months > 0) & (month <= months)
    return (year - F.floor(age_years) - F.when(F.coalesce(back, F.lit(False)), 1).otherwise(0)).cast("int")


def rarity(frequency: Column, total: Column, share: float, cap: float) -> Column:
    """The weight of agreeing on a value that rare: ``min(cap, log10(share * total / frequency))``."""
    return F.least(F.lit(cap), F.log10(F.lit(share) * total / F.greatest(frequency, F.lit(1))))


def age_gap(gap: Column) -> Column:
    """The weight of two ages ``gap`` years apart: a mixture of Laplace laws and a floor, against 1 in 50."""
    law = lambda scale: F.exp(-F.abs(gap) / scale) / (2 * scale)
    return F.log10((0.88 * law(2.0) + 0.11 * law(8.0) + 0.01 / 60) * 50)


def confidence(logit: Column) -> Column:
    """The probability of log10 odds, held within 12 either way."""
    p = F.pow(F.lit(10.0), F.greatest(F.lit(-12.0), F.least(F.lit(12.0), logit)))
    return p / (1 + p)


def state(conf: Column) -> Column:
    """Bands of confidence."""
    return F.when(conf >= 0.95, "confirmed").when(conf >= 0.80, "probable").when(conf >= 0.55, "possible").otherwise("doubtful")


def priority(conf: Column, impact: Column, severity: Column) -> Column:
    """Doubt, reach and gravity of a question in one number."""
    return (0.15 + 1 - F.abs(2 * conf - 1)) * F.sqrt(1 + impact) * severity

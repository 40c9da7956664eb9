"""Rules on ages as Column expressions: free text to a scale on which characters only move forward."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tesserae.functions import values as V
from tesserae.functions.names import once, strip

AGELESS = "ageless"


def _map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def _number_word(low: Column) -> Column:
    """The first number word, unless it counts years of something or things."""
    small = "|".join(k for k, n in V.UNITS.items() if n < 10)
    found = rf"(?s)^.*?(?:\b({'|'.join(V.TENS)})(?:[- ]({small}))?\b|\b({'|'.join(V.UNITS)})\b)(.{{0,24}})"
    part = lambda k: F.regexp_extract(low, found, k)
    ten, unit, alone = (part(k) for k in (1, 2, 3))
    n = F.when(ten != "", F.element_at(_map(V.TENS), ten) + F.coalesce(F.element_at(_map(V.UNITS), F.nullif(unit, F.lit(""))), F.lit(0))).otherwise(F.element_at(_map(V.UNITS), F.nullif(alone, F.lit(""))))

    def counting(tail: Column) -> Column:
        duration = F.rlike(tail, F.lit(r"^\s*(years?|yrs?)\b")) & ~F.rlike(tail, F.lit(r"^\s*(years?|yrs?)[- ]old\b"))
        things = F.rlike(tail, F.lit(r"^\s+[a-z]")) & ~F.rlike(tail, F.lit(r"^\s+(or|and|years?|yrs?)\b"))
        return duration | things

    return F.when(~once(part(4), counting), n)


def _of_number(n: Column) -> Column:
    return F.when(n <= 12, "child").otherwise(F.concat(F.lit("about "), n.cast("string")))


def normalized(c: Column) -> Column:
    """A band, "ageless", "about N", or null."""
    return once(F.lower(strip(F.coalesce(c, F.lit("")))), lambda low: once(F.regexp_replace(low, V.COMPARATIVE, " "), lambda rest: once(_number(rest), lambda number: _on_scale(low, rest, number))))


def _number(rest: Column) -> Column:
    """The number that a phrase tells, if it is no duration."""
    told = once(F.regexp_extract(rest, r"\b(\d{1,3})\b", 1), lambda digits: F.when(digits != "", F.try_to_number(digits, F.lit("999")).cast("int")).otherwise(_number_word(rest)))
    return F.when(~F.rlike(rest, F.lit(V.DURATION)), told)


def _on_scale(low: Column, rest: Column, number: Column) -> Column:
    """low: the phrase; rest: without comparisons; number: what it tells."""
    old = rf"\b(\d{{1,3}}|{'|'.join(V.UNITS)})\s*(years?|yrs?)[- ]old\b"
    years = F.regexp_extract(low, old, 1)
    of_years = F.coalesce(F.element_at(_map(V.UNITS), F.nullif(years, F.lit(""))), F.expr("null").cast("int"), F.try_to_number(years, F.lit("999")).cast("int"))
    out = (
        F.when(low == "", None)
        .when(F.rlike(low, F.lit(V.NO_AGE)), None)
        .when(F.rlike(low, F.lit(r"\b(ageless|timeless)\b")), AGELESS)
        .when(years != "", _of_number(of_years))
        .when((number >= 1) & (number <= 120), _of_number(number))
    )
    for band, pattern in V.BAND_PATTERNS:
        out = out.when(F.rlike(rest, F.lit(pattern)), band)
    return out


def rank(a: Column) -> Column:
    """A place on the scale; -1 for none, ageless above all."""
    n = F.try_to_number(F.regexp_extract(a, r"^about (\d+)", 1), F.lit("999")).cast("int")
    about = once(n, lambda n: F.when(n <= 12, 0).when(n <= 25, 1).when(n <= 40, 2).when(n <= 55, 3).when(n <= 70, 4).otherwise(5))
    band = F.array_position(F.array(*[F.lit(b) for b in V.BANDS]), a).cast("int") - 1
    return F.when(a.isNull(), -1).when(a == AGELESS, len(V.BANDS) + 1).when(F.startswith(a, F.lit("about ")), about).otherwise(band)


def refined(current: Column, incoming: Column) -> Column:
    """The later of two; a number instead of a word for the same band."""

    def later(now: Column, new: Column) -> Column:
        number = F.startswith(new, F.lit("about ")) & ~F.startswith(now, F.lit("about "))
        further = once(rank(new) - rank(now), lambda k: (k > 0) | ((k == 0) & number))
        return F.when(new.isNull(), now).when(now.isNull(), new).when(further, new).otherwise(now)

    return once(current, lambda now: once(normalized(incoming), lambda new: later(now, new)))

"""Rules on places of origin as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tesserae.functions import values as V
from tesserae.functions.names import norm, once, strip


def _map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def _chains() -> dict[str, list[str]]:
    """Every region's parents up to the nation."""
    out = {}
    for region in V.PARENTS:
        chain, at = [], region
        while (parent := V.PARENTS.get(at)) and parent not in chain:
            chain.append(parent)
            at = parent.lower()
        out[region] = chain
    return out


def is_unresolved(c: Column) -> Column:
    """Nothing, blank, or a word for not knowing."""
    starts = lambda s: reduce(lambda found, p: found | F.startswith(s, F.lit(p)), V.UNRESOLVED, s == "")
    return once(F.lower(strip(F.coalesce(c, F.lit("")))), starts)


def is_placeholder_value(c: Column) -> Column:
    """The narrower rule of carried-over values: nothing, blank or "unknown..."."""
    s = F.lower(strip(F.coalesce(c, F.lit(""))))
    return (s == "") | F.startswith(s, F.lit("unknown"))


def _component(c: Column) -> Column:
    part = strip(F.regexp_replace(strip(F.regexp_replace(c, r"\([^)]*\)", "")), "^,+|,+$", ""))
    named = lambda part, key: F.when(part != "", F.coalesce(F.element_at(_map(V.PEOPLES), key), F.element_at(_map(V.DEMONYMS), key), part))
    return once(part, lambda part: once(norm(part), lambda key: named(part, key)))


def _completed(parts: Column) -> Column:
    """With the regions above the last part, up to the first that is there already."""
    chains = F.create_map(*[x for k, c in _chains().items() for x in (F.lit(k), F.array(*[F.lit(p) for p in c]))])
    above = F.coalesce(F.element_at(chains, norm(F.element_at(parts, -1))), F.array().cast("array<string>"))
    there = lambda seen, above: F.array_position(F.transform(above, lambda p: F.array_contains(seen, norm(p))), F.lit(True)).cast("int")
    cut = lambda above, first: F.when(first > 0, F.slice(above, 1, F.greatest(first - 1, F.lit(0)))).otherwise(above)
    return F.concat(parts, once(above, lambda up: once(F.transform(parts, norm), lambda seen: once(there(seen, up), lambda first: cut(up, first)))))


def normalized(c: Column) -> Column:
    """ "Village, Region, Nation" with places for demonyms and no hedges; null where nothing is said."""
    parts = F.filter(F.transform(F.split(c, ","), _component), lambda p: p.isNotNull())
    return F.when(~is_unresolved(c), once(parts, lambda parts: F.when(F.size(parts) > 0, F.array_join(_completed(parts), ", "))))


def keys(c: Column) -> Column:
    return F.array_distinct(F.transform(F.filter(F.split(c, ","), lambda p: strip(p) != ""), norm))


def refined(current: Column, incoming: Column) -> Column:
    """(value, conflict): the finer of two accounts of one place; the current one, flagged, of two places."""
    out = lambda value, conflict: F.struct(value.alias("value"), F.lit(conflict).alias("conflict"))

    def finer(old: Column, new: Column, a: Column, b: Column) -> Column:
        same = (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)
        return (
            F.when(new.isNull(), out(current, False))
            .when(old.isNull(), out(new, False))
            .when(same, out(old, False))
            .when(F.arrays_overlap(a, b), out(F.when(F.size(b) > F.size(a), new).otherwise(old), False))
            .otherwise(out(old, True))
        )

    return once(normalized(current), lambda old: once(normalized(incoming), lambda new: once(keys(old), lambda a: once(keys(new), lambda b: finer(old, new, a, b)))))


def category(name: Column, kind: Column) -> Column:
    """An origin that is no place, where name or kind tell it."""
    return F.when(F.coalesce(kind.isin(*V.SPECIES), F.lit(False)), "Shadow").when(norm(name).isin(*V.COSMIC), "Time")

"""Rules on names as Column expressions: keys, decoration, placeholders, canonical forms. No UDFs.

Nulls are empty strings wherever a rule takes a text, as the rules are meant for free input.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tesserae.functions import values as V

SPACE = r"(?U)\s+"
EDGES = r"(?U)^\s+|\s+$"


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def once(c: Column, f: Callable[[Column], Column]) -> Column:
    """f(c), c evaluated once a row however often f reads it: a plain expression is evaluated wherever it stands."""
    return F.get(F.transform(F.array(c), f), 0)


def strip(c: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(c, EDGES, "")


def squeezed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, SPACE, " "))


def norm(c: Column) -> Column:
    """The matching key: lower case, straight apostrophes, single blanks."""
    return squeezed(F.replace(F.lower(_text(c)), F.lit("’"), F.lit("'")))


def norm_search(c: Column) -> Column:
    """The search key: ``norm`` with opening quotes straightened, too."""
    return squeezed(F.replace(F.replace(F.lower(_text(c)), F.lit("’"), F.lit("'")), F.lit("‘"), F.lit("'")))


def words(c: Column) -> Column:
    """The words of a normalised text, none of an empty one."""
    return F.filter(F.split(c, " "), lambda w: w != "")


def tokens(c: Column) -> Column:
    return F.array_distinct(words(c))


def _within(c: Column, vocabulary) -> Column:
    return c.isin(*vocabulary)


def distinctive(tokens_: Column) -> Column:
    """Tokens that tell individuals apart: two letters or more and no stopword."""
    return F.filter(tokens_, lambda t: (F.length(t) >= 2) & ~_within(t, V.STOPWORDS))


def subset(a: Column, b: Column) -> Column:
    return F.size(F.array_except(a, b)) == 0


def strip_titles(n: Column) -> Column:
    """A normalised name without one leading article and without rank phrases, longest first."""
    bare = once(F.concat(F.lit(" "), squeezed(_text(n)), F.lit(" ")), lambda padded: F.when(F.startswith(padded, F.lit(" the ")), F.concat(F.lit(" "), F.substring(padded, 6, 1 << 30))).otherwise(padded))
    return squeezed(reduce(lambda s, rank: F.replace(s, F.lit(f" {rank} "), F.lit(" ")), V.RANKS, bare))


def match_key(c: Column) -> Column:
    return strip_titles(norm(c))


def is_generic(c: Column) -> Column:
    return _within(norm(c), V.GENERIC)


def is_suspect(c: Column) -> Column:
    return _within(norm(c), V.SUSPECT)


def is_noisy(c: Column) -> Column:
    """Shorter than four characters, or a common word."""
    return (F.length(strip(c)) < 4) | _within(F.lower(strip(c)), V.NOISY)


def is_rank_decorated(n: Column, name_tokens: Column) -> Column:
    """The name's own tokens in the guise of a rank or an article."""
    return once(strip_titles(n), lambda bare: (bare != norm(n)) & (F.size(words(bare)) > 0) & subset(words(bare), name_tokens))


def is_description(n: Column, name_tokens: Column) -> Column:
    """Adjectives with the character's own name."""
    own = lambda t: F.array_contains(name_tokens, t)
    adjective = lambda t: _within(t, V.ADJECTIVES)
    return once(F.filter(words(norm(n)), lambda t: ~_within(t, ("the", "a"))), lambda ws: F.exists(ws, own) & F.exists(ws, adjective) & F.forall(ws, lambda t: own(t) | adjective(t)))


def is_misnomer(note: Column) -> Column:
    """A note that calls the name a mistake."""
    return F.coalesce(F.rlike(note, F.lit(V.MISNOMER)), F.lit(False))


def _without_article(n: Column) -> Column:
    return F.regexp_replace(n, "^the ", "")


def is_placeholder(c: Column) -> Column:
    """A description of somebody unnamed."""

    def described(n: Column) -> Column:
        tail = F.element_at(words(n), -1)
        named = ~_within(n, V.ALLOWED) & (n != "")
        return named & (F.contains(n, F.lit(" with ")) | F.coalesce(_within(tail, V.TAILS), F.lit(False)) | _within(_without_article(n), V.ROLES))

    return once(norm(c), described)


def is_title(c: Column) -> Column:
    """Begins with an article, and is neither allowed nor a placeholder."""
    n = norm(c)
    return ~_within(n, V.ALLOWED) & ~is_placeholder(c) & F.startswith(n, F.lit("the "))


def is_collective(c: Column, kind: Column) -> Column:
    """A species in place of an individual."""
    n = norm(c)
    named = F.contains(n, kind) | F.startswith(n, F.lit("the ")) | F.startswith(n, F.lit("a "))
    return F.coalesce(~_within(n, V.ALLOWED) & _within(kind, V.SPECIES) & named, F.lit(False))


def rejection(c: Column, kind: Column) -> Column:
    """Why a new name is not taken as it is; null if it is."""
    return F.when(is_placeholder(c), "placeholder").when(is_collective(c, kind), "collective").when(is_title(c), "title")


def coerced(c: Column, allowed, default: str) -> Column:
    """An enumeration's value; unknown ones are "other", none is the default."""
    x = F.lower(strip(F.coalesce(F.when(c == "", None).otherwise(c), F.lit(default))))
    return F.when(_within(x, allowed), x).otherwise("other")


def character_type(c: Column) -> Column:
    return coerced(c, V.CHARACTER_TYPES, "human")


def faction_type(c: Column) -> Column:
    return coerced(c, V.FACTION_TYPES, "other")


def is_named(c: Column) -> Column:
    """Every word is a name's: capitalised, a particle, or one fused to a name."""
    bare = F.filter(F.transform(words(squeezed(_text(c))), lambda t: F.regexp_replace(t, "^[’'\",.;:]+|[’'\",.;:]+$", "")), lambda t: t != "")
    return F.forall(bare, lambda t: _within(F.lower(t), V.PARTICLES) | F.rlike(t, F.lit(r"^\p{Lu}")) | F.rlike(t, F.lit("^[a-z]{1,3}['’][A-Z]")))


def is_fuller(candidate: Column, primary: Column) -> Column:
    """A proper name that has all words of the primary name and more, up to four."""
    c, p = strip(_text(candidate)), strip(_text(primary))
    mine, theirs = words(match_key(c)), words(match_key(p))
    more = subset(theirs, mine) & ~subset(mine, theirs)
    length = (F.size(theirs) > 0) & (F.size(mine) > 1) & (F.size(mine) <= 4)
    return (norm(c) != norm(p)) & (c != "") & (p != "") & ~is_placeholder(c) & ~is_generic(c) & length & more & is_named(c)


def adopted(c: Column) -> Column:
    """A name as a primary name would have it: no leading article or rank, no "of House", spelling kept."""
    joined = strip(F.regexp_replace(F.concat(F.lit(" "), strip(_text(c)), F.lit(" ")), r"(?iU)\s+of\s+house\s+", " "))
    bare = once(words(squeezed(joined)), lambda ws: F.when(norm(F.element_at(ws, 1)) == "the", F.slice(ws, 2, 1 << 20)).otherwise(ws))

    def cut(ws: Column, low: Column) -> Column:
        rest = lambda rank: (F.startswith(low, F.lit(rank + " ")), F.slice(ws, rank.count(" ") + 2, 1 << 20))
        return reduce(lambda done, rank: done.when(*rest(rank)), V.RANKS[1:], F.when(*rest(V.RANKS[0]))).otherwise(ws)

    return F.array_join(once(bare, lambda ws: once(F.concat(norm(F.array_join(ws, " ")), F.lit(" ")), lambda low: cut(ws, low))), " ")


def adopted_tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(words(strip_titles(norm(adopted(c)))), lambda t: ~_within(t, ("the", "a", "an"))))


def is_role_epithet(n: Column) -> Column:
    return _within(_without_article(n), V.ROLES) | F.arrays_overlap(words(n), F.array(*[F.lit(x) for x in V.GROUP_ROLES]))


def alias_verdict(n: Column, kind: Column, note: Column, name_tokens: Column, siblings: Column) -> Column:
    """(action, rule) for an alias that may go: DROP, COLLAPSE, REVIEW or KEEP; the first rule that holds counts."""
    twin = _within(kind, ("title", "epithet")) & ~F.startswith(n, F.lit("the ")) & F.array_contains(siblings, F.concat(F.lit("the "), n))
    said = lambda action, rule: F.struct(F.lit(action).alias("action"), F.lit(rule).alias("rule"))
    return (
        F.when(is_misnomer(note), said("DROP", "corrected_misnomer"))
        .when(is_rank_decorated(n, name_tokens), said("DROP", "rank_decorated"))
        .when(is_description(n, name_tokens), said("DROP", "descriptor_epithet"))
        .when(twin, said("COLLAPSE", "article_dup"))
        .when(is_role_epithet(n), said("REVIEW", "generic_role"))
        .when(strip_titles(n) == "", said("REVIEW", "empty_residue"))
        .otherwise(said("KEEP", ""))
    )


def is_group_ajah(name: Column, kind: Column) -> Column:
    n = norm(name)
    return (F.coalesce(kind == "ajah", F.lit(False))) | (n == "ajah") | F.endswith(n, F.lit(" ajah"))


def is_black(name: Column) -> Column:
    return norm(name) == "black ajah"


def ajah_conflict(held: Column, name: Column) -> Column:
    """Whether another public group of the exclusive kind is held already."""
    return ~is_black(name) & F.exists(held, lambda h: ~is_black(h) & (norm(h) != norm(name)))


def slot_valid(c: Column) -> Column:
    return F.rlike(c, F.lit("^[a-z0-9]+\\z"))


def slot_of_number(c: Column) -> Column:
    """A bare number N is slot bookN."""
    x = strip(c)
    return F.when(F.rlike(x, F.lit(r"^[0-9]+$")), F.concat(F.lit("book"), x.cast("bigint").cast("string"))).otherwise(x)


def order_and_label(slot: Column) -> Column:
    """What a slot bookN implies; nulls for others."""
    n = F.when(F.rlike(slot, F.lit(r"^book\d+$")), F.regexp_extract(slot, r"^book(\d+)$", 1).cast("int"))
    return F.struct(n.alias("series_order"), F.concat(F.lit("Book "), n.cast("string")).alias("label"))


def hash_colour(c: Column) -> Column:
    """A colour of the palette by the 32-bit string hash h * 31 + c."""
    wrap = lambda x: F.pmod(x + F.lit(1 << 31), F.lit(1 << 32)) - F.lit(1 << 31)
    h = F.aggregate(F.split(c, ""), F.lit(0).cast("bigint"), lambda a, x: F.when(x == "", a).otherwise(wrap(a * 31 + F.ascii(x))))
    colours = F.array(*[F.lit(x) for x in V.PALETTE])
    return F.when(_text(c) == "", V.NO_COLOUR).otherwise(F.element_at(colours, (F.abs(h) % len(V.PALETTE) + 1).cast("int")))

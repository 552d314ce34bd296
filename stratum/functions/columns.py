"""Column-level cleaning and derivation, all as built-in expressions.

Everything returns a ``Column`` (or a DataFrame for whole-frame renames) so it
stays inside whole-stage codegen; there is no Python UDF in this module.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- names (P-1, P-2)

def normalise_name(name: str) -> str:
    """lower -> space to '_' -> drop other chars -> squeeze '_' -> trim '_'."""
    out = name.lower().replace(" ", "_")
    out = re.sub(r"[^a-z0-9_]", "", out)
    out = re.sub(r"_+", "_", out)
    return out.strip("_")


def normalise_names(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`normalise_name`; refuse collisions."""
    new = [normalise_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if not n:
            raise ValueError(f"column {old!r} normalises to an empty name")
        if n in seen:
            raise ValueError(f"columns {seen[n]!r} and {old!r} both normalise to {n!r}")
        seen[n] = old
    return df.toDF(*new)


def rename(df: DataFrame, mapping: Mapping[str, str], drop: Iterable[str] = ()) -> DataFrame:
    """One projection that renames by ``mapping`` and drops ``drop``."""
    dropped = set(drop)
    missing = (set(mapping) | dropped) - set(df.columns)
    if missing:
        raise KeyError(f"unknown columns: {sorted(missing)}")
    return df.select(*[F.col(c).alias(mapping.get(c, c)) for c in df.columns if c not in dropped])


# ---------------------------------------------------------------- nulls (F-4, S5)

def fill_const(col: Column | str, value) -> Column:
    return F.coalesce(_c(col), F.lit(value))


def null_if(col: Column | str, cond: Column) -> Column:
    """NULL where ``cond`` holds, else the value."""
    return F.when(~cond, _c(col))


# ---------------------------------------------------------------- buckets (F-15, F-17)

Rule = tuple[Column, object]


def bucketise(rules: Sequence[Rule], default=None) -> Column:
    """First matching rule wins: ``[(predicate, value), ...]`` -> CASE WHEN chain."""
    if not rules:
        return F.lit(default)
    expr = F.when(rules[0][0], F.lit(rules[0][1]))
    for pred, value in rules[1:]:
        expr = expr.when(pred, F.lit(value))
    return expr.otherwise(F.lit(default))


def thresholds(col: Column | str, edges: Sequence[tuple[float, object]], top) -> Column:
    """``col < e1 -> v1, col < e2 -> v2, ..., else top`` (left-closed bands)."""
    c = _c(col)
    return bucketise([(c < F.lit(edge), label) for edge, label in edges], top)


def code_map(col: Column | str, mapping: Mapping[object, object], default=None) -> Column:
    """Exact-value lookup with a default (e.g. code -> rank, 99 for unknown)."""
    c = _c(col)
    return bucketise([(c == F.lit(k), v) for k, v in mapping.items()], default)


def contains_any(col: Column | str, needles: Sequence[str]) -> Column:
    """Case-insensitive substring match against any needle (ILIKE '%x%')."""
    c = _c(col)
    pred = None
    for n in needles:
        p = c.ilike(f"%{n}%")
        pred = p if pred is None else (pred | p)
    return pred if pred is not None else F.lit(False)


def categorise(col: Column | str, rules: Sequence[tuple[Sequence[str], str]],
               default: str = "Other") -> Column:
    """First-match ILIKE categories: ``[(["grocery", "store"], "Grocery/Store"), ...]``."""
    return bucketise([(contains_any(col, needles), label) for needles, label in rules], default)


# ---------------------------------------------------------------- text (F-1..F-8)

def clean_upper(col: Column | str) -> Column:
    return F.upper(F.trim(_c(col)))


def pg_initcap(col: Column | str) -> Column:
    r"""initcap with PostgreSQL word boundaries (any non-alphanumeric char).

    Spark's ``initcap`` only starts a word after a space. A space is inserted
    after every character that is not a letter or digit (Unicode classes:
    Java's ``\p{Alnum}`` is ASCII-only and would split "élan"), ``initcap``
    runs, and exactly those inserted spaces are removed again. Everything stays
    in codegen-friendly regex and string functions (no lambda). Characters
    with special title-case mappings (ß, ligatures) follow Java title case.
    """
    spaced = F.regexp_replace(_c(col), r"([^\p{L}\p{N}])", "$1 ")
    return F.regexp_replace(F.initcap(spaced), r"([^\p{L}\p{N}]) ", "$1")


def split_count(col: Column | str, delimiter: str, regex: bool = False) -> Column:
    """Pieces after splitting on ``delimiter``; NULL or blank text counts as 0 (S9).

    Trailing empty pieces count (``'a|b|'`` has 3). A literal delimiter is
    counted from the length lost by removing it, so no array of pieces is
    built per row (documents can hold tens of thousands of lines); a regex
    delimiter needs ``split``.
    """
    c = _c(col)
    if regex:
        pieces = F.size(F.split(c, delimiter))
    else:
        removed = F.length(c) - F.length(F.replace(c, F.lit(delimiter), F.lit("")))
        pieces = (removed / F.lit(len(delimiter))).cast("int") + F.lit(1)
    return F.when(c.isNull() | (F.trim(c) == ""), F.lit(0)).otherwise(pieces)


# ---------------------------------------------------------------- dates, casts (F-9, F-14)

def parse_date(col: Column | str, fmt: str = "M/d/yyyy") -> Column:
    """Lenient date parse; NULL for text that does not parse (ANSI-safe)."""
    return F.try_to_date(_c(col), fmt)


_INTEGRAL = {"int", "integer", "bigint", "long", "smallint", "short", "tinyint", "byte"}
# A superset of the text an ANSI integral cast accepts (blanks/controls, sign,
# digits; the optional fraction is then refused by the cast itself).
_INTEGRAL_TEXT = r"^[\p{javaWhitespace}\p{Cntrl}]*[+-]?[0-9]+(\.[0-9]*)?[\p{javaWhitespace}\p{Cntrl}]*$"


def safe_cast(col: Column | str, type_name: str) -> Column:
    """Cast that yields NULL instead of raising under ANSI mode.

    A failing string cast costs an exception per row; for integral targets a
    regex pre-check (a superset of what the cast accepts) skips text that
    cannot parse, which is ~4x cheaper on columns that are mostly rejects.
    """
    c = _c(col)
    if type_name.lower() in _INTEGRAL:
        return F.when(c.cast("string").rlike(_INTEGRAL_TEXT), c.try_cast(type_name))
    return c.try_cast(type_name)


def cast_rejected(col: Column | str, type_name: str) -> Column:
    """True where a non-NULL value does not survive :func:`safe_cast`."""
    c = _c(col)
    return c.isNotNull() & safe_cast(c, type_name).isNull()


def money_round(col: Column | str, digits: int = 2) -> Column:
    """Round a double half-up on its decimal value (PostgreSQL ``round(x::numeric, n)``)."""
    return F.round(_c(col).cast("decimal(38,10)"), digits).cast("decimal(18,2)")

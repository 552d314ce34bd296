"""Column expressions shared by the text operators (built-in functions only)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII white space: U+0020 and U+0009..U+000D; everything else belongs to a word
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
FOLD_BLOCK = 256


def whole(text: Column) -> Column:
    """The text, with null read as the empty text."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of characters that are no ASCII white space, in order."""
    return F.array_remove(F.split(text, SPACE_CLASS + "+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def fold_list(n: Column, start: Column, step: Callable[[Column, Column], tuple[Column, Column]],
              item: str) -> Column:
    """Struct of the last state ``at`` and the list ``out`` that ``step`` emits for 0..n-1 in turn.

    ``step(state, k)`` gives the next state and an array of items. Items gather in blocks
    that are joined once, for appending to one growing array would copy it every time.
    """
    def one(acc: Column, k: Column) -> Column:
        at, items = step(acc["at"], k)
        return F.struct(at.alias("at"), F.concat(acc["out"], items).alias("out"))

    def block(acc: Column, first: Column) -> Column:
        inner = F.aggregate(
            F.sequence(first, F.least(first + (FOLD_BLOCK - 1), n - 1)),
            F.struct(acc["at"].alias("at"), F.array().cast(f"array<{item}>").alias("out")), one)
        return let(inner, lambda i: F.struct(
            i["at"].alias("at"), F.concat(acc["out"], F.array(i["out"])).alias("out")))

    return F.aggregate(
        F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(FOLD_BLOCK))).otherwise(F.array().cast("array<int>")),
        F.struct(start.alias("at"), F.array().cast(f"array<array<{item}>>").alias("out")), block,
        lambda acc: F.struct(acc["at"].alias("at"), F.flatten(acc["out"]).alias("out")))


def hex_u64(value: Column) -> Column:
    """A long as 16 lowercase hexadecimal digits (two's complement)."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))

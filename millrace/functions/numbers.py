"""Numeric coercion, ratios and scaling expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whole text must be one plain decimal number between optional white space.
_NUMBER = r"(?U)^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)\s*$"


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a plain number becomes null.

    A JVM cast alone would also take type suffixes (``12d``), words (``nan``,
    ``Infinity``) and hexadecimal. Extracting the number keeps ``c`` in one
    place, so a long input expression is evaluated once.
    """
    return F.regexp_extract(c.cast("string"), _NUMBER, 1).try_cast("double")


def positive(c: Column) -> Column:
    return F.when(c > 0, c)


def to_long(c: Column) -> Column:
    return c.try_cast("bigint")


def fractional(c: Column) -> Column:
    """True where a cast to a whole number would lose a fraction."""
    return F.coalesce(c != F.floor(c), F.lit(False))


def money(c: Column) -> Column:
    """``$12.5``, ``~12.5`` and ``12.5 aprox`` to 12.5."""
    bare = F.translate(c.cast("string"), "$~", "")
    return to_number(F.substring_index(bare, "aprox", 1))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is zero or either side is missing."""
    return F.try_divide(a, b)


def clip(c: Column, low, high) -> Column:
    """Limit to [low, high]; ``least``/``greatest`` skip nulls, hence the guard."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def flag(c: Column) -> Column:
    """1 where the count is positive, 0 elsewhere, null kept."""
    return (c > 0).cast("int")


def outside(c: Column, low, high) -> Column:
    """Range check in which a missing value counts as broken."""
    return ~F.coalesce(c.between(low, high), F.lit(False))

"""Rounding that gives the same digits on every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Plain decimal or exponent notation; Java's own forms (1d, 2f, 0x1p3) are text.
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def to_number(text: Column) -> Column:
    """Double read from text, or null where the text is not a number."""
    t = F.trim(text.cast("string"))
    return F.when(t.rlike(NUMBER), t.try_cast("double"))


def round_half_up(x: Column, digits: int) -> Column:
    """Round a double half-up to ``digits`` decimals, returned as double.

    The value first becomes an exact decimal with 6 places, then is rounded:
    rounding a binary double directly differs between engines and languages
    on ties such as 2.675 (binary 2.67499…).
    """
    return F.round(x.try_cast("decimal(28,6)"), digits).cast("double")

"""GTFS clock strings as column expressions.

GTFS times are ``H:M[:S]`` strings whose hour may exceed 23 (service past
midnight), so they are kept as strings and converted to integer seconds; they
never become ``TimestampType``. All parsing is ANSI-safe: ``get`` instead of
``[i]`` and guarded casts, so bad text yields null instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's ``str.strip()`` removes in practice (ASCII whitespace).
WS = " \t\n\r\x0b\x0c"


def strip(c: Column) -> Column:
    """Remove surrounding ASCII whitespace (not only spaces, unlike ``trim(c)``)."""
    return F.trim(c, F.lit(WS))


def to_int(c: Column) -> Column:
    """Integer value of a text field as Python's ``int()`` reads it, else null.

    Surrounding whitespace and a sign are allowed; ``'12.0'``, ``'1e3'`` or
    ``'x'`` are not integers: Spark's ANSI ``try_cast`` to an integral type
    already rejects them (some engines accept ``'12.0'``; the oracle SQL adds
    an explicit pattern check for those).
    """
    # Bounded to INT so that h * 3600 can never overflow (ANSI arithmetic
    # would fail the job); anything wider is not a clock hour anyway.
    return strip(c).try_cast("int").cast("bigint")


def _parts(c: Column) -> Column:
    return F.split(c, ":")


def time_to_seconds(c: Column) -> Column:
    """``H[:M[:S]]`` → seconds; blank or malformed → null; extra parts ignored."""
    t = strip(c)
    parts = _parts(t)
    n = F.size(parts)
    h = to_int(F.get(parts, 0))
    m = F.when(n > 1, to_int(F.get(parts, 1))).otherwise(F.lit(0).cast("bigint"))
    s = F.when(n > 2, to_int(F.get(parts, 2))).otherwise(F.lit(0).cast("bigint"))
    return F.when(t != "", h * 3600 + m * 60 + s)


def day_night(c: Column) -> Column:
    """NUIT when the hour is >= 22 or < 6, JOUR otherwise, INCONNU if unreadable.

    The hour is taken modulo nothing: 25:10 and 30:00 are both NUIT.
    """
    h = to_int(F.get(_parts(c), 0))
    return (F.when(h.isNull(), F.lit("INCONNU"))
            .when((h >= 22) | (h < 6), F.lit("NUIT"))
            .otherwise(F.lit("JOUR")))


def time_parts(c: Column) -> Column:
    """struct(hour % 24, minute, second) for the time dimension.

    A missing minute or second is 0; any unreadable part makes all three 0.
    """
    parts = _parts(c)
    n = F.size(parts)
    zero = F.lit(0).cast("bigint")
    h = to_int(F.get(parts, 0))
    m = F.when(n > 1, to_int(F.get(parts, 1))).otherwise(zero)
    s = F.when(n > 2, to_int(F.get(parts, 2))).otherwise(zero)
    ok = h.isNotNull() & m.isNotNull() & s.isNotNull()
    return F.struct(
        F.when(ok, F.pmod(h, F.lit(24))).otherwise(zero).cast("int").alias("hour"),
        F.when(ok, m).otherwise(zero).cast("int").alias("minute"),
        F.when(ok, s).otherwise(zero).cast("int").alias("second"),
    )

"""Text clean-up expressions used when loading the warehouse."""

from __future__ import annotations

from functools import lru_cache
from string import ascii_lowercase

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .numeric import to_number
from .timeparse import strip

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the source pipeline for identical results).
UNKNOWN_COUNTRY_WORDS = ["UNKNOWN", "UNKN", "UNK", "NA", "N/A", "NONE", "NULL"]
DATE_LIKE = r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4})"
COUNTRY_COLUMN_WIDTH = 30
# End of fixed values.
# ---------------------------------------------------------------------------


def clean_country(c: Column, max_len: int = COUNTRY_COLUMN_WIDTH) -> Column:
    """Country text fit for the staging column, or null.

    trim + upper; placeholder words and date-like text → null; keep only A–Z;
    empty → null; truncate to ``max_len``.
    """
    up = F.upper(strip(c))
    letters = F.regexp_replace(up, "[^A-Z]", "")
    bad = (up == "") | up.isin(UNKNOWN_COUNTRY_WORDS) | up.rlike(DATE_LIKE) | (letters == "")
    return F.when(~bad, F.substring(letters, 1, max_len))


#: The source's collation: without case and accents.
COLLATION = "UNICODE_CI_AI"
#: Code points whose collation keys are tabulated: Latin, Greek, Cyrillic, Armenian and
#: Georgian letters, marks, digits and signs (first, one past the last).
TABULATED = [(0x01, 0x590), (0x10A0, 0x1100), (0x1C80, 0x1CC0), (0x1E00, 0x2070)]


@lru_cache(maxsize=1)
def _collation_table() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """(letters, their key letters, letters that equal two letters) by the collation.

    Spark's own collated strings say which characters are equal; the key of each
    class is its first character. Characters that compare as nothing come last, so
    that ``translate`` drops them. A fixed table of a few thousand characters.
    """
    letters = [chr(c) for a, z in TABULATED for c in range(a, z)]
    double = [x + y for x in ascii_lowercase for y in ascii_lowercase]
    rows = [(len(x), i, x) for i, x in enumerate(letters + double)]
    classes = (SparkSession.active().createDataFrame(rows, "size int, at int, c string")
               .groupBy(F.collate("c", COLLATION).alias("k"))
               .agg(F.sort_array(F.collect_list(F.struct("size", "at", "c"))).alias("all")))
    one, double = {}, []
    for row in classes.collect():
        names = [r["c"] for r in row["all"]]
        nothing = "\u0300" in names  # a combining mark: compares as nothing
        for c in names:
            if len(c) == 1 and len(names[-1]) == 2:
                double.append((c, names[-1]))
            elif len(c) == 1:
                one[c] = "" if nothing else names[0]
    kept = sorted(c for c in one if one[c] and one[c] != c)
    dropped = sorted(c for c in one if not one[c])
    return "".join(kept + dropped), "".join(one[c] for c in kept), tuple(sorted(double))


def fold(c: Column) -> Column:
    """The collation key of a text: equal for texts that are equal without case and
    accents by the source's collation (Αθήνα/ΑΘΗΝΑ, Straße/STRASSE, Łódź/LODZ).

    A plain string again, so it hashes, groups, joins and searches like any key.
    Characters outside ``TABULATED`` stand for themselves."""
    letters, keys, double = _collation_table()
    spelled = c
    for one, two in double:
        spelled = F.replace(spelled, F.lit(one), F.lit(two))
    plain = F.octet_length(c) == F.length(c)  # ASCII: nothing to spell out
    return F.translate(F.when(plain, c).otherwise(spelled), letters, keys)


def route_id_of(title: Column) -> Column:
    """Route id = text before the first " - " of the route title (whole title if none)."""
    return F.substring_index(title, " - ", 1)


def agency_id_of(name: Column) -> Column:
    """Agency id = text before the first ":" of the agency name (whole name if none)."""
    return F.substring_index(name, ":", 1)


def is_valid_numeric(c: Column) -> Column:
    """True when the stripped text parses as a number, has no "/" and at most one "-"."""
    t = strip(c)
    dashes = F.length(t) - F.length(F.replace(t, F.lit("-"), F.lit("")))
    return (F.coalesce(t != "", F.lit(False))
            & ~t.contains("/") & (dashes <= 1)
            & to_number(t).isNotNull())

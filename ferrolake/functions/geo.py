"""Geographic column expressions: great-circle distance and stop → country."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the source pipeline for identical results).
# Country bounding boxes, in priority order: (code, lat_min, lat_max, lon_min, lon_max).
# All four bounds are inclusive; the first box that contains a point wins.
COUNTRY_BOXES = [
    ("FR", 41.0, 51.5, -5.5, 10.0),
    ("DE", 47.0, 55.5, 5.5, 15.5),
    ("IT", 36.0, 47.5, 6.5, 19.0),
    ("ES", 35.5, 44.0, -10.0, 5.0),
    ("CH", 45.5, 48.0, 5.5, 11.0),
    ("BE", 49.5, 51.5, 2.5, 6.5),
    ("NL", 50.5, 54.0, 3.0, 7.5),
    ("AT", 46.0, 49.5, 9.0, 17.5),
    ("LU", 49.4, 50.2, 5.7, 6.6),
    ("GB", 49.5, 61.0, -8.5, 2.0),
    ("IE", 51.0, 55.5, -11.0, -5.5),
    ("PT", 36.5, 42.5, -10.0, -6.0),
    ("PL", 49.0, 55.0, 14.0, 24.5),
    ("CZ", 48.5, 51.0, 12.0, 19.0),
    ("SK", 47.5, 49.5, 16.5, 22.5),
    ("HU", 45.5, 48.5, 16.0, 23.0),
    ("RO", 43.5, 48.5, 20.0, 30.0),
    ("BG", 41.0, 44.5, 22.0, 29.0),
    ("GR", 34.5, 42.0, 19.0, 29.0),
    ("HR", 42.0, 46.5, 13.0, 20.0),
    ("SI", 45.0, 47.0, 13.0, 17.0),
    ("SE", 55.0, 69.5, 10.5, 24.5),
    ("NO", 57.5, 71.5, 4.0, 31.5),
    ("DK", 54.5, 58.0, 8.0, 15.5),
    ("FI", 59.5, 70.5, 19.0, 32.0),
]

# City names looked up (as substrings of the upper-cased stop name), in
# priority order: the first country with a matching city wins.
CITY_NAMES = [
    ("FR", ["PARIS", "LYON", "MARSEILLE", "LILLE", "STRASBOURG", "BORDEAUX", "NANTES",
            "TOULOUSE", "NICE", "MONTPELLIER"]),
    ("DE", ["BERLIN", "MÜNCHEN", "MUNICH", "FRANKFURT", "HAMBURG", "KÖLN", "COLOGNE",
            "STUTTGART"]),
    ("IT", ["ROMA", "ROME", "MILANO", "MILAN", "VENEZIA", "VENICE", "FIRENZE", "FLORENCE",
            "NAPOLI"]),
    ("ES", ["MADRID", "BARCELONA", "VALENCIA", "SEVILLA", "SEVILLE", "ZARAGOZA"]),
    ("CH", ["ZÜRICH", "ZURICH", "GENÈVE", "GENEVA", "BERN", "BERNE", "BASEL"]),
    ("BE", ["BRUXELLES", "BRUSSELS", "BRUSSEL", "ANTWERPEN", "ANVERS", "GENT"]),
    ("NL", ["AMSTERDAM", "ROTTERDAM", "UTRECHT", "EINDHOVEN", "TILBURG"]),
    ("AT", ["WIEN", "VIENNA", "GRAZ", "LINZ", "SALZBURG"]),
    ("GB", ["LONDON", "MANCHESTER", "BIRMINGHAM", "LEEDS", "GLASGOW"]),
    ("CZ", ["PRAHA", "PRAGUE", "BRNO", "OSTRAVA"]),
    ("PL", ["WARSZAWA", "WARSAW", "KRAKÓW", "CRACOW", "ŁÓDŹ"]),
    ("LU", ["LUXEMBOURG"]),
    ("PT", ["LISBOA", "LISBON", "PORTO"]),
]

EARTH_RADIUS_KM = 6371.0
# End of fixed values.
# ---------------------------------------------------------------------------

# pi/180 as one double constant, so every engine multiplies by the same value.
DEG = 0.017453292519943295


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km (R = 6371); null if any coordinate is null."""
    p1, p2 = lat1 * DEG, lat2 * DEG
    dlat = p2 - p1
    dlon = lon2 * DEG - lon1 * DEG
    s1 = F.sin(dlat / 2)
    s2 = F.sin(dlon / 2)
    a = s1 * s1 + F.cos(p1) * F.cos(p2) * (s2 * s2)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(a))


def _name(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _q(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def country_of_point(lat: str, lon: str) -> Column:
    """First bounding box containing (lat, lon) (double columns), else null.

    One CASE expression inside whole-stage codegen: a point-in-box lookup
    against 25 constant boxes needs no join (a non-equi join would plan as a
    nested loop). Built as SQL text: one expression, one parse."""
    la, lo = _name(lat), _name(lon)
    whens = " ".join(f"WHEN {la} BETWEEN {a} AND {b} AND {lo} BETWEEN {c} AND {d} THEN '{code}'"
                     for code, a, b, c, d in COUNTRY_BOXES)
    return F.expr(f"CASE {whens} END")


def any_of(words: list[str]) -> str:
    """Regex matching any of ``words`` as a literal substring (RLIKE = find)."""
    return "|".join(re.escape(w) for w in words)


def country_of_name(name: str) -> Column:
    """Country whose city list has a member contained in upper(name), else null."""
    up = f"upper({_name(name)})"
    whens = " ".join(f"WHEN {up} RLIKE {_q(any_of(cities))} THEN '{code}'"
                     for code, cities in CITY_NAMES)
    return F.expr(f"CASE {whens} END")

"""Trip classification as column expressions: title, train class, traction,
emission factor, weekly frequency, service days, transport type."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geo import _name, _q, any_of
from .timeparse import strip

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the source pipeline for identical results).
ROUTE_TYPE_CLASS = [
    ("101", "Grande vitesse"),
    ("102", "Intercité"),
    ("103", "Inter-régional"),
    ("106", "Régional"),
    ("107", "Suburban"),
    ("2", "Rail"),
]
# Keyword lists tried in this order on the upper-cased route title or agency name.
CLASS_KEYWORDS = [
    ("Grande vitesse", ["TGV", "ICE", "AVE", "EUROSTAR", "THALYS", "FRECCIAROSSA"]),
    ("Intercité", ["INTERCITÉ", "INTERCITY", "IC ", "INTER CITY"]),
    ("Régional", ["TER", "REGIONAL", "REGIO", "RE ", "RB "]),
    ("International", ["EN ", "NJ ", "NIGHTJET", "INTERNATIONAL"]),
]
# Fallback thresholds: (label, km above, hours above).
CLASS_THRESHOLDS = [("Grande ligne", 800, 6), ("Intercité", 200, 2)]

ELECTRIC_KEYWORDS = ["TGV", "ICE", "EUROSTAR", "THALYS", "AVE", "FRECCIAROSSA", "TER", "INTERCITÉ"]
DIESEL_KEYWORDS = ["DIESEL", "AUTORAIL"]

# gCO2e per passenger-km by (train class, traction).
EMISSION_FACTORS = [
    ("Grande vitesse", "électrique", 3.2),
    ("Intercité", "électrique", 8.1),
    ("Régional", "électrique", 29.9),
    ("Inter-régional", "électrique", 20.0),
    ("International", "électrique", 5.0),
    ("Grande ligne", "électrique", 6.0),
    ("Grande vitesse", "diesel", 15.0),
    ("Intercité", "diesel", 35.0),
    ("Régional", "diesel", 45.0),
    ("Inter-régional", "diesel", 40.0),
]
DEFAULT_FACTOR = 25.0
MIXED_DEFAULT_ELECTRIC = 20.0
MIXED_DEFAULT_DIESEL = 40.0

MAX_TRIPS_PER_DAY = 20
DAYS = [("monday", "Mon"), ("tuesday", "Tue"), ("wednesday", "Wed"), ("thursday", "Thu"),
        ("friday", "Fri"), ("saturday", "Sat"), ("sunday", "Sun")]
EVERY_DAY = "Tous les jours"
TITLE_PLACEHOLDER = "---/---"

# GTFS route_type code → transport name.
TRANSPORT_TYPES = [
    ("0", "Tram"), ("1", "Metro"), ("2", "Rail"), ("3", "Bus"), ("4", "Ferry"),
    ("5", "Cable tram"), ("6", "Aerial lift"), ("7", "Funicular"),
    ("100", "Railway"), ("101", "High Speed Rail"), ("102", "Long Distance Train"),
    ("103", "Inter Regional Rail"), ("105", "Sleeper Rail"), ("106", "Regional Rail"),
    ("107", "Suburban Railway"), ("109", "Suburban Railway"), ("200", "Coach"),
    ("400", "Urban Railway"), ("401", "Metro"), ("402", "Underground"),
    ("700", "Bus"), ("900", "Tram"), ("1000", "Water Transport"), ("1500", "Taxi"),
]
# End of fixed values.
# ---------------------------------------------------------------------------


def _both(title: str, agency: str) -> str:
    # One upper-cased text per row; the separator cannot occur in a keyword, so
    # a match lies wholly in the title or wholly in the agency name.
    return (f"concat_ws('\\u0001', upper(coalesce({_name(title)}, '')), "
            f"upper(coalesce({_name(agency)}, '')))")


def _rlike(text: str, words: list[str]) -> str:
    return f"{text} RLIKE {_q(any_of(words))}"


def route_title(short: Column, long: Column, origin_name: Column, dest_name: Column) -> Column:
    """Display title of a route.

    Placeholder or empty names → "origin - destination"; both names set → the
    short one; otherwise whichever is set. Nulls count as empty.
    """
    return title_or_ends(named_title(short, long), origin_name, dest_name)


def title_or_ends(named: Column, origin_name: Column, dest_name: Column) -> Column:
    """``named_title`` where the route has one, else "origin - destination"."""
    return F.coalesce(named, F.concat(origin_name, F.lit(" - "), dest_name))


def named_title(short: Column, long: Column) -> Column:
    """The title that the route's own names give, null where its stops give it."""
    s = strip(F.coalesce(short, F.lit("")))
    lg = strip(F.coalesce(long, F.lit("")))
    ph_s, ph_l = s.startswith(TITLE_PLACEHOLDER), lg.startswith(TITLE_PLACEHOLDER)
    use_stops = (ph_s & ph_l) | ((s == "") & ph_l) | ((lg == "") & ph_s) | ((s == "") & (lg == ""))
    return (F.when(use_stops, F.lit(None).cast("string"))
            .when((s != "") & (lg != ""), s)
            .otherwise(F.when(lg != "", lg).otherwise(s)))


def train_class(route_type: str, title: str, agency: str, distance_km: str,
                duration_h: str) -> Column:
    """Train class (column names in): route_type code, then keywords in the
    title or agency name, then distance/duration thresholds."""
    text = _both(title, agency)
    rt = f"coalesce({_name(route_type)}, '')"
    km, h = _name(distance_km), _name(duration_h)
    parts = [f"WHEN {rt} = {_q(code)} THEN {_q(label)}" for code, label in ROUTE_TYPE_CLASS]
    parts += [f"WHEN {_rlike(text, words)} THEN {_q(label)}" for label, words in CLASS_KEYWORDS]
    parts += [f"WHEN {km} > {k} OR {h} > {hh} THEN {_q(label)}"
              for label, k, hh in CLASS_THRESHOLDS]
    parts.append(f"WHEN {km} > 0 THEN 'Régional'")
    return F.expr("CASE " + " ".join(parts) + " ELSE 'Inconnu' END")


def traction(title: str, agency: str, klass: str) -> Column:
    """électrique / diesel / mixte from keywords and the train class (column names in)."""
    text, k = _both(title, agency), _name(klass)
    return F.expr(f"CASE WHEN {_rlike(text, ELECTRIC_KEYWORDS)} THEN 'électrique' "
                  f"WHEN {k} IN ('Grande vitesse', 'Intercité') THEN 'électrique' "
                  f"WHEN {_rlike(text, DIESEL_KEYWORDS)} THEN 'diesel' "
                  f"WHEN {k} = 'Régional' THEN 'électrique' ELSE 'mixte' END")


def _factor(klass: str, kind: str, default: float) -> str:
    whens = " ".join(f"WHEN {klass} = {_q(k)} THEN {f!r}D" for k, t, f in EMISSION_FACTORS
                     if t == kind)
    return f"(CASE {whens} ELSE {default!r}D END)"


def emission_factor(klass: str, trac: str) -> Column:
    """gCO2e per passenger-km (column names in); ``mixte`` is the mean of the
    electric and diesel factors of the class (20 and 40 when it has none)."""
    k, t = _name(klass), _name(trac)
    mixed = (f"({_factor(k, 'électrique', MIXED_DEFAULT_ELECTRIC)} + "
             f"{_factor(k, 'diesel', MIXED_DEFAULT_DIESEL)}) / 2")
    return F.expr(f"CASE WHEN {t} = 'mixte' THEN {mixed} "
                  f"WHEN {t} = 'électrique' THEN {_factor(k, 'électrique', DEFAULT_FACTOR)} "
                  f"WHEN {t} = 'diesel' THEN {_factor(k, 'diesel', DEFAULT_FACTOR)} "
                  f"ELSE {DEFAULT_FACTOR!r}D END")


def service_days(cal: dict[str, Column]) -> Column:
    """"Mon,Tue,…" from the seven calendar flags; no flag set → "Tous les jours"."""
    listed = F.concat_ws(",", *[F.when(cal[d] == "1", F.lit(a)) for d, a in DAYS])
    return F.when(listed == "", F.lit(EVERY_DAY)).otherwise(listed)


def active_days(cal: dict[str, Column]) -> Column:
    """Number of flagged days, 7 when none is flagged (or no calendar)."""
    n = reduce(lambda a, b: a + b, [F.when(cal[d] == "1", 1).otherwise(0) for d, _ in DAYS])
    return F.when(n == 0, F.lit(7)).otherwise(n)


def weekly_frequency(days: Column, departures_per_pattern: Column) -> Column:
    """days × departures of the same (route, service, origin, destination),
    the departures clipped to [1, 20]."""
    per_day = F.least(F.lit(MAX_TRIPS_PER_DAY),
                      F.greatest(F.lit(1), F.coalesce(departures_per_pattern, F.lit(1))))
    return (days * per_day).cast("int")


def transport_type(code: Column) -> Column:
    """GTFS route_type name, "Type <code>" when unknown."""
    m = F.create_map(*[F.lit(x) for kv in TRANSPORT_TYPES for x in kv])
    return F.coalesce(F.try_element_at(m, code),
                      F.concat(F.lit("Type "), F.coalesce(code, F.lit("None"))))

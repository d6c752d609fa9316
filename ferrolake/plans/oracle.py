"""DuckDB SQL for the correctness oracle.

Each registered query has an ANSI-SQL twin run by DuckDB on the same parquet
tables. The SQL restates the pipeline step by step as CTEs (views → per-trip
facts → summary → staging → warehouse → report), generated from the same
fixed-value tables as the Spark code but evaluated by a different engine.
Rounding is spelled out (decimal half-up, exact integer averages) so both
engines produce the same digits.
"""

from __future__ import annotations

from ..functions.classify import (CLASS_KEYWORDS, CLASS_THRESHOLDS, DAYS, DEFAULT_FACTOR,
                                  DIESEL_KEYWORDS, ELECTRIC_KEYWORDS, EMISSION_FACTORS,
                                  EVERY_DAY, MAX_TRIPS_PER_DAY, MIXED_DEFAULT_DIESEL,
                                  MIXED_DEFAULT_ELECTRIC, ROUTE_TYPE_CLASS, TITLE_PLACEHOLDER,
                                  TRANSPORT_TYPES)
from ..functions.geo import CITY_NAMES, COUNTRY_BOXES, DEG, EARTH_RADIUS_KM
from ..functions.text import COUNTRY_COLUMN_WIDTH, UNKNOWN_COUNTRY_WORDS
from ..functions.timeparse import WS
from ..sources.countries import COUNTRIES
from ..sources.driver_views import oracle_views_sql

_WS_SQL = "'" + WS.replace("\n", "' || chr(10) || '").replace("\r", "' || chr(13) || '") \
    .replace("\t", "' || chr(9) || '").replace("\x0b", "' || chr(11) || '") \
    .replace("\x0c", "' || chr(12) || '") + "'"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {_WS_SQL})"


def to_int(x: str) -> str:
    t = strip(x)
    return f"(CASE WHEN regexp_matches({t}, '^[+-]?[0-9]+$') THEN CAST(TRY_CAST({t} AS INTEGER) AS BIGINT) END)"


def tsec(x: str) -> str:
    t = strip(x)
    p = f"string_split({t}, ':')"
    return (f"(CASE WHEN {t} <> '' THEN {to_int(p + '[1]')} * 3600 + "
            f"(CASE WHEN len({p}) > 1 THEN {to_int(p + '[2]')} ELSE 0 END) * 60 + "
            f"(CASE WHEN len({p}) > 2 THEN {to_int(p + '[3]')} ELSE 0 END) END)")


def folded(x: str) -> str:
    """The text without case and accents, with the letters that have no accent to
    strip spelled out (as far as the driver views hold any)."""
    t = f"lower(strip_accents({x}))"
    for letter, plain in (("ß", "ss"), ("œ", "oe"), ("ł", "l"), ("ø", "o"), ("ς", "σ")):
        t = f"replace({t}, '{letter}', '{plain}')"
    return t


def day_night(x: str) -> str:
    h = to_int(f"string_split({x}, ':')[1]")
    return (f"(CASE WHEN {h} IS NULL THEN 'INCONNU' WHEN {h} >= 22 OR {h} < 6 THEN 'NUIT' "
            f"ELSE 'JOUR' END)")


def time_parts(x: str) -> tuple[str, str, str]:
    p = f"string_split({x}, ':')"
    h = to_int(p + "[1]")
    m = f"(CASE WHEN len({p}) > 1 THEN {to_int(p + '[2]')} ELSE 0 END)"
    s = f"(CASE WHEN len({p}) > 2 THEN {to_int(p + '[3]')} ELSE 0 END)"
    ok = f"({h} IS NOT NULL AND {m} IS NOT NULL AND {s} IS NOT NULL)"
    return (f"CAST(CASE WHEN {ok} THEN (({h} % 24) + 24) % 24 ELSE 0 END AS INTEGER)",
            f"CAST(CASE WHEN {ok} THEN {m} ELSE 0 END AS INTEGER)",
            f"CAST(CASE WHEN {ok} THEN {s} ELSE 0 END AS INTEGER)")


def rnd(x: str, n: int) -> str:
    return f"CAST(round(TRY_CAST({x} AS DECIMAL(28,6)), {n}) AS DOUBLE)"


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    p1, p2 = f"({lat1} * {DEG!r})", f"({lat2} * {DEG!r})"
    dlat = f"({p2} - {p1})"
    dlon = f"(({lon2} * {DEG!r}) - ({lon1} * {DEG!r}))"
    s1, s2 = f"sin({dlat} / 2)", f"sin({dlon} / 2)"
    a = f"({s1} * {s1} + cos({p1}) * cos({p2}) * ({s2} * {s2}))"
    return f"({2 * EARTH_RADIUS_KM!r} * asin(sqrt({a})))"


def box_country(lat: str, lon: str) -> str:
    whens = " ".join(
        f"WHEN {lat} BETWEEN {a} AND {b} AND {lon} BETWEEN {c} AND {d} THEN '{code}'"
        for code, a, b, c, d in COUNTRY_BOXES)
    return f"(CASE {whens} END)"


def name_country(name: str) -> str:
    up = f"upper({name})"
    whens = " ".join(
        "WHEN " + " OR ".join(f"contains({up}, {q(c)})" for c in cities) + f" THEN '{code}'"
        for code, cities in CITY_NAMES)
    return f"(CASE {whens} END)"


def _any(texts: list[str], words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({t}, {q(w)})" for w in words for t in texts) + ")"


def route_title(short: str, long: str, o: str, d: str) -> str:
    s, lg = strip(f"coalesce({short}, '')"), strip(f"coalesce({long}, '')")
    ph = q(TITLE_PLACEHOLDER)
    use = (f"(starts_with({s}, {ph}) AND starts_with({lg}, {ph})) OR ({s} = '' AND "
           f"starts_with({lg}, {ph})) OR ({lg} = '' AND starts_with({s}, {ph})) OR "
           f"({s} = '' AND {lg} = '')")
    return (f"(CASE WHEN {use} THEN {o} || ' - ' || {d} WHEN {s} <> '' AND {lg} <> '' THEN {s} "
            f"WHEN {lg} <> '' THEN {lg} ELSE {s} END)")


def train_class(rt: str, title: str, agency: str, km: str, hours: str) -> str:
    texts = [f"upper({title})", f"upper({agency})"]
    parts = [f"WHEN coalesce({rt}, '') = {q(code)} THEN {q(label)}"
             for code, label in ROUTE_TYPE_CLASS]
    parts += [f"WHEN {_any(texts, words)} THEN {q(label)}" for label, words in CLASS_KEYWORDS]
    parts += [f"WHEN {km} > {k} OR {hours} > {h} THEN {q(label)}"
              for label, k, h in CLASS_THRESHOLDS]
    parts.append(f"WHEN {km} > 0 THEN 'Régional'")
    return "(CASE " + " ".join(parts) + " ELSE 'Inconnu' END)"


def traction(title: str, agency: str, klass: str) -> str:
    texts = [f"upper({title})", f"upper({agency})"]
    return (f"(CASE WHEN {_any(texts, ELECTRIC_KEYWORDS)} THEN 'électrique' "
            f"WHEN {klass} IN ('Grande vitesse', 'Intercité') THEN 'électrique' "
            f"WHEN {_any(texts, DIESEL_KEYWORDS)} THEN 'diesel' "
            f"WHEN {klass} = 'Régional' THEN 'électrique' ELSE 'mixte' END)")


def _factor(klass: str, kind: str, default: float) -> str:
    whens = " ".join(f"WHEN {klass} = {q(k)} THEN {f!r}" for k, t, f in EMISSION_FACTORS
                     if t == kind)
    return f"(CASE {whens} ELSE {default!r} END)"


def factor(klass: str, trac: str) -> str:
    mixed = (f"(({_factor(klass, 'électrique', MIXED_DEFAULT_ELECTRIC)} + "
             f"{_factor(klass, 'diesel', MIXED_DEFAULT_DIESEL)}) / 2)")
    return (f"(CASE WHEN {trac} = 'mixte' THEN {mixed} "
            f"WHEN {trac} = 'électrique' THEN {_factor(klass, 'électrique', DEFAULT_FACTOR)} "
            f"WHEN {trac} = 'diesel' THEN {_factor(klass, 'diesel', DEFAULT_FACTOR)} "
            f"ELSE {DEFAULT_FACTOR!r} END)")


def service_days(prefix: str = "") -> str:
    items = ", ".join(f"CASE WHEN {prefix}{d} = '1' THEN '{a}' END" for d, a in DAYS)
    listed = f"concat_ws(',', {items})"
    return f"(CASE WHEN {listed} = '' THEN {q(EVERY_DAY)} ELSE {listed} END)"


def active_days(prefix: str = "") -> str:
    n = " + ".join(f"(CASE WHEN {prefix}{d} = '1' THEN 1 ELSE 0 END)" for d, _ in DAYS)
    return f"(CASE WHEN ({n}) = 0 THEN 7 ELSE ({n}) END)"


def weekly_frequency(days: str, deps: str) -> str:
    return (f"CAST({days} * least({MAX_TRIPS_PER_DAY}, greatest(1, coalesce({deps}, 1))) "
            f"AS INTEGER)")


def clean_country(x: str, width: int = COUNTRY_COLUMN_WIDTH) -> str:
    up = f"upper({strip(x)})"
    letters = f"regexp_replace({up}, '[^A-Z]', '', 'g')"
    words = ", ".join(q(w) for w in UNKNOWN_COUNTRY_WORDS)
    bad = (f"({up} = '' OR {up} IN ({words}) OR "
           f"regexp_matches({up}, '^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}})')"
           f" OR {letters} = '')")
    return f"(CASE WHEN NOT {bad} THEN substr({letters}, 1, {width}) END)"


def transport_type(code: str) -> str:
    whens = " ".join(f"WHEN {code} = {q(k)} THEN {q(v)}" for k, v in TRANSPORT_TYPES)
    return f"(CASE {whens} ELSE 'Type ' || coalesce({code}, 'None') END)"


def valid_numeric(x: str) -> str:
    t = strip(x)
    return (f"(coalesce({t} <> '', false) AND NOT contains({t}, '/') AND "
            f"length({t}) - length(replace({t}, '-', '')) <= 1 AND "
            f"regexp_matches({t}, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$'))")


def avg2(col: str) -> str:
    """round(avg(decimal(10,3)), 2) exactly as Spark computes it, as DOUBLE:
    the mean is rounded half-up to 7 places, then to 2 (integer arithmetic)."""
    s = f"CAST(sum({col}) * 1000 AS HUGEINT)"
    n = f"count({col})"
    a7 = f"(({s} * 20000 + {n}) // (2 * {n}))"
    return f"CAST((({a7}) * 2 + 100000) // 200000 AS DOUBLE) / 100.0"


def sum2(col: str) -> str:
    return f"CAST(round(sum({col}), 2) AS DOUBLE)"


# Pipeline CTE chain ------------------------------------------------------------

ORD = "{'s': seq, 'p': o_l_partkey, 'q': o_l_suppkey, 'l': o_l_linenumber}"
ST_ORDER = "seq, o_l_partkey, o_l_suppkey, o_l_linenumber"
DAY_COLS = [d for d, _ in DAYS]


def _first(x: str) -> str:
    return f"arg_min({x}, {ORD}) FILTER (WHERE {x} IS NOT NULL)"


def _last(x: str) -> str:
    return f"arg_max({x}, {ORD}) FILTER (WHERE {x} IS NOT NULL)"


def pipeline_ctes() -> str:
    shape_km = "(CASE WHEN shape_span <= 1000 THEN shape_span ELSE shape_span / 1000.0 END)"
    title = route_title("route_short_name", "route_long_name", "origin_stop_name",
                        "destination_stop_name")
    days = ", ".join(f"c.{d}" for d in DAY_COLS)
    return ",\n".join([
        oracle_views_sql(),
        # P1/P2 + coordinates
        f"""st0 AS (SELECT dataset_id, {strip("coalesce(CAST(trip_id AS VARCHAR), '')")} AS trip_id,
            stop_id, departure_time, arrival_time,
            coalesce(TRY_CAST(trunc(TRY_CAST(stop_sequence AS DOUBLE)) AS INTEGER), 0) AS seq,
            TRY_CAST(shape_dist_traveled AS DOUBLE) AS shape,
            o_l_partkey, o_l_suppkey, o_l_linenumber FROM v_stop_times)""",
        """coords AS (SELECT stop_id, TRY_CAST(stop_lat AS DOUBLE) AS lat,
            TRY_CAST(stop_lon AS DOUBLE) AS lon FROM v_stops)""",
        f"""st1 AS (SELECT st0.*, coords.lat, coords.lon,
            lag(shape) OVER (PARTITION BY dataset_id, trip_id ORDER BY {ST_ORDER}) AS prev_shape
            FROM st0 LEFT JOIN coords USING (stop_id) WHERE st0.trip_id <> '')""",
        f"""st2 AS (SELECT *,
            lag(lat) OVER (PARTITION BY dataset_id, trip_id ORDER BY {ST_ORDER}) AS plat,
            lag(lon) OVER (PARTITION BY dataset_id, trip_id ORDER BY {ST_ORDER}) AS plon
            FROM st1 WHERE NOT coalesce(shape < prev_shape, false))""",
        f"""st3 AS (SELECT *, {haversine('plat', 'plon', 'lat', 'lon')} AS seg_km,
            {tsec('departure_time')} AS dep_s, {tsec('arrival_time')} AS arr_s FROM st2)""",
        f"""pt AS (SELECT dataset_id, trip_id,
            {_first('stop_id')} AS origin_stop_id, {_last('stop_id')} AS destination_stop_id,
            {_first('departure_time')} AS departure_time, {_last('arrival_time')} AS arrival_time,
            {_first('dep_s')} AS first_dep_s, {_last('arr_s')} AS last_arr_s,
            greatest(max(arr_s), max(dep_s)) AS max_s, least(min(arr_s), min(dep_s)) AS min_s,
            count(arr_s) + count(dep_s) AS n_times,
            max(shape) - min(shape) AS shape_span, count(shape) > 0 AS has_shape,
            sum(seg_km) AS geo_km
            FROM st3 GROUP BY dataset_id, trip_id)""",
        f"""pt2 AS (SELECT dataset_id, trip_id, origin_stop_id, destination_stop_id,
            departure_time, arrival_time, has_shape,
            round((CASE WHEN last_arr_s - first_dep_s >= 0 THEN last_arr_s - first_dep_s
                        WHEN n_times < 2 THEN 0 ELSE max_s - min_s END) / 60.0, 2) AS duration_min,
            {rnd(f'coalesce({shape_km}, 0.0)', 3)} AS shape_km,
            {rnd('coalesce(geo_km, 0.0)', 3)} AS geo_km FROM pt)""",
        """feedflag AS (SELECT dataset_id, bool_or(has_shape) AS f FROM pt2 GROUP BY dataset_id)""",
        """facts AS (SELECT pt2.*, CASE WHEN f THEN shape_km ELSE geo_km END AS distance_km
            FROM pt2 JOIN feedflag USING (dataset_id))""",
        # J1–J3
        f"""tr0 AS (SELECT dataset_id, {strip("coalesce(trip_id, '')")} AS trip_id, route_id,
            service_id, file_row FROM v_trips)""",
        f"""enr AS (SELECT t.*, r.agency_id AS route_agency_id, r.route_short_name,
            r.route_long_name, r.route_type, coalesce(a.agency_name, 'ERROR') AS agency_name,
            {days}, 0 AS cal_row
            FROM tr0 t LEFT JOIN v_routes r ON r.route_id = t.route_id
            LEFT JOIN v_agency a ON a.agency_id = r.agency_id
            LEFT JOIN v_calendar c ON c.service_id = t.service_id WHERE t.trip_id <> '')""",
        """jrows AS (SELECT * FROM enr JOIN facts USING (dataset_id, trip_id))""",
        """pcount AS (SELECT dataset_id, route_id, service_id, origin_stop_id,
            destination_stop_id, count(*) AS departures FROM jrows
            WHERE origin_stop_id IS NOT NULL AND destination_stop_id IS NOT NULL
            GROUP BY ALL)""",
        f"""firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id,
            trip_id ORDER BY file_row, cal_row, {', '.join(DAY_COLS)}) AS rn FROM jrows) x
            WHERE rn = 1)""",
        """fj AS (SELECT f.*, p.departures FROM firsts f LEFT JOIN pcount p
            ON f.dataset_id IS NOT DISTINCT FROM p.dataset_id
            AND f.route_id IS NOT DISTINCT FROM p.route_id
            AND f.service_id IS NOT DISTINCT FROM p.service_id
            AND f.origin_stop_id IS NOT DISTINCT FROM p.origin_stop_id
            AND f.destination_stop_id IS NOT DISTINCT FROM p.destination_stop_id)""",
        f"""labels AS (SELECT stop_id, coalesce(stop_name, '') AS name,
            {box_country('TRY_CAST(stop_lat AS DOUBLE)', 'TRY_CAST(stop_lon AS DOUBLE)')}
            AS box_country FROM v_stops)""",
        """ends AS (SELECT fj.*,
            CASE WHEN lo.stop_id IS NULL THEN 'ERROR' ELSE lo.name END AS origin_stop_name,
            lo.box_country AS o_box,
            CASE WHEN ld.stop_id IS NULL THEN 'ERROR' ELSE ld.name END AS destination_stop_name,
            ld.box_country AS d_box
            FROM fj LEFT JOIN labels lo ON lo.stop_id = fj.origin_stop_id
            LEFT JOIN labels ld ON ld.stop_id = fj.destination_stop_id)""",
        f"""c1 AS (SELECT *, coalesce(o_box, {name_country('origin_stop_name')}) AS origin_country,
            coalesce(d_box, {name_country('destination_stop_name')}) AS destination_country,
            duration_min / 60.0 AS duration_hours, {title} AS route_name FROM ends)""",
        f"""c2 AS (SELECT *, {train_class('route_type', 'route_name', 'agency_name',
                                          'distance_km', 'duration_hours')} AS train_type FROM c1)""",
        f"""c3 AS (SELECT *, {traction('route_name', 'agency_name', 'train_type')} AS traction
            FROM c2)""",
        f"""c4 AS (SELECT *, {factor('train_type', 'traction')} AS factor FROM c3)""",
        f"""classified AS (SELECT dataset_id, trip_id, agency_name, route_name, train_type,
            CASE WHEN departure_time IS NULL OR departure_time = '' THEN 'INCONNU'
                 ELSE {day_night('departure_time')} END AS service_type,
            origin_stop_name, origin_country, destination_stop_name, destination_country,
            departure_time, arrival_time,
            {rnd('distance_km', 3)} AS distance_km, {rnd('duration_hours', 2)} AS duration_h,
            {rnd('factor', 2)} AS emission_gco2e_pkm,
            {rnd('factor * distance_km / 1000', 3)} AS total_emission_kgco2e,
            {weekly_frequency(active_days(), 'departures')} AS frequency_per_week,
            dataset_id AS source_dataset, traction, {service_days()} AS service_days,
            file_row, cal_row FROM c4)""",
        """summary AS (SELECT * REPLACE (
              CASE WHEN emission_gco2e_pkm >= 0 THEN emission_gco2e_pkm END AS emission_gco2e_pkm,
              CASE WHEN total_emission_kgco2e >= 0 THEN total_emission_kgco2e END
                AS total_emission_kgco2e)
            FROM classified
            WHERE trim(coalesce(trip_id, '')) <> '' AND coalesce(duration_h > 0, false)
              AND coalesce(distance_km >= 0, false)
              AND NOT coalesce(origin_stop_name = destination_stop_name, false))""",
    ])


REQUIRED = ["trip_id", "agency_name", "route_name", "origin_stop_name", "destination_stop_name"]


def _reject() -> str:
    parts = [f"WHEN {v} IS NULL OR {strip(v)} = '' OR {v} = 'ERROR' THEN "
             f"'Missing or invalid {v}'" for v in REQUIRED]
    parts.append("WHEN distance_km < 0 THEN 'distance_km out of range: ' || "
                 "CAST(distance_km AS VARCHAR)")
    return "(CASE " + " ".join(parts) + " END)"


def named_dim(name: str, key: str, label: str) -> str:
    """One row per folded id: the greatest name, then the greatest id."""
    return f"""{name} AS (SELECT {key}, {label}, folded FROM (SELECT *, row_number() OVER (
            PARTITION BY folded ORDER BY {label} DESC, {key} DESC) AS rn FROM
            (SELECT DISTINCT {key}, {label}, {folded(key)} AS folded FROM staging) d) x
            WHERE rn = 1)"""


LOAD_ID = 1
LOADED_AT = "2025-01-01 00:00:00"


def warehouse_ctes() -> str:
    seed = ", ".join(f"({q(c)}, {q(n)})" for c, n in COUNTRIES)
    hh, mm, ss = time_parts("time_value")
    return ",\n".join([
        pipeline_ctes(),
        f"""tagged AS (SELECT *, {_reject()} AS reject_reason FROM summary)""",
        f"""staging AS (SELECT CAST({LOAD_ID} AS BIGINT) AS load_id,
            TIMESTAMP '{LOADED_AT}' AS loaded_at, source_dataset AS dataset_id, trip_id,
            split_part(route_name, ' - ', 1) AS route_id, route_name,
            split_part(agency_name, ':', 1) AS agency_id, agency_name, service_type,
            origin_stop_name, {clean_country('origin_country')} AS origin_country,
            destination_stop_name, {clean_country('destination_country')} AS destination_country,
            departure_time, arrival_time,
            TRY_CAST(distance_km AS DECIMAL(10,3)) AS distance_km,
            TRY_CAST(duration_h AS DECIMAL(10,3)) AS duration_h, train_type, traction,
            '' AS transport_type,
            TRY_CAST(emission_gco2e_pkm AS DECIMAL(10,3)) AS emission_gco2e_pkm,
            TRY_CAST(total_emission_kgco2e AS DECIMAL(10,3)) AS total_emission_kgco2e,
            CAST(frequency_per_week AS INTEGER) AS frequency_per_week
            FROM tagged WHERE reject_reason IS NULL)""",
        f"""seed(country_code, country_name) AS (VALUES {seed})""",
        """dim_country AS (SELECT coalesce(s.country_code, x.c) AS country_code, s.country_name
            FROM seed s FULL JOIN (SELECT origin_country AS c FROM staging
              WHERE origin_country IS NOT NULL UNION
              SELECT destination_country FROM staging WHERE destination_country IS NOT NULL) x
            ON x.c = s.country_code)""",
        f"""dim_time AS (SELECT time_value, {hh} AS hour, {mm} AS minute, {ss} AS second FROM
            (SELECT departure_time AS time_value FROM staging WHERE departure_time IS NOT NULL
             UNION SELECT arrival_time FROM staging WHERE arrival_time IS NOT NULL) t)""",
        f"""dim_location AS (SELECT min(stop_name) AS stop_name, country_code FROM
            (SELECT origin_stop_name AS stop_name, origin_country AS country_code FROM staging
             UNION ALL SELECT destination_stop_name, destination_country FROM staging) t
            GROUP BY {folded('stop_name')}, country_code)""",
        named_dim("dim_route", "route_id", "route_name"),
        named_dim("dim_agency", "agency_id", "agency_name"),
        # the fact with natural keys in place of surrogate keys
        f"""fact AS (SELECT s.*, dr.route_name AS dim_route_name,
            da.agency_name AS dim_agency_name, dc.country_name AS origin_country_name
            FROM staging s JOIN dim_route dr ON dr.folded = {folded('s.route_id')}
            JOIN dim_agency da ON da.folded = {folded('s.agency_id')}
            LEFT JOIN dim_country dc ON dc.country_code = s.origin_country)""",
    ])


def with_pipeline(select: str, extra: list[str] = ()) -> str:
    return f"WITH {',\n'.join([pipeline_ctes(), *extra])}\n{select}"


def with_warehouse(select: str, extra: list[str] = ()) -> str:
    return f"WITH {',\n'.join([warehouse_ctes(), *extra])}\n{select}"

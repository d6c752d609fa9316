"""GTFS-shaped tables derived from the driver's TPC-H-like tables.

The driver data has no timetable, so the six GTFS files are derived from
``supplier`` (stops), ``nation`` (agency), ``customer`` (routes), ``orders``
(calendar, trips) and ``lineitem`` (stop_times) by integer arithmetic. The
expressions are SQL text read the same way by Spark and DuckDB, so the
correctness oracle starts from the very same rows. The derivation is a
projection of each source table: it grows with the data and adds no shuffle
beyond the small ``DISTINCT`` of the calendar.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _s(x: str) -> str:
    return f"CAST({x} AS STRING)"


STOPS_SQL = {
    "stop_id": f"concat('S', {_s('s_suppkey')})",
    "stop_name": (
        "concat(CASE s_suppkey % 10 WHEN 0 THEN 'Paris' WHEN 1 THEN 'Lyon' WHEN 2 THEN 'Berlin' "
        # Two spellings of one name: places are compared without case and accents.
        "WHEN 3 THEN (CASE WHEN s_suppkey % 20 = 3 THEN 'Zürich HB' ELSE 'ZURICH hb' END) "
        "WHEN 4 THEN (CASE s_suppkey % 40 WHEN 4 THEN 'Łódź' WHEN 14 THEN 'LODZ' "
        "WHEN 24 THEN 'Køge' ELSE 'KOGE' END) WHEN 5 THEN 'Madrid' WHEN 6 THEN 'Unknown' "
        "WHEN 7 THEN 'Wien' WHEN 8 THEN 'Lisboa' ELSE (CASE s_suppkey % 40 WHEN 9 THEN 'Αθήνα' "
        "WHEN 19 THEN 'ΑΘΗΝΑ' WHEN 29 THEN 'Straße' ELSE 'STRASSE' END) END, ' ', "
        f"{_s('CAST(floor(s_suppkey / 20) AS INT)')})"),
    "stop_lat": ("CASE WHEN s_suppkey % 11 = 7 THEN NULL "
                 "ELSE CAST(3400 + ((s_suppkey * 7919) % 3600) AS DOUBLE) / 100 END"),
    "stop_lon": ("CASE WHEN s_suppkey % 13 = 9 THEN NULL "
                 "ELSE CAST(((s_suppkey * 104729) % 4400) - 1200 AS DOUBLE) / 100 END"),
}

AGENCY_SQL = {
    "agency_id": f"concat('A', {_s('n_nationkey')})",
    "agency_name": ("CASE n_nationkey % 6 WHEN 0 THEN (CASE WHEN n_nationkey % 12 = 0 "
                    "THEN 'SNCF' ELSE 'Sncf' END) WHEN 1 THEN 'DB:Fernverkehr' "
                    "WHEN 2 THEN (CASE WHEN n_nationkey % 12 = 2 THEN 'OBB NIGHTJET' "
                    "ELSE 'ÖBB Nightjet' END) WHEN 3 THEN 'Regio Nord' "
                    "WHEN 4 THEN 'Compagnie X' ELSE NULL END"),
}

ROUTES_SQL = {
    "route_id": f"concat('R', {_s('c_custkey')})",
    "agency_id": f"concat('A', {_s('c_nationkey')})",
    "route_short_name": ("CASE c_custkey % 9 WHEN 0 THEN '---/---' WHEN 1 THEN '' "
                         "WHEN 2 THEN 'TGV 1' WHEN 3 THEN 'IC 7' WHEN 4 THEN 'RE 5' "
                         "WHEN 5 THEN 'NJ 4' WHEN 6 THEN NULL WHEN 7 THEN 'AUTORAIL 2' "
                         "ELSE 'X9' END"),
    "route_long_name": ("CASE c_custkey % 4 WHEN 0 THEN '---/---' WHEN 1 THEN 'Nord - Sud' "
                        "WHEN 2 THEN NULL ELSE 'Ligne 3' END"),
    "route_type": ("CASE c_custkey % 8 WHEN 0 THEN '101' WHEN 1 THEN '102' WHEN 2 THEN '103' "
                   "WHEN 3 THEN '106' WHEN 4 THEN '107' WHEN 5 THEN '2' WHEN 6 THEN '3' "
                   "ELSE NULL END"),
}

CALENDAR_BASE_SQL = ("SELECT DISTINCT substr(o_orderpriority, 1, 1) AS p, o_orderstatus AS st "
                     "FROM orders")
CALENDAR_SQL = {
    "service_id": "concat(p, st)",
    "monday": "CASE WHEN p IN ('1', '2', '3') THEN '1' ELSE '0' END",
    "tuesday": "CASE WHEN p IN ('1', '2') THEN '1' ELSE '0' END",
    "wednesday": "CASE WHEN p = '1' THEN '1' ELSE '0' END",
    "thursday": "CASE WHEN p = '1' AND st = 'F' THEN '1' ELSE '0' END",
    "friday": "CASE WHEN p IN ('2', '5') THEN '1' ELSE '0' END",
    "saturday": "CASE WHEN st = 'O' THEN '1' ELSE '0' END",
    "sunday": "'0'",
}
CALENDAR_DUPLICATE = "3F"  # service added twice to exercise the join fan-out

TRIPS_SQL = {
    "dataset_id": f"concat('ds', {_s('o_orderkey % 3')})",
    # The same trip id occurs in every feed.
    "trip_id": (f"CASE WHEN o_orderkey % 97 = 5 THEN '  ' "
                f"ELSE {_s('CAST(floor(o_orderkey / 3) AS BIGINT)')} END"),
    # Some trips name a route or a service that does not exist (join misses).
    "route_id": (f"CASE WHEN o_orderkey % 89 = 7 THEN concat('X', {_s('o_custkey')}) "
                 f"ELSE concat('R', {_s('o_custkey')}) END"),
    "service_id": ("CASE WHEN o_orderkey % 83 = 11 THEN '9X' "
                   "ELSE concat(substr(o_orderpriority, 1, 1), o_orderstatus) END"),
    "file_row": "o_orderkey",
}

STOP_TIMES_CLOCK = ("CAST(((l_orderkey * 611) % 1440) + l_linenumber * 35 + l_partkey % 7 AS INT)")
STOP_TIMES_SQL = {
    "dataset_id": f"concat('ds', {_s('l_orderkey % 3')})",
    "trip_id": _s("CAST(floor(l_orderkey / 3) AS BIGINT)"),
    "stop_id": f"concat('S', {_s('l_suppkey')})",
    "stop_sequence": f"CASE WHEN l_partkey % 101 = 3 THEN 'x' ELSE {_s('l_linenumber')} END",
    "departure_time": (
        "CASE WHEN l_partkey % 41 = 0 THEN NULL WHEN l_partkey % 43 = 0 THEN 'bad' "
        f"ELSE concat(lpad({_s('CAST(floor(t / 60) AS INT)')}, 2, '0'), ':', "
        f"lpad({_s('t % 60')}, 2, '0'), ':00') END"),
    "arrival_time": (
        "CASE WHEN l_partkey % 37 = 0 THEN NULL "
        f"ELSE concat(lpad({_s('CAST(floor((t - 2) / 60) AS INT)')}, 2, '0'), ':', "
        f"lpad({_s('(t - 2) % 60')}, 2, '0'), ':00') END"),
    "shape_dist_traveled": (
        "CASE l_orderkey % 3 WHEN 0 THEN l_linenumber * 45000e0 + l_quantity * 1000e0 "
        "WHEN 1 THEN (CASE WHEN l_partkey % 5 = 0 THEN NULL "
        "ELSE l_linenumber * 60e0 + l_quantity END) ELSE NULL END"),
}
# Row order inside the stop_times "file": (l_partkey, l_suppkey), then the
# line number so that ties are impossible.
STOP_TIMES_ORDER = ["l_partkey", "l_suppkey", "l_linenumber"]


# Summary-shaped rows over the whole of lineitem and part that break every
# clean-up rule somewhere: blank ids, durations and distances at or below zero,
# negative emissions, equal ends, over-long country texts and unknown codes.
RAW_SUMMARY_SQL = {
    "dataset_id": f"concat('ds', {_s('l_orderkey % 3')})",
    "trip_id": ("CASE WHEN l_partkey % 53 = 1 THEN NULL WHEN l_partkey % 59 = 2 THEN '   ' "
                f"ELSE {_s('l_orderkey')} END"),
    "duration_h": ("CASE WHEN l_suppkey % 31 = 4 THEN NULL "
                   "ELSE (l_linenumber - 2) / 4e0 END"),
    "distance_km": "CASE WHEN l_suppkey % 37 = 5 THEN NULL ELSE l_quantity - 5e0 END",
    "emission_gco2e_pkm": "round(l_discount * 100 - 2e0, 2)",
    "total_emission_kgco2e": "round(l_tax * 100 - 1e0, 3)",
    "origin_stop_name": "p_name",
    "destination_stop_name": "CASE WHEN l_linenumber = 4 THEN p_name ELSE p_brand END",
    "origin_country": ("CASE WHEN l_partkey % 7 = 0 THEN concat(p_type, ' ', p_brand, ' ', p_name, ' ', p_name) "
                       "WHEN l_partkey % 7 = 1 THEN NULL ELSE p_type END"),
    "destination_country": "CASE WHEN l_partkey % 5 = 0 THEN 'FR' ELSE p_name END",
    "file_row": "l_partkey * 100000000 + l_suppkey * 1000 + l_linenumber",
    "cal_row": "CAST(0 AS BIGINT)",
}


def raw_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary-shaped rows of ``RAW_SUMMARY_SQL`` as a DataFrame."""
    li, part = read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "part")
    return _sel(li.join(part, li["l_partkey"] == part["p_partkey"]), RAW_SUMMARY_SQL)


def raw_summary_sql() -> str:
    cols = ", ".join(f"{v} AS {k}" for k, v in RAW_SUMMARY_SQL.items())
    return f"rawsum AS (SELECT {cols} FROM lineitem JOIN part ON l_partkey = p_partkey)"


@dataclass(frozen=True)
class Feed:
    """One DataFrame per GTFS file, all feeds of a run stacked together.

    ``trips`` and ``stop_times`` carry ``dataset_id``; the reference tables
    (stops, agency, routes, calendar) may carry it too, and are joined on it
    only when they do (tables shared by every feed omit it).
    """

    stops: DataFrame
    agency: DataFrame
    routes: DataFrame
    calendar: DataFrame
    trips: DataFrame
    stop_times: DataFrame


def _sel(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{v} AS {k}" for k, v in exprs.items()])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def feed_from_driver(spark: SparkSession, sf_dir: str) -> Feed:
    """The GTFS feed derived from the driver tables under ``sf_dir``."""
    t = lambda n: read_table(spark, sf_dir, n)
    stops = _sel(t("supplier"), STOPS_SQL)
    agency = _sel(t("nation"), AGENCY_SQL)
    routes = _sel(t("customer"), ROUTES_SQL)
    base = (t("orders").select(F.substring("o_orderpriority", 1, 1).alias("p"),
                               F.col("o_orderstatus").alias("st"))
            .distinct())
    cal = _sel(base, CALENDAR_SQL)
    calendar = cal.unionAll(cal.where(F.col("service_id") == CALENDAR_DUPLICATE))
    calendar = calendar.withColumn("file_row", F.lit(0).cast("bigint"))
    trips = _sel(t("orders"), TRIPS_SQL)
    li = t("lineitem").withColumn("t", F.expr(STOP_TIMES_CLOCK))
    stop_times = li.selectExpr(
        *[f"{v} AS {k}" for k, v in STOP_TIMES_SQL.items()],
        f"struct({', '.join(STOP_TIMES_ORDER)}) AS file_row")
    return Feed(stops, agency, routes, calendar, trips, stop_times)


def oracle_views_sql() -> str:
    """The same six views as DuckDB CTE text (``name AS (SELECT …)``)."""
    def sel(exprs: dict[str, str]) -> str:
        return ", ".join(f"{v} AS {k}" for k, v in exprs.items())

    cal = f"SELECT {sel(CALENDAR_SQL)} FROM ({CALENDAR_BASE_SQL}) q"
    return ",\n".join([
        f"v_stops AS (SELECT {sel(STOPS_SQL)} FROM supplier)",
        f"v_agency AS (SELECT {sel(AGENCY_SQL)} FROM nation)",
        f"v_routes AS (SELECT {sel(ROUTES_SQL)} FROM customer)",
        f"v_cal0 AS ({cal})",
        "v_calendar AS (SELECT * FROM v_cal0 UNION ALL "
        f"SELECT * FROM v_cal0 WHERE service_id = '{CALENDAR_DUPLICATE}')",
        f"v_trips AS (SELECT {sel(TRIPS_SQL)} FROM orders)",
        f"v_stop_times AS (SELECT {sel(STOP_TIMES_SQL)}, "
        f"{', '.join(f'{c} AS o_{c}' for c in STOP_TIMES_ORDER)} "
        f"FROM (SELECT *, {STOP_TIMES_CLOCK} AS t FROM lineitem) q)",
    ])

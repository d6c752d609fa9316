"""Registered queries: one per operator of the inventory, each with its DuckDB twin.

Every query reads the driver tables under ``sf_dir`` in full (through the
GTFS views) and returns a DataFrame; ``ORACLE`` holds the SQL that computes
the same rows with DuckDB. Column names match between the two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (clean_country, country_of_name, country_of_point, day_night,
                         haversine_km, is_valid_numeric, round_half_up, route_id_of,
                         agency_id_of, route_title, time_to_seconds, transport_type)
from ..operators import reports as R
from ..operators import warehouse as W
from ..operators.quality import country_offenders, sanitize, sanitize_report, validate_rows
from ..operators.stop_times import (TRIP_KEY, feed_shape_flags, prepare_stop_times, shape_falls,
                                    stop_coordinates)
from ..operators.trips import SUMMARY_COLUMNS, classify, enrich_trips, first_per_trip
from ..sources.countries import COUNTRIES, country_seed
from ..sources.driver_views import raw_summary, raw_summary_sql, read_table
from . import oracle as O
from .pipeline import Pipeline, pipeline_for

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Fixed parameters of the registered report queries.
SEARCH = dict(origin="zurich", min_distance=50.0, limit=50)
SEARCH_ALL = dict(origin="PAR", destination="l", train_type="REGIONAL", min_distance=0.5,
                  max_distance=100000.0, limit=50)
REF_POINT = (48.8566, 2.3522)  # distance reference for the haversine query


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _p(spark: SparkSession, sf_dir: str) -> Pipeline:
    return pipeline_for(spark, sf_dir)


# --- scalar functions over whole tables ---------------------------------------

@register("gtfs_time_sec", O.with_pipeline(
    f"""SELECT time_text, {O.tsec('time_text')} AS seconds FROM
    (SELECT departure_time AS time_text FROM v_stop_times UNION
     SELECT arrival_time FROM v_stop_times) t"""))
def q_gtfs_time_sec(spark, sf_dir):
    st = _p(spark, sf_dir).feed.stop_times
    t = (st.select(F.col("departure_time").alias("time_text"))
         .union(st.select(F.col("arrival_time").alias("time_text"))).distinct())
    return t.select("time_text", time_to_seconds(F.col("time_text")).alias("seconds"))


@register("day_night", O.with_pipeline(
    f"""SELECT time_text, {O.day_night('time_text')} AS service_type FROM
    (SELECT DISTINCT departure_time AS time_text FROM v_stop_times) t"""))
def q_day_night(spark, sf_dir):
    st = _p(spark, sf_dir).feed.stop_times
    t = st.select(F.col("departure_time").alias("time_text")).distinct()
    return t.select("time_text", day_night(F.col("time_text")).alias("service_type"))


@register("haversine", O.with_pipeline(
    f"""SELECT stop_id, {O.rnd(O.haversine(repr(REF_POINT[0]), repr(REF_POINT[1]), 'lat', 'lon'), 3)}
    AS km_from_paris FROM coords WHERE lat IS NOT NULL AND lon IS NOT NULL"""))
def q_haversine(spark, sf_dir):
    c = stop_coordinates(_p(spark, sf_dir).feed.stops).where("lat IS NOT NULL AND lon IS NOT NULL")
    d = haversine_km(F.lit(REF_POINT[0]), F.lit(REF_POINT[1]), F.col("lat"), F.col("lon"))
    return c.select("stop_id", round_half_up(d, 3).alias("km_from_paris"))


@register("country_by_name", O.with_pipeline(
    f"""SELECT stop_name, {O.name_country('stop_name')} AS country FROM
    (SELECT DISTINCT stop_name FROM v_stops) t"""))
def q_country_by_name(spark, sf_dir):
    s = _p(spark, sf_dir).feed.stops.select("stop_name").distinct()
    return s.select("stop_name", country_of_name("stop_name").alias("country"))


@register("stop_country", O.with_pipeline(
    "SELECT stop_id, box_country AS country FROM labels"))
def q_stop_country(spark, sf_dir):
    s = stop_coordinates(_p(spark, sf_dir).feed.stops)
    return s.select("stop_id", country_of_point("lat", "lon").alias("country"))


@register("route_title", O.with_pipeline(
    f"""SELECT route_id, {O.route_title('route_short_name', 'route_long_name', "'Origin'",
                                        "'Destination'")} AS route_name FROM v_routes"""))
def q_route_title(spark, sf_dir):
    r = _p(spark, sf_dir).feed.routes
    return r.select("route_id", route_title(F.col("route_short_name"), F.col("route_long_name"),
                                            F.lit("Origin"), F.lit("Destination"))
                    .alias("route_name"))


@register("transport_type", O.with_pipeline(
    f"""SELECT route_type, {O.transport_type('route_type')} AS transport_type FROM
    (SELECT DISTINCT route_type FROM v_routes) t"""))
def q_transport_type(spark, sf_dir):
    r = _p(spark, sf_dir).feed.routes.select("route_type").distinct()
    return r.select("route_type", transport_type(F.col("route_type")).alias("transport_type"))


@register("clean_country", f"""WITH {raw_summary_sql()}, texts AS (
    SELECT origin_country AS raw_text FROM rawsum UNION SELECT destination_country FROM rawsum)
    SELECT raw_text, {O.clean_country('raw_text')} AS country FROM texts""")
def q_clean_country(spark, sf_dir):
    raw = raw_summary(spark, sf_dir)
    texts = raw.select(F.col("origin_country").alias("raw_text")).union(
        raw.select("destination_country")).distinct()
    return texts.select("raw_text", clean_country(F.col("raw_text")).alias("country"))


@register("valid_numeric", O.with_pipeline(
    f"""SELECT raw_text, {O.valid_numeric('raw_text')} AS is_numeric FROM
    (SELECT stop_sequence AS raw_text FROM v_stop_times UNION
     SELECT departure_time FROM v_stop_times UNION
     SELECT CAST(shape_dist_traveled AS VARCHAR) FROM v_stop_times
       WHERE shape_dist_traveled IS NOT NULL) t"""))
def q_valid_numeric(spark, sf_dir):
    st = _p(spark, sf_dir).feed.stop_times
    t = (st.select(F.col("stop_sequence").alias("raw_text"))
         .union(st.select("departure_time"))
         .union(st.where("shape_dist_traveled IS NOT NULL")
                .select(F.col("shape_dist_traveled").cast("string")))
         .distinct())
    return t.select("raw_text", is_valid_numeric(F.col("raw_text")).alias("is_numeric"))


@register("route_id_of", O.with_pipeline(
    """SELECT DISTINCT route_name, split_part(route_name, ' - ', 1) AS route_id,
    agency_name, split_part(agency_name, ':', 1) AS agency_id FROM summary"""))
def q_route_id_of(spark, sf_dir):
    s = _p(spark, sf_dir).summary
    return s.select("route_name", route_id_of(F.col("route_name")).alias("route_id"),
                    "agency_name", agency_id_of(F.col("agency_name")).alias("agency_id")).distinct()


# --- stop_times stages ----------------------------------------------------------

@register("prep_stop_times", O.with_pipeline(
    """SELECT dataset_id, count(*) AS rows, count(*) FILTER (WHERE seq = 0) AS zero_seq_rows
    FROM st0 WHERE trip_id <> '' GROUP BY dataset_id"""))
def q_prep_stop_times(spark, sf_dir):
    st = prepare_stop_times(_p(spark, sf_dir).feed.stop_times)
    return st.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col("seq") == 0, 1)).alias("zero_seq_rows"))


@register("shape_monotonic", O.with_pipeline(
    """SELECT dataset_id, count(*) FILTER (WHERE coalesce(shape < prev_shape, false)) AS dropped_rows,
    count(*) FILTER (WHERE NOT coalesce(shape < prev_shape, false)) AS kept_rows
    FROM st1 GROUP BY dataset_id"""))
def q_shape_monotonic(spark, sf_dir):
    st = prepare_stop_times(_p(spark, sf_dir).feed.stop_times)
    falls = shape_falls(st)
    return falls.groupBy("dataset_id").agg(
        F.count_if("falls").alias("dropped_rows"), F.count_if(~F.col("falls")).alias("kept_rows"))


def _facts(spark, sf_dir):
    return _p(spark, sf_dir)._facts


def _facts_by_flag(spark, sf_dir):
    flag = feed_shape_flags(_p(spark, sf_dir).feed.stop_times)
    flag = flag.withColumnRenamed("feed_has_shape", "f")
    return _facts(spark, sf_dir).join(F.broadcast(flag), "dataset_id")


@register("trip_endpoints", O.with_pipeline(
    """SELECT dataset_id, trip_id, origin_stop_id, destination_stop_id, departure_time,
    arrival_time FROM pt2"""))
def q_trip_endpoints(spark, sf_dir):
    return _facts(spark, sf_dir).select(*TRIP_KEY, "origin_stop_id", "destination_stop_id",
                                        "departure_time", "arrival_time")


@register("trip_duration", O.with_pipeline(
    "SELECT dataset_id, trip_id, duration_min FROM pt2"))
def q_trip_duration(spark, sf_dir):
    return _facts(spark, sf_dir).select(*TRIP_KEY, "duration_min")


@register("trip_distance_shape", O.with_pipeline(
    """SELECT dataset_id, trip_id, shape_km FROM pt2 JOIN feedflag USING (dataset_id)
    WHERE f"""))
def q_trip_distance_shape(spark, sf_dir):
    return _facts_by_flag(spark, sf_dir).where("f").select(*TRIP_KEY, "shape_km")


@register("trip_distance_geo", O.with_pipeline(
    """SELECT dataset_id, trip_id, geo_km FROM pt2 JOIN feedflag USING (dataset_id)
    WHERE NOT f"""))
def q_trip_distance_geo(spark, sf_dir):
    return _facts_by_flag(spark, sf_dir).where("NOT f").select(*TRIP_KEY, "geo_km")


# --- trip summary stages --------------------------------------------------------

@register("enrich_trips", O.with_pipeline(
    """SELECT dataset_id, trip_id, route_id, service_id, route_type, agency_name, monday, tuesday,
    wednesday, thursday, friday, saturday, sunday FROM enr"""))
def q_enrich_trips(spark, sf_dir):
    e = enrich_trips(_p(spark, sf_dir).feed)
    return e.select("dataset_id", "trip_id", "route_id", "service_id", "route_type", "agency_name",
                    "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


SUMMARY_SQL_COLS = ", ".join(["dataset_id", *SUMMARY_COLUMNS])


@register("trips_summary", O.with_pipeline(f"SELECT {SUMMARY_SQL_COLS} FROM summary"))
def q_trips_summary(spark, sf_dir):
    return _p(spark, sf_dir).summary


@register("weekly_frequency", O.with_pipeline(
    """SELECT frequency_per_week, count(*) AS trips FROM summary GROUP BY frequency_per_week"""))
def q_weekly_frequency(spark, sf_dir):
    return _p(spark, sf_dir).summary.groupBy("frequency_per_week") \
        .agg(F.count(F.lit(1)).alias("trips"))


@register("train_class", O.with_pipeline(
    "SELECT train_type, count(*) AS trips FROM summary GROUP BY train_type"))
def q_train_class(spark, sf_dir):
    return _p(spark, sf_dir).summary.groupBy("train_type").agg(F.count(F.lit(1)).alias("trips"))


@register("traction", O.with_pipeline(
    "SELECT train_type, traction, count(*) AS trips FROM summary GROUP BY train_type, traction"))
def q_traction(spark, sf_dir):
    return _p(spark, sf_dir).summary.groupBy("train_type", "traction") \
        .agg(F.count(F.lit(1)).alias("trips"))


@register("emissions", O.with_pipeline(
    """SELECT train_type, traction, emission_gco2e_pkm, count(*) AS trips,
    CAST(sum(CAST(total_emission_kgco2e AS DECIMAL(18,3))) AS DOUBLE) AS total_kgco2e
    FROM summary GROUP BY train_type, traction, emission_gco2e_pkm"""))
def q_emissions(spark, sf_dir):
    s = _p(spark, sf_dir).summary
    return s.groupBy("train_type", "traction", "emission_gco2e_pkm").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum(F.col("total_emission_kgco2e").cast("decimal(18,3)")).cast("double")
        .alias("total_kgco2e"))


@register("service_days", O.with_pipeline(
    "SELECT service_days, count(*) AS trips FROM classified GROUP BY service_days"))
def q_service_days(spark, sf_dir):
    p = _p(spark, sf_dir)
    rows = classify(first_per_trip(p._rows)
                    .withColumn("departures", F.lit(None).cast("bigint")), p.feed.stops)
    return rows.groupBy("service_days").agg(F.count(F.lit(1)).alias("trips"))


def _classified_all(p: Pipeline) -> DataFrame:
    return classify(p._rows.withColumn("departures", F.lit(None).cast("bigint")),
                    p.feed.stops)


SANITIZE_RULES_SQL = """CASE WHEN trim(coalesce(trip_id, '')) = '' THEN 'missing_trip_id'
    WHEN coalesce(duration_h <= 0, true) THEN 'invalid_duration'
    WHEN coalesce(distance_km < 0, true) THEN 'invalid_distance'
    WHEN coalesce(origin_stop_name = destination_stop_name, false) THEN 'same_origin_destination'
    END"""

ALLROWS_SQL = f"""allrows AS (SELECT *, {SANITIZE_RULES_SQL} AS rule0 FROM
    (SELECT jrows.* REPLACE ({O.rnd('jrows.distance_km', 3)} AS distance_km),
      ends2.origin_stop_name, ends2.destination_stop_name,
      {O.rnd('jrows.duration_min / 60.0', 2)} AS duration_h
     FROM jrows JOIN (SELECT DISTINCT dataset_id, trip_id, origin_stop_name,
       destination_stop_name FROM ends) ends2 USING (dataset_id, trip_id)) x)"""


@register("sanitize_report", O.with_pipeline(
    """SELECT dataset_id, rule, count(*) AS rows FROM ruled WHERE rule IS NOT NULL
    GROUP BY dataset_id, rule UNION ALL SELECT dataset_id, 'total_removed', count(*)
    FROM ruled WHERE rule IS NOT NULL GROUP BY dataset_id""",
    extra=[ALLROWS_SQL, """ruled AS (SELECT dataset_id, CASE WHEN rule0 IS NULL AND row_number()
      OVER (PARTITION BY dataset_id, trip_id, rule0 ORDER BY file_row, cal_row) > 1
      THEN 'duplicate_trip_id' ELSE rule0 END AS rule FROM allrows)"""]))
def q_sanitize_report(spark, sf_dir):
    return sanitize_report(_classified_all(_p(spark, sf_dir)))


@register("sanitize_trips", O.with_pipeline(
    "SELECT DISTINCT dataset_id, trip_id, rule0 AS rule FROM allrows WHERE rule0 IS NOT NULL",
    extra=[ALLROWS_SQL]))
def q_sanitize_trips(spark, sf_dir):
    from ..operators.quality import sanitize_rule
    c = _classified_all(_p(spark, sf_dir))
    return c.select("dataset_id", "trip_id", sanitize_rule(c).alias("rule")) \
        .where("rule IS NOT NULL").distinct()


@register("dedup_trips", O.with_pipeline(
    """SELECT dataset_id, trip_id, count(*) AS copies FROM jrows GROUP BY dataset_id, trip_id
    HAVING count(*) > 1"""))
def q_dedup_trips(spark, sf_dir):
    r = _p(spark, sf_dir)._rows
    return r.groupBy(*TRIP_KEY).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


# --- load: staging, dimensions, fact ------------------------------------------

@register("validate_rows", O.with_warehouse(
    "SELECT dataset_id, trip_id, reject_reason FROM tagged WHERE reject_reason IS NOT NULL"))
def q_validate_rows(spark, sf_dir):
    _, rejected = validate_rows(_p(spark, sf_dir).summary)
    return rejected.select("dataset_id", "trip_id", "reject_reason")


@register("stage_rows", O.with_warehouse("SELECT * FROM staging"))
def q_stage_rows(spark, sf_dir):
    return _p(spark, sf_dir).warehouse.staging


# Rows that break every rule somewhere (the timetable views cannot): P3-P7, P12, J14.
RAW = f"WITH {raw_summary_sql()}"


@register("sanitize_raw_rows", f"""{RAW}, ruled AS (SELECT *, CASE
    WHEN trip_id IS NULL OR trim(trip_id) = '' THEN 'missing_trip_id'
    WHEN coalesce(duration_h <= 0, true) THEN 'invalid_duration'
    WHEN coalesce(distance_km < 0, true) THEN 'invalid_distance'
    WHEN coalesce(origin_stop_name = destination_stop_name, false)
      THEN 'same_origin_destination' END AS rule FROM rawsum)
    SELECT trip_id, duration_h, distance_km, origin_stop_name, destination_stop_name,
    CASE WHEN emission_gco2e_pkm >= 0 THEN emission_gco2e_pkm END AS emission_gco2e_pkm,
    CASE WHEN total_emission_kgco2e >= 0 THEN total_emission_kgco2e END AS total_emission_kgco2e
    FROM ruled WHERE rule IS NULL""")
def q_sanitize_raw_rows(spark, sf_dir):
    return sanitize(raw_summary(spark, sf_dir)).select(
        "trip_id", "duration_h", "distance_km", "origin_stop_name", "destination_stop_name",
        "emission_gco2e_pkm", "total_emission_kgco2e")


@register("sanitize_raw_report", f"""{RAW}, rules AS (SELECT *, CASE
    WHEN trip_id IS NULL OR trim(trip_id) = '' THEN 'missing_trip_id'
    WHEN coalesce(duration_h <= 0, true) THEN 'invalid_duration'
    WHEN coalesce(distance_km < 0, true) THEN 'invalid_distance'
    WHEN coalesce(origin_stop_name = destination_stop_name, false)
      THEN 'same_origin_destination' END AS rule0 FROM rawsum),
    ruled AS (SELECT *, CASE WHEN rule0 IS NULL AND row_number() OVER (
      PARTITION BY dataset_id, trip_id, rule0 ORDER BY file_row, cal_row) > 1
      THEN 'duplicate_trip_id' ELSE rule0 END AS rule FROM rules)
    SELECT dataset_id, rule, count(*) AS rows FROM ruled WHERE rule IS NOT NULL GROUP BY ALL
    UNION ALL SELECT dataset_id, 'total_removed', count(*) FROM ruled WHERE rule IS NOT NULL
    GROUP BY dataset_id
    UNION ALL SELECT dataset_id, 'negative_emission_nulled', count(*) FROM ruled WHERE rule IS NULL
      AND (emission_gco2e_pkm < 0 OR total_emission_kgco2e < 0) GROUP BY dataset_id""")
def q_sanitize_raw_report(spark, sf_dir):
    return sanitize_report(raw_summary(spark, sf_dir))


@register("country_offenders", f"""{RAW} SELECT dataset_id, trip_id, origin_country,
    CAST(length(origin_country) AS INTEGER) AS origin_len, destination_country,
    CAST(length(destination_country) AS INTEGER) AS dest_len FROM rawsum
    WHERE length(origin_country) > 30 OR length(destination_country) > 30""")
def q_country_offenders(spark, sf_dir):
    return country_offenders(raw_summary(spark, sf_dir))


def _dim(spark, sf_dir, name, cols):
    return _p(spark, sf_dir).warehouse.dims[name].select(*cols)


@register("dim_country", O.with_warehouse("SELECT country_code, country_name FROM dim_country"))
def q_dim_country(spark, sf_dir):
    return _dim(spark, sf_dir, "dim_country", ["country_code", "country_name"])


@register("dim_time", O.with_warehouse("SELECT time_value, hour, minute, second FROM dim_time"))
def q_dim_time(spark, sf_dir):
    return _dim(spark, sf_dir, "dim_time", ["time_value", "hour", "minute", "second"])


@register("dim_location", O.with_warehouse("SELECT stop_name, country_code FROM dim_location"))
def q_dim_location(spark, sf_dir):
    return _dim(spark, sf_dir, "dim_location", ["stop_name", "country_code"])


@register("dim_route_latest", O.with_warehouse("SELECT route_id, route_name FROM dim_route"))
def q_dim_route_latest(spark, sf_dir):
    return _dim(spark, sf_dir, "dim_route", ["route_id", "route_name"])


DIM_KEY_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS dimension, CAST(count(*) AS BIGINT) AS keys FROM ({sql}) t"
    for name, sql in [
        ("dim_dataset", "SELECT DISTINCT dataset_id FROM staging"),
        ("dim_trip", "SELECT DISTINCT trip_id FROM staging"),
        ("dim_route", "SELECT * FROM dim_route"),
        ("dim_agency", "SELECT * FROM dim_agency"),
        ("dim_service_type", "SELECT DISTINCT service_type FROM staging"),
        ("dim_train_type", "SELECT DISTINCT train_type FROM staging"),
        ("dim_traction", "SELECT DISTINCT traction FROM staging"),
        ("dim_country", "SELECT * FROM dim_country"),
        ("dim_location", "SELECT * FROM dim_location"),
        ("dim_time", "SELECT * FROM dim_time"),
    ])


@register("dim_keys", O.with_warehouse(DIM_KEY_SQL))
def q_dim_keys(spark, sf_dir):
    dims = _p(spark, sf_dir).warehouse.dims
    parts = [dims[n].agg(F.count(F.lit(1)).alias("keys")).select(F.lit(n).alias("dimension"),
                                                                  "keys")
             for n in dims]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


FACT_COLS = ["trip_id", "dataset_id", "route_name", "agency_name", "service_type", "train_type",
             "traction", "origin", "origin_country", "destination", "destination_country",
             "departure_time", "arrival_time", "distance_km", "duration_h",
             "emission_gco2e_pkm", "total_emission_kgco2e", "frequency_per_week", "last_load_id"]


@register("build_fact", O.with_warehouse(
    """SELECT trip_id, dataset_id, dim_route_name AS route_name, dim_agency_name AS agency_name,
    service_type, train_type, traction, origin_stop_name AS origin, origin_country,
    destination_stop_name AS destination, destination_country, departure_time, arrival_time,
    distance_km, duration_h, emission_gco2e_pkm, total_emission_kgco2e, frequency_per_week,
    load_id AS last_load_id FROM fact"""))
def q_build_fact(spark, sf_dir):
    return R.fact_details(_p(spark, sf_dir).warehouse).select(*FACT_COLS)


STRICT_WHERE = (f"{O.tsec('departure_time')} IS NOT NULL AND {O.tsec('arrival_time')} IS NOT NULL")


@register("build_fact_strict", O.with_warehouse(
    f"""SELECT trip_id, dataset_id, route_id, agency_id, service_type, origin_stop_name,
    destination_stop_name, departure_time, arrival_time, distance_km, duration_h FROM staging
    WHERE {STRICT_WHERE}"""))
def q_build_fact_strict(spark, sf_dir):
    return W.build_fact_strict(_p(spark, sf_dir).warehouse.staging)


@register("trip_view", O.with_warehouse(
    """SELECT dataset_id || ':' || trip_id AS fact_id, trip_id, dim_route_name AS route_name,
    dim_agency_name AS agency_name, service_type, origin_stop_name AS origin,
    destination_stop_name AS destination, departure_time, arrival_time, distance_km, duration_h
    FROM fact WHERE departure_time IS NOT NULL AND arrival_time IS NOT NULL"""))
def q_trip_view(spark, sf_dir):
    R.trip_view(_p(spark, sf_dir).warehouse, view="trip_view")
    return spark.table("trip_view")


@register("orphan_countries", f"""{RAW} SELECT DISTINCT c AS country_code FROM
    (SELECT {O.clean_country('origin_country')} AS c FROM rawsum
     UNION SELECT {O.clean_country('destination_country')} FROM rawsum) t
    WHERE c IS NOT NULL AND c NOT IN ({', '.join(O.q(c) for c, _ in COUNTRIES)})""")
def q_orphan_countries(spark, sf_dir):
    raw = raw_summary(spark, sf_dir)
    places = raw.select("origin_stop_name", "origin_country").union(
        raw.select("destination_stop_name", "destination_country")).toDF("stop_name", "raw")
    places = places.select("stop_name", clean_country(F.col("raw")).alias("country_code"))
    return W.orphan_countries(places, country_seed(spark))


def _two_loads(spark, sf_dir):
    """Load 1 = every feed; load 2 = feed ds1 again (a re-run), upserted. A dimension
    reads each load's staging rows once, so nothing is kept."""
    p = _p(spark, sf_dir)
    first = W.load_warehouse(p.summary, 1, "2025-01-01 00:00:00", keep=())
    again = p.summary.where(F.col("source_dataset") == "ds1")
    return W.load_warehouse(again, 2, "2025-01-02 00:00:00", existing=first, keep=())


@register("upsert_fact", O.with_warehouse(
    """SELECT trip_id, dataset_id, CAST(CASE WHEN dataset_id = 'ds1' THEN 2 ELSE 1 END AS BIGINT)
    AS last_load_id, distance_km, duration_h, emission_gco2e_pkm, total_emission_kgco2e,
    frequency_per_week FROM staging"""))
def q_upsert_fact(spark, sf_dir):
    """Every feed loaded with each row sent twice, then feed ds1 sent again."""
    p = _p(spark, sf_dir)
    # Each row twice in one pass: a union would derive the summary twice.
    twice = p.summary.withColumn("sent", F.explode(F.array(F.lit(1), F.lit(2)))).drop("sent")
    first = W.load_warehouse(twice, 1, "2025-01-01 00:00:00", keep=())
    again = p.summary.where(F.col("source_dataset") == "ds1")
    # Only the rows of the second load are read twice: as facts and as keys.
    f = W.load_warehouse(again, 2, "2025-01-02 00:00:00", existing=first, keep=("facts",)).fact
    return f.select("trip_id", "dataset_id", "last_load_id", *W.MEASURES, "frequency_per_week")


@register("upsert_dim", O.with_warehouse(
    f"""SELECT route_id, route_name, load_id FROM (SELECT route_id, route_name,
    CAST(load AS BIGINT) AS load_id, row_number() OVER (PARTITION BY {O.folded('route_id')}
    ORDER BY load DESC, route_name DESC, route_id DESC) AS rn FROM
    (SELECT route_id, route_name, max(CASE WHEN dataset_id = 'ds1' THEN 2 ELSE 1 END) AS load
     FROM staging GROUP BY ALL) a) x WHERE rn = 1"""))
def q_upsert_dim(spark, sf_dir):
    return _two_loads(spark, sf_dir).dims["dim_route"].select("route_id", "route_name", "load_id")


@register("insert_ignore_dim", O.with_warehouse(
    f"""SELECT route_id, route_name FROM (SELECT route_id, route_name, row_number() OVER (
    PARTITION BY {O.folded('route_id')} ORDER BY old DESC, route_name DESC, route_id DESC)
    AS rn FROM (SELECT route_id, route_name, bool_or(dataset_id = 'ds0') AS old FROM staging
    GROUP BY ALL) a) x WHERE rn = 1"""))
def q_insert_ignore_dim(spark, sf_dir):
    st = _p(spark, sf_dir).warehouse.staging
    a = W.build_dimensions(st.where("dataset_id = 'ds0'"), spark)["dim_route"]
    b = W.build_dimensions(st.where("dataset_id <> 'ds0'"), spark)["dim_route"]
    return W.insert_ignore(a, b, ["route_sk"]).select("route_id", "route_name")


# --- reports --------------------------------------------------------------------

AVG = O.avg2
SUM = O.sum2


@register("overview", O.with_warehouse(
    f"""SELECT count(DISTINCT trip_id) AS total_trips, count(DISTINCT {O.folded('route_id')})
    AS total_routes, count(DISTINCT {O.folded('agency_id')}) AS total_agencies, {SUM('distance_km')} AS total_distance_km,
    {SUM('total_emission_kgco2e')} AS total_emissions_kg, {AVG('distance_km')} AS avg_distance_km,
    {AVG('duration_h')} AS avg_duration_h, {AVG('emission_gco2e_pkm')} AS avg_emission_per_km
    FROM fact"""))
def q_overview(spark, sf_dir):
    return R.overview(_p(spark, sf_dir).fact_warehouse)


BY_COUNTRY_SQL = f"""SELECT coalesce(origin_country, 'UNKNOWN') AS country,
    coalesce(origin_country_name, 'Unknown') AS country_name,
    count(DISTINCT trip_id) AS trip_count, {SUM('distance_km')} AS total_distance,
    {SUM('total_emission_kgco2e')} AS total_emissions,
    {AVG('emission_gco2e_pkm')} AS avg_emission_per_km
    FROM fact GROUP BY origin_country, origin_country_name"""


@register("by_country", O.with_warehouse(
    f"{BY_COUNTRY_SQL} ORDER BY trip_count DESC, country, country_name LIMIT 20"))
def q_by_country(spark, sf_dir):
    return R.by_country(_p(spark, sf_dir).fact_warehouse)


BY_TRAIN_SQL = f"""SELECT coalesce(train_type, 'Unknown') AS train_type,
    count(DISTINCT trip_id) AS trip_count, {SUM('distance_km')} AS total_distance,
    {AVG('distance_km')} AS avg_distance, {AVG('duration_h')} AS avg_duration,
    {AVG('emission_gco2e_pkm')} AS avg_emission_per_km FROM fact GROUP BY train_type"""


@register("by_train_type", O.with_warehouse(BY_TRAIN_SQL))
def q_by_train_type(spark, sf_dir):
    return R.by_train_type(_p(spark, sf_dir).fact_warehouse)


BY_TRACTION_SQL = f"""SELECT coalesce(traction, 'Unknown') AS traction,
    count(DISTINCT trip_id) AS trip_count, {AVG('emission_gco2e_pkm')} AS avg_emission_per_km,
    {SUM('total_emission_kgco2e')} AS total_emissions FROM fact GROUP BY traction"""


@register("by_traction", O.with_warehouse(BY_TRACTION_SQL))
def q_by_traction(spark, sf_dir):
    return R.by_traction(_p(spark, sf_dir).fact_warehouse)


@register("by_agency", O.with_warehouse(
    f"""SELECT dim_agency_name AS agency_name, count(DISTINCT trip_id) AS trip_count,
    {SUM('distance_km')} AS total_distance, {AVG('emission_gco2e_pkm')} AS avg_emission_per_km
    FROM fact GROUP BY dim_agency_name ORDER BY trip_count DESC, agency_name LIMIT 10"""))
def q_by_agency(spark, sf_dir):
    return R.by_agency(_p(spark, sf_dir).warehouse)


@register("emissions_by_route", O.with_warehouse(
    f"""SELECT dim_route_name AS route_name, dim_agency_name AS agency_name,
    count(DISTINCT trip_id) AS trip_count, {SUM('total_emission_kgco2e')} AS total_emissions,
    {AVG('emission_gco2e_pkm')} AS avg_emission_per_km, {AVG('distance_km')} AS avg_distance
    FROM fact GROUP BY dim_route_name, dim_agency_name
    ORDER BY total_emissions DESC, route_name, agency_name LIMIT 20"""))
def q_emissions_by_route(spark, sf_dir):
    return R.emissions_by_route(_p(spark, sf_dir).warehouse)


LABEL_SQL = """CASE WHEN upper(coalesce(service_type, '')) = 'JOUR' THEN 'Jour'
    WHEN upper(coalesce(service_type, '')) = 'NUIT' THEN 'Nuit'
    ELSE 'Autre / Non renseigné' END"""


@register("by_service_type", O.with_warehouse(
    f"""SELECT {LABEL_SQL} AS service_type, count(DISTINCT trip_id) AS trip_count
    FROM fact GROUP BY 1"""))
def q_by_service_type(spark, sf_dir):
    return R.by_service_type(_p(spark, sf_dir).fact_warehouse)


@register("fact_count", O.with_warehouse("SELECT count(*) AS count FROM fact"))
def q_fact_count(spark, sf_dir):
    return R.fact_count(_p(spark, sf_dir).fact_warehouse)


@register("load_counts", O.with_warehouse(
    "SELECT load_id, count(*) AS rows_in_batch, count(*) AS fact_rows FROM staging GROUP BY load_id"))
def q_load_counts(spark, sf_dir):
    return R.load_counts(_p(spark, sf_dir).warehouse)


@register("latest_per_trip", O.with_warehouse(
    """SELECT trip_id, dataset_id, distance_km, load_id AS last_load_id FROM
    (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY loaded_at DESC, dataset_id DESC)
     AS rn FROM fact) x WHERE rn = 1"""))
def q_latest_per_trip(spark, sf_dir):
    f = _p(spark, sf_dir).warehouse.fact
    return R.latest_per_trip(f).select("trip_id", "dataset_id", "distance_km", "last_load_id")


def search_sql(where: str) -> str:
    """The search as SQL: filters, then the newest fact per trip id, then the cut."""
    return f"""search AS (SELECT trip_id, dataset_id, distance_km, duration_h,
    total_emission_kgco2e, frequency_per_week, loaded_at AS last_loaded_at,
    dim_route_name AS route_name, dim_agency_name AS agency_name,
    origin_stop_name AS origin, destination_stop_name AS destination, origin_country,
    destination_country, departure_time, arrival_time, train_type, traction, service_type,
    {LABEL_SQL} AS service_label FROM (SELECT *, row_number() OVER (PARTITION BY trip_id
      ORDER BY loaded_at DESC, dataset_id DESC) AS rn FROM fact WHERE {where}) f WHERE rn = 1
    ORDER BY distance_km DESC, trip_id, dataset_id LIMIT {SEARCH['limit']})"""


SEARCH_SQL = search_sql(
    f"contains({O.folded('origin_stop_name')}, {O.folded(O.q(SEARCH['origin']))}) "
    f"AND distance_km >= {SEARCH['min_distance']}")
SEARCH_ALL_SQL = search_sql(
    f"contains({O.folded('origin_stop_name')}, {O.folded(O.q(SEARCH_ALL['origin']))}) "
    f"AND contains({O.folded('destination_stop_name')}, {O.folded(O.q(SEARCH_ALL['destination']))}) "
    f"AND {O.folded('train_type')} = {O.folded(O.q(SEARCH_ALL['train_type']))} "
    f"AND distance_km BETWEEN {SEARCH_ALL['min_distance']} AND {SEARCH_ALL['max_distance']}")


@register("search_trips", O.with_warehouse("SELECT * FROM search", extra=[SEARCH_SQL]))
def q_search_trips(spark, sf_dir):
    return R.search_trips(_p(spark, sf_dir).warehouse, **SEARCH)


@register("search_trips_all_filters", O.with_warehouse("SELECT * FROM search", extra=[SEARCH_ALL_SQL]))
def q_search_trips_all_filters(spark, sf_dir):
    return R.search_trips(_p(spark, sf_dir).warehouse, **SEARCH_ALL)


SEARCHES = {"search_trips_greek": "ΑΘΗΝ", "search_trips_expanded": "strasse", "search_trips_stroke": "odz"}


def _register_search(name: str, origin: str) -> None:
    where = f"contains({O.folded('origin_stop_name')}, {O.folded(O.q(origin))})"

    @register(name, O.with_warehouse("SELECT * FROM search", extra=[search_sql(where)]))
    def query(spark, sf_dir):
        return R.search_trips(_p(spark, sf_dir).warehouse, origin=origin, limit=SEARCH["limit"])


for _name, _origin in SEARCHES.items():
    _register_search(_name, _origin)


@register("trip_labels", f"""WITH {O.warehouse_ctes()},
{SEARCH_SQL}
SELECT trip_id, dataset_id,
  CASE WHEN coalesce(service_type, '') = '' THEN 'Non renseigné'
       WHEN contains(lower(service_type), 'night') OR contains(lower(service_type), 'nuit')
            OR lower(service_type) = 'n' THEN 'Train de nuit'
       WHEN contains(lower(service_type), 'day') OR contains(lower(service_type), 'jour')
            OR lower(service_type) = 'd' THEN 'Train de jour'
       ELSE service_type END AS day_night_label,
  CASE WHEN frequency_per_week IS NULL THEN 'Non renseignée'
       ELSE CAST(frequency_per_week AS VARCHAR) || ' / semaine' END AS frequency_label
FROM search""")
def q_trip_labels(spark, sf_dir):
    return R.trip_labels(R.search_trips(_p(spark, sf_dir).warehouse, **SEARCH))


@register("spotlight", f"""WITH {O.warehouse_ctes()},
bc AS ({BY_COUNTRY_SQL}), bt AS ({BY_TRAIN_SQL}), bx AS ({BY_TRACTION_SQL})
(SELECT 'Pays dominant' AS label, country AS value, CAST(trip_count AS DOUBLE) AS metric FROM bc
 ORDER BY trip_count DESC, country LIMIT 1)
UNION ALL
(SELECT 'Train dominant', train_type, CAST(trip_count AS DOUBLE) FROM bt
 ORDER BY trip_count DESC, train_type LIMIT 1)
UNION ALL
(SELECT 'Traction la plus émissive', traction, avg_emission_per_km FROM bx
 ORDER BY avg_emission_per_km DESC, traction LIMIT 1)""")
def q_spotlight(spark, sf_dir):
    return R.spotlight(_p(spark, sf_dir).fact_warehouse)


@register("top_countries", f"""WITH {O.warehouse_ctes()},
bc AS ({BY_COUNTRY_SQL}), bt AS ({BY_TRAIN_SQL})
(SELECT 'country' AS cut, country AS name, trip_count FROM bc
 ORDER BY trip_count DESC, country LIMIT 10)
UNION ALL
(SELECT 'train_type', train_type, trip_count FROM bt ORDER BY trip_count DESC, train_type LIMIT 8)""")
def q_top_countries(spark, sf_dir):
    return R.top_countries(_p(spark, sf_dir).fact_warehouse)


@register("stops_per_country", O.with_pipeline(
    f"""SELECT country, stop_count, {O.rnd('stop_count * 100.0 / valid_stops', 2)}
    AS pct_of_valid_stops, {O.rnd('mapped * 100.0 / valid_stops', 2)} AS mapped_pct FROM
    (SELECT box_country AS country, count(*) AS stop_count,
       sum(count(*)) OVER () AS valid_stops,
       sum(count(*)) FILTER (WHERE box_country IS NOT NULL) OVER () AS mapped
     FROM (SELECT {O.box_country('lat', 'lon')} AS box_country FROM coords
           WHERE lat IS NOT NULL AND lon IS NOT NULL AND stop_id IS NOT NULL) s
     GROUP BY box_country) t
    WHERE country IS NOT NULL ORDER BY stop_count DESC, country LIMIT 10"""))
def q_stops_per_country(spark, sf_dir):
    return R.stops_per_country(_p(spark, sf_dir).feed.stops)


# --- ingestion helpers over a given table --------------------------------------

URL_PATH_SQL = "regexp_replace(coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), ''), '/+$', '')"
URL_LAST_SQL = f"CASE WHEN regexp_extract({URL_PATH_SQL}, '([^/]*)$', 1) = '' THEN 'dataset.zip' ELSE regexp_extract({URL_PATH_SQL}, '([^/]*)$', 1) END"
URL_FILE_SQL = f"CASE WHEN ends_with(lower({URL_LAST_SQL}), '.zip') THEN {URL_LAST_SQL} ELSE {URL_LAST_SQL} || '.zip' END"


@register("url_dataset_name", f"""SELECT url, filename,
    CASE WHEN regexp_matches(filename, '^.+[.][^.]*$') AND NOT regexp_matches(filename, '^[.][^.]*$')
         THEN regexp_replace(filename, '[.][^.]*$', '') ELSE filename END AS dataset_name
    FROM (SELECT url, {URL_FILE_SQL} AS filename FROM pages) t""")
def q_url_dataset_name(spark, sf_dir):
    """S14 over every page URL of the driver data: the archive file name and
    dataset name a direct download of that URL would get."""
    from ..sources.catalog import url_dataset_name
    pages = read_table(spark, sf_dir, "pages").select("url")
    filename, stem = url_dataset_name(F.col("url"))
    return pages.select("url", filename.alias("filename"), stem.alias("dataset_name"))

"""The per-trip summary: one row per (feed, trip) with route, agency, endpoints,
country, distance, duration, class, traction, CO2 and weekly frequency.

Shuffle plan: stop_times → per-trip facts (one exchange on the trip key);
trips → joined with the small reference tables (routes, agency, calendar,
stops; broadcast when small, AQE decides from measured sizes) and then with
the per-trip facts on the trip key. The departures-per-pattern count is a
``groupBy().count()`` with map-side partial aggregation, so a pattern holding
a third of all trips is reduced before it is shuffled; the count joins back
on the pattern key (AQE splits a skewed side if the count table is large).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (active_days, country_of_name, country_of_point, day_night,
                         emission_factor, named_title, round_half_up, route_title, service_days,
                         strip, title_or_ends, traction, train_class, weekly_frequency)
from ..functions.classify import DAYS
from ..sources.driver_views import Feed
from .stop_times import (TRIP_KEY, feed_shape_flags, join_keys, numeric, one_per_stop, shape_flags,
                         trip_distances, trip_facts)

# Fixed values (the summary's columns, in its order).
SUMMARY_COLUMNS = [
    "trip_id", "agency_name", "route_name", "train_type", "service_type",
    "origin_stop_name", "origin_country", "destination_stop_name", "destination_country",
    "departure_time", "arrival_time", "distance_km", "duration_h", "emission_gco2e_pkm",
    "total_emission_kgco2e", "frequency_per_week", "source_dataset", "traction",
]
# End of fixed values.
PATTERN_KEY = ["dataset_id", "route_id", "service_id", "origin_stop_id", "destination_stop_id"]
DAY_COLUMNS = [d for d, _ in DAYS]


def enrich_trips(feed: Feed) -> DataFrame:
    """Trips ⟕ routes ⟕ agency ⟕ calendar.

    Blank trip ids are dropped first. Null keys never match (a missing agency
    gives the name 'ERROR'); a service id listed twice in the calendar fans the
    trip out, as in the source (the duplicate is removed later, after it has
    been counted for frequencies).
    """
    trips = (feed.trips
             .withColumn("trip_id", strip(F.coalesce(F.col("trip_id"), F.lit(""))))
             .where(F.col("trip_id") != ""))
    routes = feed.routes.select(
        *[c for c in ["dataset_id"] if c in feed.routes.columns], "route_id",
        F.col("agency_id").alias("route_agency_id"),
        "route_short_name", "route_long_name", "route_type")
    t = trips.join(routes, join_keys(trips, routes, "route_id"), "left")
    agency = feed.agency.select(
        *[c for c in ["dataset_id"] if c in feed.agency.columns],
        F.col("agency_id").alias("route_agency_id"), "agency_name")
    t = t.join(agency, join_keys(t, agency, "route_agency_id"), "left")
    t = t.withColumn("agency_name", F.coalesce(F.col("agency_name"), F.lit("ERROR")))
    cal = feed.calendar.select(
        *[c for c in ["dataset_id"] if c in feed.calendar.columns], "service_id",
        *DAY_COLUMNS, F.col("file_row").alias("cal_row"))
    return t.join(cal, join_keys(t, cal, "service_id"), "left")


def stop_labels(stops: DataFrame) -> DataFrame:
    """stop_id → display name ('' when null) and country: the first bounding box
    holding the stop, else a city found in its name (J10 + N4).

    Computed on the stops table (small next to trips), once per stop rather
    than twice per trip. A stop listed again keeps its first row, so it cannot
    multiply trips."""
    cols = [c for c in ["dataset_id"] if c in stops.columns]
    s = one_per_stop(stops).select(
        *cols, "stop_id", F.coalesce(F.col("stop_name"), F.lit("")).alias("name"),
        numeric(stops, "stop_lat").alias("lat"), numeric(stops, "stop_lon").alias("lon"))
    return s.select(*cols, "stop_id", "name",
                    F.coalesce(country_of_point("lat", "lon"), country_of_name("name"))
                    .alias("country"))


def _endpoint(df: DataFrame, labels: DataFrame, side: str) -> DataFrame:
    """Name (default 'ERROR') and country of one end of the trip.

    An unknown stop is named 'ERROR' and has no country (no city occurs in
    that word)."""
    lab = labels.select(
        *[c for c in ["dataset_id"] if c in labels.columns],
        F.col("stop_id").alias(f"{side}_stop_id"),
        F.col("name").alias(f"_{side}_name"), F.col("country").alias(f"{side}_country"))
    out = df.join(lab, join_keys(df, lab, f"{side}_stop_id"), "left")
    return out.withColumn(f"{side}_stop_name",
                          F.coalesce(F.col(f"_{side}_name"), F.lit("ERROR"))).drop(f"_{side}_name")


def trip_rows(feed: Feed, facts: DataFrame | None = None) -> DataFrame:
    """Enriched trips ⋈ per-trip facts (trips without stop_times vanish),
    before frequency and de-duplication; one row per trip × calendar match.

    Facts that the caller keeps (and caches) give the feed-level shape flag too.
    Otherwise it comes from a narrow scan of stop_times, so that the facts have one
    reader, the join on the key they are partitioned by, and need no copy."""
    if facts is None:
        facts, flags = trip_facts(feed.stop_times, feed.stops), feed_shape_flags(feed.stop_times)
    else:
        flags = shape_flags(facts)
    return enrich_trips(feed).join(trip_distances(facts, flags), TRIP_KEY, "inner")


def pattern_departures(rows: DataFrame) -> DataFrame:
    """A5: departures per (feed, route, service, origin stop, destination stop),
    counted over all joined rows (calendar fan-out included)."""
    return (rows.where(F.col("origin_stop_id").isNotNull()
                       & F.col("destination_stop_id").isNotNull())
            .groupBy(*PATTERN_KEY).agg(F.count(F.lit(1)).alias("departures")))


def first_per_trip(rows: DataFrame) -> DataFrame:
    """Keep the first row of each (feed, trip) in file order (trips file
    row, then calendar row). Every rule of the clean-up before it depends only
    on the trip, so de-duplicating first keeps exactly the rows the source keeps."""
    w = Window.partitionBy(*TRIP_KEY).orderBy(
        "file_row", "cal_row", *[F.col(d) for d in DAY_COLUMNS])
    # A row without one before it. (A row number would be cut to the first row before
    # the exchange too, by one more sort of all rows, and a trip has few rows.)
    return rows.withColumn("_one", F.lag(F.lit(1)).over(w)).where("_one IS NULL").drop("_one")


def classify(rows: DataFrame, stops: DataFrame) -> DataFrame:
    """Row-level expressions: names, countries, title, class, traction, CO2,
    frequency, day/night. Everything stays inside whole-stage codegen."""
    labels = stop_labels(stops)
    r = _endpoint(_endpoint(rows, labels, "origin"), labels, "destination")
    dur_h = F.col("duration_min") / 60.0
    ends = F.col("origin_stop_name"), F.col("destination_stop_name")
    title = title_or_ends(F.col("named_title"), *ends) if "named_title" in rows.columns else \
        route_title(F.col("route_short_name"), F.col("route_long_name"), *ends)
    r = r.withColumns({"duration_hours": dur_h, "route_name": title})
    r = r.withColumn("train_type", train_class("route_type", "route_name", "agency_name",
                                               "distance_km", "duration_hours"))
    r = r.withColumn("traction", traction("route_name", "agency_name", "train_type"))
    r = r.withColumn("_factor", emission_factor("train_type", "traction"))
    cal = {d: F.col(d) for d in DAY_COLUMNS}
    days = F.col("active_days") if "active_days" in rows.columns else active_days(cal)
    return r.select(
        "dataset_id", "trip_id", "agency_name", "route_name", "train_type",
        F.when(F.col("departure_time").isNull() | (F.col("departure_time") == ""),
               F.lit("INCONNU")).otherwise(day_night(F.col("departure_time")))
        .alias("service_type"),
        "origin_stop_name", "origin_country", "destination_stop_name", "destination_country",
        "departure_time", "arrival_time",
        round_half_up(F.col("distance_km"), 3).alias("distance_km"),
        round_half_up(F.col("duration_hours"), 2).alias("duration_h"),
        round_half_up(F.col("_factor"), 2).alias("emission_gco2e_pkm"),
        round_half_up(F.col("_factor") * F.col("distance_km") / 1000, 3)
        .alias("total_emission_kgco2e"),
        weekly_frequency(days, F.col("departures")).alias("frequency_per_week"),
        F.col("dataset_id").alias("source_dataset"),
        "traction",
        service_days(cal).alias("service_days"),
        "file_row", "cal_row",
    )


def trips_summary(feed: Feed, rows: DataFrame | None = None) -> DataFrame:
    """The trips summary table (18 columns + ``dataset_id``), cleaned.

    ``rows`` (from ``trip_rows``) feed two consumers, the pattern counts and the
    first row per trip, so they are persisted and the stop_times stage runs
    once; MEMORY_AND_DISK spills instead of failing when they are large, and a
    lost executor's blocks are recomputed from lineage."""
    from .quality import sanitize  # local import: quality builds on this module

    if rows is None:  # otherwise the caller owns (and caches) the rows
        rows = trip_rows(feed).persist(StorageLevel.MEMORY_AND_DISK)
    counts = pattern_departures(rows)
    # One number instead of the seven day flags goes through the join, and one title
    # instead of two names; the checks of the title then do not derive it again.
    firsts = first_per_trip(rows).withColumns({
        "active_days": active_days({d: F.col(d) for d in DAY_COLUMNS}),
        "named_title": named_title(F.col("route_short_name"), F.col("route_long_name"))})
    # Only these may be null in a counted pattern.
    same = [firsts[k].eqNullSafe(counts[k]) if k in ("route_id", "service_id")
            else firsts[k] == counts[k] for k in PATTERN_KEY]
    joined = firsts.join(counts, same, "left").select(firsts["*"], counts["departures"])
    out = sanitize(classify(joined, feed.stops))
    return out.select("dataset_id", *SUMMARY_COLUMNS)

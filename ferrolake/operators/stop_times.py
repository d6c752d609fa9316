"""Per-trip facts from ``stop_times``: endpoints, distance and duration.

Plan shape (one exchange for all of it): stop_times is joined to stop
coordinates (broadcast when the stops table is small, else a shuffle on
``stop_id`` *before* the trip exchange), then hash-partitioned once on
``(dataset_id, trip_id)``. The shape-regression filter (W1), the previous-stop
coordinates (W2) and the per-trip facts (A1–A4, window functions) all reuse that
partitioning and sort order, so Spark adds neither a second exchange nor a
second sort. A trip's rows are bounded by its stop count, so the window never
sees an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import haversine_km, round_half_up, strip, time_to_seconds, to_number

TRIP_KEY = ["dataset_id", "trip_id"]


def join_keys(left: DataFrame, right: DataFrame, key: str) -> list[str]:
    """``[dataset_id, key]`` when both sides are per-feed, else ``[key]``."""
    both = "dataset_id" in left.columns and "dataset_id" in right.columns
    return (["dataset_id"] if both else []) + [key]


def numeric(df: DataFrame, name: str) -> Column:
    """The column as double: text is parsed strictly, numbers are cast."""
    if dict(df.dtypes)[name] == "string":
        return to_number(F.col(name))
    return F.col(name).cast("double")


def one_per_stop(stops: DataFrame) -> DataFrame:
    """The first row of each stop id (in file order; without one, by value)."""
    key = [c for c in ["dataset_id"] if c in stops.columns] + ["stop_id"]
    order = ["file_row"] if "file_row" in stops.columns else \
        [c for c in stops.columns if c not in key]
    w = Window.partitionBy(*key).orderBy(*order)
    return stops.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def prepare_stop_times(stop_times: DataFrame) -> DataFrame:
    """Strip trip ids, drop blank ones, coerce stop_sequence (bad → 0)."""
    st = stop_times
    if "shape_dist_traveled" not in st.columns:
        st = st.withColumn("shape_dist_traveled", F.lit(None).cast("double"))
    if "stop_sequence" not in st.columns:
        st = st.withColumn("stop_sequence", F.lit(None).cast("string"))
    return (st.withColumn("trip_id", strip(F.coalesce(F.col("trip_id").cast("string"), F.lit(""))))
            .where(F.col("trip_id") != "")
            .withColumn("seq", F.coalesce(
                numeric(st, "stop_sequence").try_cast("int"), F.lit(0)))
            .withColumn("shape", numeric(st, "shape_dist_traveled")))


def stop_coordinates(stops: DataFrame) -> DataFrame:
    """stop_id → numeric lat/lon (unreadable → null), one row per stop."""
    cols = [c for c in ["dataset_id"] if c in stops.columns]
    return one_per_stop(stops).select(*cols, "stop_id", numeric(stops, "stop_lat").alias("lat"),
                                      numeric(stops, "stop_lon").alias("lon"))


def trip_order() -> Window:
    return Window.partitionBy(*TRIP_KEY).orderBy("seq", "file_row")


def drop_shape_regressions(st: DataFrame) -> DataFrame:
    """Drop a row whose shape distance is below the row just before it.

    Compared with the previous *original* row of the trip (single pass, not a
    running maximum); a null on either side keeps the row.
    """
    return shape_falls(st).where("NOT falls").drop("falls")


def shape_falls(st: DataFrame) -> DataFrame:
    """``st`` with ``falls``: is the shape distance below the row just before?"""
    prev = F.lag("shape").over(trip_order())
    return (st.withColumn("_prev", prev)
            .withColumn("falls", F.coalesce(F.col("shape") < F.col("_prev"), F.lit(False)))
            .drop("_prev"))


# Fixed value of the source: a larger shape span is read as metres.
METRES_ABOVE = 1000


def trip_facts(stop_times: DataFrame, stops: DataFrame,
               metres_above: float = METRES_ABOVE) -> DataFrame:
    """One row per (dataset_id, trip_id): endpoints, raw times, distance, duration.

    Columns: origin_stop_id, destination_stop_id, departure_time, arrival_time,
    duration_min (rounded 2), shape_km, geo_km (rounded 3), has_shape.

    First/last values are window functions over the trip's rows in (sequence,
    file row) order, each skipping its own nulls; whole-trip totals use the
    same window with an unbounded frame, and one row per trip is kept. All of
    it reuses the trip partitioning and sort of the regression filter, so
    there is no aggregate with struct buffers and no further shuffle.
    """
    st = prepare_stop_times(stop_times)
    st = st.join(stop_coordinates(stops), join_keys(st, stops, "stop_id"), "left")
    st = drop_shape_regressions(st)
    w = trip_order()
    st = st.select(
        *TRIP_KEY, "seq", "file_row", "stop_id", "departure_time", "arrival_time", "shape",
        haversine_km(F.lag("lat").over(w), F.lag("lon").over(w), F.col("lat"), F.col("lon"))
        .alias("seg_km"),
        time_to_seconds(F.col("departure_time")).alias("dep_s"),
        time_to_seconds(F.col("arrival_time")).alias("arr_s"))
    trip = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def first(c: str) -> Column:
        return F.first(c, ignorenulls=True).over(trip)

    def last(c: str) -> Column:
        return F.last(c, ignorenulls=True).over(trip)

    per_trip = st.select(
        *TRIP_KEY, F.row_number().over(w).alias("_rn"),
        first("stop_id").alias("origin_stop_id"), last("stop_id").alias("destination_stop_id"),
        first("departure_time").alias("departure_time"), last("arrival_time").alias("arrival_time"),
        first("dep_s").alias("first_dep_s"), last("arr_s").alias("last_arr_s"),
        F.greatest(F.max("arr_s").over(trip), F.max("dep_s").over(trip)).alias("max_s"),
        F.least(F.min("arr_s").over(trip), F.min("dep_s").over(trip)).alias("min_s"),
        (F.count("arr_s").over(trip) + F.count("dep_s").over(trip)).alias("n_times"),
        (F.max("shape").over(trip) - F.min("shape").over(trip)).alias("shape_span"),
        (F.count("shape").over(trip) > 0).alias("has_shape"),
        F.sum("seg_km").over(trip).alias("geo_km"),
    ).where("_rn = 1")
    # A4: last arrival − first departure; when negative or unknown, the span of
    # all times of the trip (0 with fewer than two), in minutes.
    direct = F.col("last_arr_s") - F.col("first_dep_s")
    span = F.when(F.col("n_times") < 2, F.lit(0)).otherwise(F.col("max_s") - F.col("min_s"))
    dur_s = F.when(direct >= 0, direct).otherwise(span)
    # A2: shape span, read as metres when above ``metres_above``; A3: sum of stop-to-stop arcs.
    shape_km = F.when(F.col("shape_span") <= metres_above, F.col("shape_span")) \
        .otherwise(F.col("shape_span") / 1000.0)
    return per_trip.select(
        *TRIP_KEY, "origin_stop_id", "destination_stop_id", "departure_time", "arrival_time",
        F.round(dur_s / 60.0, 2).alias("duration_min"),
        round_half_up(F.coalesce(shape_km, F.lit(0.0)), 3).alias("shape_km"),
        round_half_up(F.coalesce(F.col("geo_km"), F.lit(0.0)), 3).alias("geo_km"),
        "has_shape",
    )


def shape_flags(facts: DataFrame) -> DataFrame:
    """Per feed: does any trip carry a shape distance? From the per-trip facts
    (every trip of a feed is there, and the regression filter never removes
    a trip's first shape value), so no second scan of stop_times; a partial
    aggregate to one row per feed."""
    return facts.groupBy("dataset_id").agg(F.max("has_shape").alias("feed_has_shape"))


def feed_shape_flags(stop_times: DataFrame) -> DataFrame:
    """``shape_flags`` read from stop_times: a partial aggregate of one narrow scan,
    for callers that keep no per-trip facts to read a second time."""
    return (prepare_stop_times(stop_times).groupBy("dataset_id")
            .agg(F.max(F.col("shape").isNotNull()).alias("feed_has_shape")))


def trip_distances(facts: DataFrame, flags: DataFrame) -> DataFrame:
    """Pick the distance source per feed: shape distances for *every* trip of a
    feed in which any stop_time has one, stop coordinates otherwise. ``flags``
    has one row per feed and is broadcast: a shuffle on the feed would put each
    feed's facts into one task and lose their partitioning by trip."""
    return (facts.join(F.broadcast(flags), "dataset_id")
            .withColumn("distance_km", F.when(F.col("feed_has_shape"), F.col("shape_km"))
                        .otherwise(F.col("geo_km")))
            .drop("feed_has_shape", "shape_km", "geo_km", "has_shape"))

"""Dashboard reports over the warehouse.

Dimensions are small next to the fact; Catalyst/AQE broadcast them by their
measured size, and every aggregate is pre-aggregated map-side before its
shuffle. Sums and averages run on DECIMAL(10,3) columns (exact, independent of
addition order) and are returned as DOUBLE after rounding.
"""

from __future__ import annotations

from decimal import ROUND_CEILING, ROUND_FLOOR, Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import country_of_point, fold, round_half_up
from ..sources.countries import country_seed
from .stop_times import numeric
from .warehouse import Warehouse

DAY_LABEL = "Jour"
NIGHT_LABEL = "Nuit"
OTHER_LABEL = "Autre / Non renseigné"


def _r2(c: Column) -> Column:
    return F.round(c, 2).cast("double")


def _trips() -> Column:
    return F.countDistinct("trip_id").alias("trip_count")


def _bounded(limit: int, most: int) -> int:
    """``limit`` if it lies within the source's bounds for a report."""
    if not 1 <= limit <= most:
        raise ValueError(f"limit must be between 1 and {most}, not {limit}")
    return limit


def overview(wh: Warehouse) -> DataFrame:
    """KPI row."""
    f = wh.fact
    # Each distinct count is taken on its own narrow column: counting three in
    # one aggregate would copy every fact row three times.
    parts = [f.agg(_r2(F.sum("distance_km")).alias("total_distance_km"),
                   _r2(F.sum("total_emission_kgco2e")).alias("total_emissions_kg"),
                   _r2(F.avg("distance_km")).alias("avg_distance_km"),
                   _r2(F.avg("duration_h")).alias("avg_duration_h"),
                   _r2(F.avg("emission_gco2e_pkm")).alias("avg_emission_per_km"))]
    parts += [f.agg(F.countDistinct(c).alias(n)) for c, n in
              [("trip_id", "total_trips"), ("route_sk", "total_routes"),
               ("agency_sk", "total_agencies")]]
    one = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return one.agg(*[F.max(c).alias(c) for c in [
        "total_trips", "total_routes", "total_agencies", "total_distance_km", "total_emissions_kg",
        "avg_distance_km", "avg_duration_h", "avg_emission_per_km"]])


def by_country(wh: Warehouse, limit: int = 20) -> DataFrame:
    """A7 + T1: origin-country breakdown, top ``limit`` by trips."""
    g = wh.fact.groupBy(F.col("origin_country").alias("country_code")).agg(
        _trips(),
        _r2(F.sum("distance_km")).alias("total_distance"),
        _r2(F.sum("total_emission_kgco2e")).alias("total_emissions"),
        _r2(F.avg("emission_gco2e_pkm")).alias("avg_emission_per_km"))
    # Names come after the aggregate: one row per country meets the 25-row seed.
    g = g.join(country_seed(wh.fact.sparkSession), "country_code", "left")
    out = g.select(F.coalesce("country_code", F.lit("UNKNOWN")).alias("country"),
                   F.coalesce("country_name", F.lit("Unknown")).alias("country_name"),
                   "trip_count", "total_distance", "total_emissions", "avg_emission_per_km")
    return out.orderBy(F.desc("trip_count"), "country", "country_name").limit(limit)


def by_train_type(wh: Warehouse) -> DataFrame:
    """A8 + T5 (the class is a natural value of the fact: no join needed)."""
    g = wh.fact.groupBy("train_type").agg(
        _trips(), _r2(F.sum("distance_km")).alias("total_distance"),
        _r2(F.avg("distance_km")).alias("avg_distance"),
        _r2(F.avg("duration_h")).alias("avg_duration"),
        _r2(F.avg("emission_gco2e_pkm")).alias("avg_emission_per_km"))
    return (g.select(F.coalesce("train_type", F.lit("Unknown")).alias("train_type"),
                     *g.columns[1:])
            .orderBy(F.desc("trip_count"), "train_type"))


def by_traction(wh: Warehouse) -> DataFrame:
    """A9 + T5."""
    g = wh.fact.groupBy("traction").agg(
        _trips(), _r2(F.avg("emission_gco2e_pkm")).alias("avg_emission_per_km"),
        _r2(F.sum("total_emission_kgco2e")).alias("total_emissions"))
    return (g.select(F.coalesce("traction", F.lit("Unknown")).alias("traction"), *g.columns[1:])
            .orderBy(F.desc("trip_count"), "traction"))


def by_agency(wh: Warehouse, limit: int = 10) -> DataFrame:
    """A10 + T2: grouped on the agency *name* (inner join: unmatched facts drop)."""
    a = wh.dims["dim_agency"].select("agency_sk", "agency_name")
    g = wh.fact.join(a, "agency_sk").groupBy("agency_name").agg(
        _trips(), _r2(F.sum("distance_km")).alias("total_distance"),
        _r2(F.avg("emission_gco2e_pkm")).alias("avg_emission_per_km"))
    return g.orderBy(F.desc("trip_count"), "agency_name").limit(_bounded(limit, 100))


def emissions_by_route(wh: Warehouse, limit: int = 20) -> DataFrame:
    """A11 + T3: (route name, agency name), top ``limit`` by emissions."""
    r = wh.dims["dim_route"].select("route_sk", "route_name")
    a = wh.dims["dim_agency"].select("agency_sk", "agency_name")
    g = wh.fact.join(r, "route_sk").join(a, "agency_sk").groupBy("route_name", "agency_name").agg(
        _trips(), _r2(F.sum("total_emission_kgco2e")).alias("total_emissions"),
        _r2(F.avg("emission_gco2e_pkm")).alias("avg_emission_per_km"),
        _r2(F.avg("distance_km")).alias("avg_distance"))
    return g.orderBy(F.desc("total_emissions"), "route_name", "agency_name").limit(_bounded(limit, 100))


def service_label(service_type: Column) -> Column:
    """Jour / Nuit / Autre from the day-night code."""
    u = F.upper(F.coalesce(service_type, F.lit("")))
    return (F.when(u == "JOUR", F.lit(DAY_LABEL)).when(u == "NUIT", F.lit(NIGHT_LABEL))
            .otherwise(F.lit(OTHER_LABEL)))


def by_service_type(wh: Warehouse) -> DataFrame:
    """A12 + T5: trips per day/night label."""
    return (wh.fact.groupBy(service_label(F.col("service_type")).alias("service_type"))
            .agg(_trips()).orderBy(F.desc("trip_count"), "service_type"))


def fact_count(wh: Warehouse) -> DataFrame:
    """Warehouse row count (the health probe's query)."""
    return wh.fact.agg(F.count(F.lit(1)).alias("count"))


def load_counts(wh: Warehouse) -> DataFrame:
    """Rows staged and facts last touched, per load."""
    staged = wh.staging.groupBy("load_id").agg(F.count(F.lit(1)).alias("rows_in_batch"))
    facts = (wh.fact.groupBy(F.col("last_load_id").alias("load_id"))
             .agg(F.count(F.lit(1)).alias("fact_rows")))
    return staged.join(facts, "load_id", "full").select(
        "load_id", F.coalesce("rows_in_batch", F.lit(0)).alias("rows_in_batch"),
        F.coalesce("fact_rows", F.lit(0)).alias("fact_rows"))


def fact_details(wh: Warehouse, inner_locations: bool = False) -> DataFrame:
    """The fact with its dimension attributes (J12): route and agency names
    from their dimensions (inner joins, last-wins names); every other shown
    value is the natural key the fact carries. ``inner_locations`` keeps only
    facts whose locations and clock times exist (the inner joins of J16)."""
    d, f = wh.dims, wh.fact
    j = (f.join(d["dim_route"].select("route_sk", "route_name"), "route_sk")
         .join(d["dim_agency"].select("agency_sk", "agency_name"), "agency_sk"))
    j = j.select("*", F.col("origin_stop_name").alias("origin"),
                 F.col("destination_stop_name").alias("destination"))
    if inner_locations:
        j = j.where(F.col("origin").isNotNull() & F.col("destination").isNotNull()
                    & F.col("departure_time").isNotNull() & F.col("arrival_time").isNotNull()
                    & F.col("service_type").isNotNull())
    return j


SEARCH_COLUMNS = [
    "trip_id", "dataset_id", "distance_km", "duration_h", "total_emission_kgco2e",
    "frequency_per_week", "last_loaded_at", "route_name", "agency_name", "origin", "destination",
    "origin_country", "destination_country", "departure_time", "arrival_time", "train_type",
    "traction", "service_type", "service_label",
]


def _distance(value: float, rounding: str) -> Column:
    """A bound of the column's own type, so that the comparison reaches the scan.

    Rounded to the side that keeps the same rows (distances have 3 decimals)."""
    return F.lit(Decimal(str(value)).quantize(Decimal("0.001"), rounding)).cast("decimal(10,3)")


def search_predicate(origin: str | None = None, destination: str | None = None,
                     train_type: str | None = None, min_distance: float | None = None,
                     max_distance: float | None = None) -> Column:
    """AND of the given filters (none → true).

    Place names match as case- and accent-insensitive substrings, the train
    type as a whole (the collation of the source database); a typed ``%`` or
    ``_`` is literal."""
    conds = []
    if origin:
        conds.append(F.contains(fold(F.col("origin")), fold(F.lit(origin))))
    if destination:
        conds.append(F.contains(fold(F.col("destination")), fold(F.lit(destination))))
    if train_type:
        conds.append(fold(F.col("train_type")) == fold(F.lit(train_type)))
    if min_distance is not None:
        conds.append(F.col("distance_km") >= _distance(min_distance, ROUND_CEILING))
    if max_distance is not None:
        conds.append(F.col("distance_km") <= _distance(max_distance, ROUND_FLOOR))
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def latest_per_trip(df: DataFrame) -> DataFrame:
    """Newest fact per trip_id (a trip id may occur in several feeds); facts
    of one load are ordered by their feed, the greatest dataset_id first."""
    w = Window.partitionBy("trip_id").orderBy(F.desc("last_loaded_at"), F.desc("dataset_id"))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def search_trips(wh: Warehouse, limit: int = 50, **filters) -> DataFrame:
    """P13 + J12 + W3 + T4: filtered trips, newest per trip id, longest first.

    The filters run *before* the window, as in the source query: moving them
    after it would change which fact is the newest."""
    rows = fact_details(wh).where(search_predicate(**filters))
    rows = latest_per_trip(rows).withColumn("service_label", service_label(F.col("service_type")))
    return (rows.select(*SEARCH_COLUMNS)
            .orderBy(F.desc("distance_km"), "trip_id", "dataset_id").limit(_bounded(limit, 1000)))


def trip_labels(trips: DataFrame) -> DataFrame:
    """Display labels of search results (day/night, weekly frequency)."""
    raw = F.coalesce(F.when(F.col("service_type") != "", F.col("service_type")), F.lit(""))
    low = F.lower(raw)
    day_night = (F.when(raw == "", F.lit("Non renseigné"))
                 .when(low.contains("night") | low.contains("nuit") | (low == "n"),
                       F.lit("Train de nuit"))
                 .when(low.contains("day") | low.contains("jour") | (low == "d"),
                       F.lit("Train de jour"))
                 .otherwise(raw))
    freq = F.col("frequency_per_week")
    freq_label = F.when(freq.isNull(), F.lit("Non renseignée")) \
        .otherwise(F.concat(freq.cast("string"), F.lit(" / semaine")))
    return trips.select("trip_id", "dataset_id", day_night.alias("day_night_label"),
                        freq_label.alias("frequency_label"))


def spotlight(wh: Warehouse) -> DataFrame:
    """Busiest origin country, busiest train type, most emitting traction."""
    c = by_country(wh).orderBy(F.desc("trip_count"), "country").limit(1).select(
        F.lit("Pays dominant").alias("label"), F.col("country").alias("value"),
        F.col("trip_count").cast("double").alias("metric"))
    t = by_train_type(wh).orderBy(F.desc("trip_count"), "train_type").limit(1).select(
        F.lit("Train dominant").alias("label"), F.col("train_type").alias("value"),
        F.col("trip_count").cast("double").alias("metric"))
    x = by_traction(wh).orderBy(F.desc("avg_emission_per_km"), "traction").limit(1).select(
        F.lit("Traction la plus émissive").alias("label"), F.col("traction").alias("value"),
        F.col("avg_emission_per_km").alias("metric"))
    return c.unionByName(t).unionByName(x)


def top_countries(wh: Warehouse, countries: int = 10, types: int = 8) -> DataFrame:
    """Chart cuts — top 10 countries and top 8 train types by trips."""
    c = by_country(wh).orderBy(F.desc("trip_count"), "country").limit(countries).select(
        F.lit("country").alias("cut"), F.col("country").alias("name"), "trip_count")
    t = by_train_type(wh).orderBy(F.desc("trip_count"), "train_type").limit(types).select(
        F.lit("train_type").alias("cut"), F.col("train_type").alias("name"), "trip_count")
    return c.unionByName(t)


def trip_view(wh: Warehouse, view: str | None = None) -> DataFrame:
    """The flat trip view (inner joins on every dimension it shows), 11
    columns; ``fact_id`` names the fact by its natural key. Registered as the
    temporary view ``view`` if a name is given."""
    j = fact_details(wh, inner_locations=True)
    out = j.select(F.concat_ws(":", "dataset_id", "trip_id").alias("fact_id"), "trip_id",
                   "route_name", "agency_name", "service_type", "origin", "destination",
                   "departure_time", "arrival_time", "distance_km", "duration_h")
    if view:
        out.createOrReplaceTempView(view)
    return out


def stops_per_country(stops: DataFrame, top: int = 10) -> DataFrame:
    """Stops per bounding-box country (top ``top``), their share of the stops
    with usable coordinates, and the share of these that any box holds."""
    s = (stops.select("stop_id", numeric(stops, "stop_lat").alias("lat"),
                      numeric(stops, "stop_lon").alias("lon"))
         .where(F.col("lat").isNotNull() & F.col("lon").isNotNull()
                & F.col("stop_id").isNotNull())
         .withColumn("country", country_of_point("lat", "lon")))
    # <= 26 rows after the aggregate (25 boxes + unmapped): the shares need
    # totals, taken with a window over that tiny result.
    every = Window.partitionBy()
    per = s.groupBy("country").agg(F.count(F.lit(1)).alias("stop_count")) \
        .withColumn("valid_stops", F.sum("stop_count").over(every)) \
        .withColumn("mapped", F.sum(F.when(F.col("country").isNotNull(), F.col("stop_count"))
                                    .otherwise(0)).over(every))
    return (per.where(F.col("country").isNotNull())
            .orderBy(F.desc("stop_count"), "country").limit(top)
            .select("country", "stop_count",
                    round_half_up(F.col("stop_count") * 100.0 / F.col("valid_stops"), 2)
                    .alias("pct_of_valid_stops"),
                    round_half_up(F.col("mapped") * 100.0 / F.col("valid_stops"), 2)
                    .alias("mapped_pct")))

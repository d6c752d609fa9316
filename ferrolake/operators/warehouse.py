"""Star-schema load: staging rows, ten dimensions, one fact, idempotent upserts.

Surrogate keys are ``xxhash64`` of the natural key, computed row by row, so the
fact is built from staging with *no* dimension lookup joins: every executor
derives the same key locally, and a 100 TB load is a map-only projection plus
one upsert. Dimensions are ``SELECT DISTINCT`` sets (partial aggregation
before the shuffle). The natural values behind the keys stay on the fact
(``NATURAL_VALUES``, degenerate attributes), so reports never join the trip
dimension (as large as the fact) and join only the dimensions that carry
attributes of their own (route, agency and country names).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import agency_id_of, clean_country, fold, route_id_of, time_parts
from ..sources.countries import country_seed
from .quality import reject_reason, validate_rows

MEASURES = ["distance_km", "duration_h", "emission_gco2e_pkm", "total_emission_kgco2e"]
DECIMAL = "decimal(10,3)"
DEFAULT_LOAD_ID = 1
DEFAULT_LOADED_AT = "2025-01-01 00:00:00"


def sk(*cols: Column) -> Column:
    """Surrogate key: xxhash64 of the natural key; null when the key is null."""
    return F.when(cols[0].isNotNull(), F.xxhash64(*cols))


def stage_rows(summary: DataFrame, load_id: int = DEFAULT_LOAD_ID,
               loaded_at: str = DEFAULT_LOADED_AT) -> DataFrame:
    """P10 + P11: valid summary rows projected to the 23 staging columns."""
    valid, _ = validate_rows(summary)
    return valid.select(*_staging_columns(load_id, loaded_at))


def staged_or_rejected(summary: DataFrame, load_id: int = DEFAULT_LOAD_ID,
                       loaded_at: str = DEFAULT_LOADED_AT) -> DataFrame:
    """Every summary row in staging form, in one pass: ``accepted``, and for the others
    the ``reject_reason`` and the distance as it was written (P10's side output)."""
    reason = reject_reason(summary)
    return summary.select(
        *_staging_columns(load_id, loaded_at), reason.isNull().alias("accepted"),
        reason.alias("reject_reason"),
        F.when(reason.isNotNull(), F.col("distance_km").cast("string")).alias("distance_text"))


def _staging_columns(load_id: int, loaded_at: str) -> list:
    return [
        F.lit(load_id).cast("bigint").alias("load_id"),
        F.lit(loaded_at).cast("timestamp_ntz").alias("loaded_at"),  # DATETIME: no time zone
        F.col("source_dataset").cast("string").alias("dataset_id"),
        F.col("trip_id").cast("string").alias("trip_id"),
        route_id_of(F.col("route_name")).alias("route_id"),
        "route_name",
        agency_id_of(F.col("agency_name")).alias("agency_id"),
        "agency_name", "service_type", "origin_stop_name",
        clean_country(F.col("origin_country")).alias("origin_country"),
        "destination_stop_name",
        clean_country(F.col("destination_country")).alias("destination_country"),
        "departure_time", "arrival_time",
        F.col("distance_km").try_cast(DECIMAL).alias("distance_km"),
        F.col("duration_h").try_cast(DECIMAL).alias("duration_h"),
        "train_type", "traction",
        F.lit("").alias("transport_type"),
        F.col("emission_gco2e_pkm").try_cast(DECIMAL).alias("emission_gco2e_pkm"),
        F.col("total_emission_kgco2e").try_cast(DECIMAL).alias("total_emission_kgco2e"),
        F.col("frequency_per_week").cast("int").alias("frequency_per_week"),
    ]


# Dimensions -----------------------------------------------------------------

# Columns whose values are compared as names: without case and accents, like the
# source's collation. Identifiers and codes (trip, dataset, time, country) are
# compared exactly.
FOLDED = {"route_id", "agency_id", "service_type", "train_type", "traction", "stop_name"}


def key_of(name: str, column: str | None = None) -> Column:
    """The comparison key of a dimension column (read from ``column``)."""
    c = F.col(column or name)
    return fold(c) if name in FOLDED else c


def _one_per_key(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The first row per key and the newest load that brought any of them. The
    rows are distinct already (hash aggregates), so few enter the window."""
    w = Window.partitionBy(*keys)
    return (df.withColumn("_rn", F.row_number().over(w.orderBy(*order)))
            .withColumn("load_id", F.max("load_id").over(w)).where("_rn = 1").drop("_rn"))


def _union_distinct(staging: DataFrame, pairs: list[list[str]], names: list[str],
                    non_null: str | None = None) -> DataFrame:
    """Origin ∪ destination (or departure ∪ arrival), distinct.

    ``distinct`` is null-safe in Spark, so a (name, null country) location is
    one row however many loads bring it (D7)."""
    parts = [staging.select("load_id", *[F.col(c).alias(n) for c, n in zip(cols, names)])
             for cols in pairs]
    u = parts[0].unionByName(parts[1])
    if non_null:
        u = u.where(F.col(non_null).isNotNull())
    return u.groupBy(*names).agg(F.max("load_id").alias("load_id"))


class LazyTables(Mapping):
    """Name → DataFrame, each built on first use (a report touching two
    dimensions does not plan the other eight)."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, key: str) -> DataFrame:
        if key not in self._built:
            self._built[key] = self._builders[key]()
        return self._built[key]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def build_dimensions(staging: DataFrame, spark: SparkSession) -> LazyTables:
    """The ten dimensions of one load (natural key, attributes, ``load_id``)."""
    s = staging

    def simple(col: str) -> DataFrame:
        d = (s.where(F.col(col).isNotNull()).groupBy(col)
             .agg(F.max("load_id").alias("load_id")))
        return _one_per_key(d, [key_of(col)], [F.col(col)]) if col in FOLDED else d

    def named(key: str, name: str) -> DataFrame:
        # One row per id; several names → newest load, then greatest name.
        d = s.groupBy(key, name).agg(F.max("load_id").alias("load_id"))
        return _one_per_key(d, [key_of(key)],
                            [F.desc("load_id"), F.desc(name), F.desc(key)]).select(key, name, "load_id")

    def country() -> DataFrame:
        # Seed codes (load 0 unless a load used them) and the codes the seed
        # lacks (no name); the 25-row seed is the broadcast side.
        codes = _union_distinct(s, [["origin_country"], ["destination_country"]],
                                ["country_code"], non_null="country_code")
        seed = country_seed(spark)
        every = codes.unionByName(seed.select("country_code", F.lit(0).cast("bigint").alias("load_id")))
        newest = every.groupBy("country_code").agg(F.max("load_id").alias("load_id"))
        return newest.join(seed, "country_code", "left").select("country_code", "country_name", "load_id")

    def times() -> DataFrame:
        t = _union_distinct(s, [["departure_time"], ["arrival_time"]], ["time_value"],
                            non_null="time_value")
        return (t.select("time_value", time_parts(F.col("time_value")).alias("p"), "load_id")
                .select("time_value", "p.hour", "p.minute", "p.second", "load_id"))

    def location() -> DataFrame:
        d = _union_distinct(
            s, [["origin_stop_name", "origin_country"],
                ["destination_stop_name", "destination_country"]],
            ["stop_name", "country_code"])
        return _one_per_key(d, [key_of("stop_name"), F.col("country_code")], [F.col("stop_name")])

    builders = {
        "dim_dataset": lambda: simple("dataset_id"),
        "dim_trip": lambda: simple("trip_id"),
        "dim_route": lambda: named("route_id", "route_name"),
        "dim_agency": lambda: named("agency_id", "agency_name"),
        "dim_service_type": lambda: simple("service_type"),
        "dim_train_type": lambda: simple("train_type"),
        "dim_traction": lambda: simple("traction"),
        "dim_country": country,
        "dim_location": location,
        "dim_time": times,
    }
    return LazyTables({k: (lambda k=k, b=b: with_key(k, b())) for k, b in builders.items()})


DIM_KEYS = {
    "dim_dataset": ("dataset_sk", ["dataset_id"]),
    "dim_trip": ("trip_sk", ["trip_id"]),
    "dim_route": ("route_sk", ["route_id"]),
    "dim_agency": ("agency_sk", ["agency_id"]),
    "dim_service_type": ("service_sk", ["service_type"]),
    "dim_train_type": ("train_type_sk", ["train_type"]),
    "dim_traction": ("traction_sk", ["traction"]),
    "dim_country": ("country_sk", ["country_code"]),
    "dim_location": ("location_sk", ["stop_name", "country_code"]),
    "dim_time": ("time_sk", ["time_value"]),
}


def with_key(dim: str, df: DataFrame) -> DataFrame:
    name, keys = DIM_KEYS[dim]
    return df.select(sk(*[key_of(k) for k in keys]).alias(name), *df.columns)


# Fact -----------------------------------------------------------------------

def build_fact(staging: DataFrame) -> DataFrame:
    """One fact per staging row; keys hashed from the natural values.

    Equivalent to staging ⋈ dataset, trip ⟕ the other nine dimensions, since
    every dimension is built from the same staging rows; the location key is
    null-safe on the country (``<=>``)."""
    return with_fact_keys(fact_rows(staging))


def fact_rows(staging: DataFrame) -> DataFrame:
    """The facts without their surrogate keys: what a load moves and keeps."""
    return staging.select(*MEASURES, "frequency_per_week", F.col("load_id").alias("last_load_id"),
                          F.col("loaded_at").alias("last_loaded_at"), *NATURAL_VALUES)


def with_fact_keys(rows: DataFrame) -> DataFrame:
    """Facts with their surrogate keys, a projection of the natural values: a reader
    pays for the keys it uses only."""
    c = F.col
    return rows.select(
        sk(c("trip_id"), c("dataset_id")).alias("fact_sk"),
        sk(c("trip_id")).alias("trip_sk"),
        sk(c("dataset_id")).alias("dataset_sk"),
        sk(key_of("route_id")).alias("route_sk"),
        sk(key_of("agency_id")).alias("agency_sk"),
        sk(key_of("service_type")).alias("service_sk"),
        sk(key_of("train_type")).alias("train_type_sk"),
        sk(key_of("traction")).alias("traction_sk"),
        sk(key_of("stop_name", "origin_stop_name"), c("origin_country")).alias("origin_location_sk"),
        sk(c("origin_country")).alias("origin_country_sk"),
        sk(key_of("stop_name", "destination_stop_name"), c("destination_country")).alias("destination_location_sk"),
        sk(c("destination_country")).alias("destination_country_sk"),
        sk(c("departure_time")).alias("departure_time_sk"),
        sk(c("arrival_time")).alias("arrival_time_sk"),
        *MEASURES, "frequency_per_week", "last_load_id", "last_loaded_at", *NATURAL_VALUES,
    )


# Natural values kept on the fact next to their keys. Each of these keys is a
# hash of exactly that value, so a dimension join would only hand the value
# back; keeping it spares reports those joins (columnar storage reads only the
# columns a report touches). Dimensions with attributes of their own (route
# name, agency name, country name) are still joined.
NATURAL_VALUES = ["trip_id", "dataset_id", "route_id", "agency_id", "service_type", "train_type",
                  "traction", "origin_stop_name", "origin_country", "destination_stop_name",
                  "destination_country", "departure_time", "arrival_time"]


def build_fact_strict(staging: DataFrame) -> DataFrame:
    """J15 (earlier all-inner star load): a staged row becomes a fact only if
    every dimension matches, i.e. no key is null and both clock times read as
    times; location is matched on the stop name alone."""
    from ..functions import time_to_seconds
    ok = (time_to_seconds(F.col("departure_time")).isNotNull()
          & time_to_seconds(F.col("arrival_time")).isNotNull())
    for c in ["dataset_id", "trip_id", "route_id", "agency_id", "service_type",
              "origin_stop_name", "destination_stop_name"]:
        ok = ok & F.col(c).isNotNull()
    return staging.where(ok).select(
        "trip_id", "dataset_id", "route_id", "agency_id", "service_type", "origin_stop_name",
        "destination_stop_name", "departure_time", "arrival_time", "distance_km", "duration_h")


def orphan_countries(locations: DataFrame, countries: DataFrame) -> DataFrame:
    """Country codes used by locations but absent from the country table
    (the row loader stores such locations with a null country)."""
    used = locations.where(F.col("country_code").isNotNull()).select("country_code").distinct()
    return used.join(countries.select("country_code"), "country_code", "left_anti")


def known_countries(staging: DataFrame, countries: DataFrame) -> DataFrame:
    """J14 in the load: staging with the country codes that ``countries`` lacks set to
    null, as the row loader stores such locations. The country table is complete
    before locations are built; it has one row per code and is the broadcast side
    only if the planner finds it small."""
    codes = countries.select("country_code").distinct()
    out = staging
    for c in ("origin_country", "destination_country"):
        known = codes.select(F.col("country_code").alias(f"__{c}"))
        out = (out.join(known, F.col(c) == F.col(f"__{c}"), "left")
               .withColumn(c, F.col(f"__{c}")).drop(f"__{c}"))
    return out.select(*staging.columns)


# Upserts --------------------------------------------------------------------

def newest_per_key(rows: DataFrame, keys: list, newest: list[str]) -> DataFrame:
    """One row per key: the newest; rows of one age are ordered by all their
    values, so the choice never depends on the partitioning."""
    # Surrogate keys follow from the natural values, so they decide nothing.
    rest = [c for c in rows.columns if c not in newest and not c.endswith("_sk")]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in [*newest, *rest]])
    # As in ``first_per_trip``: the row without one before it, sorted after the exchange only.
    return rows.withColumn("_one", F.lag(F.lit(1)).over(w)).where("_one IS NULL").drop("_one")


def upsert(existing: DataFrame | None, incoming: DataFrame, keys: list,
           newest: list[str]) -> DataFrame:
    """M1/M2: insert new keys, overwrite existing ones with the newest row.

    The incoming rows are reduced to one per key also on a first load.
    Re-running the same load changes nothing."""
    both = incoming if existing is None else existing.unionByName(incoming)
    return newest_per_key(both, keys, newest)


FACT_KEY = ["trip_id", "dataset_id"]


def upsert_facts(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """M2: the rows of a load (one per key), and the stored rows that it does not
    bring again. Only the narrow key is compared; no stored row is sorted."""
    if existing is None:
        return new
    kept = existing.join(new.select(*FACT_KEY), FACT_KEY, "left_anti")
    return new.unionByName(kept.select(*new.columns))


def insert_ignore(existing: DataFrame | None, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """M4: keep existing rows; append only keys not present yet (left_anti), one
    row per key (the first by value)."""
    w = Window.partitionBy(*keys).orderBy(*incoming.columns)
    once = incoming.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    if existing is None:
        return once
    return existing.unionByName(once.join(existing.select(*keys), keys, "left_anti"))


@dataclass(frozen=True)
class Warehouse:
    """``changed``: the facts of the feeds that the last load touched (all of
    them after a first load); storage rewrites only these. ``kept``: the tables that
    are persisted (staging rows, newest fact rows of the load)."""

    dims: Mapping[str, DataFrame]
    fact: DataFrame
    staging: DataFrame
    changed: DataFrame | None = None
    kept: tuple[DataFrame, ...] = ()

    def release(self) -> None:
        """Drop the persisted staging rows and facts."""
        for table in self.kept:
            table.unpersist()


def load_warehouse(summary: DataFrame, load_id: int = DEFAULT_LOAD_ID,
                   loaded_at: str | _dt.datetime = DEFAULT_LOADED_AT,
                   existing: Warehouse | None = None,
                   keep: tuple[str, ...] = ("staging", "facts")) -> Warehouse:
    """Entry 2 of the pipeline: summary → staging → dimensions → fact, upserted
    into ``existing`` (dimensions on their natural key, facts on (trip, dataset)).

    ``keep`` names the tables to persist: those that the caller reads more than once.
    One that is read once is cheaper without a copy, as only the columns in use are
    then computed."""
    spark = summary.sparkSession
    # Staging is the one input of all ten dimensions and of the fact: persisted
    # (the role of the staging table in the source database), so each of them
    # is a cheap aggregate over it instead of a re-run of the transform. The
    # facts are persisted after their reduction to one row per key, which every
    # report would repeat otherwise, and before their surrogate keys, which follow
    # from the values. The caller releases both.
    staging = stage_rows(summary, load_id, str(loaded_at))
    rows = newest_per_key(fact_rows(staging), FACT_KEY, ["last_load_id", "last_loaded_at"])
    tables = {"staging": staging, "facts": rows}
    kept = tuple(tables[k].persist(StorageLevel.MEMORY_AND_DISK) for k in keep)
    new = build_dimensions(staging, spark)
    if existing is None:
        fact = with_fact_keys(rows)
        return Warehouse(new, fact, staging, fact, kept)

    def merged(k: str) -> DataFrame:
        return upsert(existing.dims[k], new[k], [key_of(c) for c in DIM_KEYS[k][1]], ["load_id"])

    dims = LazyTables({k: (lambda k=k: merged(k)) for k in DIM_KEYS})
    # A key names its feed, so the stored rows of untouched feeds stay by the same rule.
    stored = existing.fact.select(*rows.columns)
    feeds = staging.select("dataset_id").distinct()
    changed = upsert_facts(stored.join(feeds, "dataset_id", "left_semi"), rows)
    return Warehouse(dims, with_fact_keys(upsert_facts(stored, rows)), staging,
                     with_fact_keys(changed), kept)


def materialize(wh: Warehouse, eager: bool = True) -> Warehouse:
    """Cut the lineage of a loaded warehouse with reliable checkpoints (files in
    ``spark.checkpoint.dir``), so later reports re-read stored tables instead of
    recomputing the whole pipeline, and lost executors cost no recomputation."""
    return replace(wh, fact=wh.fact.checkpoint(eager),
                   dims={k: wh.dims[k].checkpoint(eager) for k in wh.dims},
                   staging=wh.staging.checkpoint(eager), changed=None, kept=())

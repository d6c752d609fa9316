"""Row clean-up and validation: the summary sanitiser (P3–P8), the load-time
row check (P10), over-long country report (P12) and numeric-text check (P9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import strip, to_number
from ..functions.text import COUNTRY_COLUMN_WIDTH

# Clean-up rules in the order they are applied; a row is charged to the first
# rule it fails.
SANITIZE_RULES = ["missing_trip_id", "invalid_duration", "invalid_distance",
                  "same_origin_destination", "duplicate_trip_id"]


def _blank(c: Column) -> Column:
    return c.isNull() | (strip(c.cast("string")) == "")


def sanitize_rule(df: DataFrame) -> Column:
    """Name of the first row-level rule a summary row fails, else null."""
    same = F.coalesce(F.col("origin_stop_name") == F.col("destination_stop_name"), F.lit(False))
    return (F.when(_blank(F.col("trip_id")), F.lit(SANITIZE_RULES[0]))
            .when(F.coalesce(F.col("duration_h") <= 0, F.lit(True)), F.lit(SANITIZE_RULES[1]))
            .when(F.coalesce(F.col("distance_km") < 0, F.lit(True)), F.lit(SANITIZE_RULES[2]))
            .when(same, F.lit(SANITIZE_RULES[3])))


def sanitize(df: DataFrame) -> DataFrame:
    """Drop blank trip ids, duration null/≤0, distance null/<0 (0 kept),
    origin name = destination name (two nulls are not equal); negative
    emissions become null. W4 (duplicates) is applied by the caller."""
    out = df.where(sanitize_rule(df).isNull())
    for c in ["emission_gco2e_pkm", "total_emission_kgco2e"]:
        out = out.withColumn(c, F.when(F.col(c) >= 0, F.col(c)))
    return out


def sanitize_report(rows: DataFrame) -> DataFrame:
    """Rows removed per rule, rules applied in order, their total per feed,
    and the count of negative emission values set to null.

    ``rows`` are the classified rows *before* de-duplication. Duplicates are
    counted among the rows that pass the earlier rules, in file order.
    """
    ruled = rows.withColumn("rule", sanitize_rule(rows))
    w = Window.partitionBy("dataset_id", "trip_id", "rule").orderBy("file_row", "cal_row")
    ruled = ruled.withColumn(
        "rule", F.when(F.col("rule").isNull() & (F.row_number().over(w) > 1),
                       F.lit(SANITIZE_RULES[4])).otherwise(F.col("rule")))
    removed = (ruled.where(F.col("rule").isNotNull())
               .groupBy("dataset_id", "rule").agg(F.count(F.lit(1)).alias("rows")))
    negative = (ruled.where(F.col("rule").isNull())
                .groupBy("dataset_id")
                .agg(F.count(F.when((F.col("emission_gco2e_pkm") < 0)
                                    | (F.col("total_emission_kgco2e") < 0), 1)).alias("rows"))
                .where("rows > 0")
                .select("dataset_id", F.lit("negative_emission_nulled").alias("rule"), "rows"))
    total = (removed.groupBy("dataset_id").agg(F.sum("rows").alias("rows"))
             .select("dataset_id", F.lit("total_removed").alias("rule"), "rows"))
    return removed.unionByName(total).unionByName(negative)


# P10 -----------------------------------------------------------------------
REQUIRED_FIELDS = ["trip_id", "agency_name", "route_name", "origin_stop_name",
                   "destination_stop_name"]


def reject_reason(df: DataFrame) -> Column:
    """First reason a summary row may not be loaded, else null.

    The five required fields must be non-blank and not 'ERROR'; the distance
    may be null but must otherwise be a number ≥ 0.
    """
    expr = None
    for f in REQUIRED_FIELDS:
        c = F.col(f).cast("string")
        cond = _blank(c) | (c == "ERROR")
        msg = F.lit(f"Missing or invalid {f}")
        expr = F.when(cond, msg) if expr is None else expr.when(cond, msg)
    d = F.col("distance_km")
    # A double needs no way through text: all but NaN and the infinities read back as they are.
    num = (F.when(F.abs(d) < float("inf"), d) if dict(df.dtypes)["distance_km"] == "double"
           else to_number(d))
    return (expr.when(d.isNotNull() & num.isNull(), F.lit("distance_km not numeric"))
            .when(num < 0, F.concat(F.lit("distance_km out of range: "), num.cast("string"))))


def validate_rows(summary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split summary rows into (valid, rejected-with-reason)."""
    tagged = summary.withColumn("reject_reason", reject_reason(summary))
    return (tagged.where(F.col("reject_reason").isNull()).drop("reject_reason"),
            tagged.where(F.col("reject_reason").isNotNull()))


def country_offenders(summary: DataFrame, width: int = COUNTRY_COLUMN_WIDTH) -> DataFrame:
    """Rows whose raw country text is longer than the staging column."""
    o, d = F.col("origin_country"), F.col("destination_country")
    return (summary.where((F.length(o) > width) | (F.length(d) > width))
            .select("dataset_id", "trip_id", "origin_country", F.length(o).alias("origin_len"),
                    "destination_country", F.length(d).alias("dest_len")))

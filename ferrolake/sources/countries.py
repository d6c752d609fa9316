"""The country reference rows loaded once into the country dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the source pipeline for identical results).
COUNTRIES = [
    ("FR", "France"), ("DE", "Germany"), ("IT", "Italy"), ("ES", "Spain"),
    ("CH", "Switzerland"), ("BE", "Belgium"), ("NL", "Netherlands"), ("LU", "Luxembourg"),
    ("GB", "United Kingdom"), ("IE", "Ireland"), ("PT", "Portugal"), ("PL", "Poland"),
    ("CZ", "Czechia"), ("SK", "Slovakia"), ("AT", "Austria"), ("HU", "Hungary"),
    ("RO", "Romania"), ("BG", "Bulgaria"), ("GR", "Greece"), ("HR", "Croatia"),
    ("SI", "Slovenia"), ("SE", "Sweden"), ("NO", "Norway"), ("DK", "Denmark"),
    ("FI", "Finland"),
]
# End of fixed values.
# ---------------------------------------------------------------------------


def country_seed(spark: SparkSession) -> DataFrame:
    """25 (country_code, country_name) rows; a fixed-size constant table, so it
    is always safe to broadcast."""
    return F.broadcast(spark.createDataFrame(COUNTRIES, "country_code string, country_name string"))


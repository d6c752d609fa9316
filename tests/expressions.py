"""Helper of the expression tests."""


def one(spark, col, **cols):
    """Evaluate a Column over a one-row frame built from ``cols`` (all strings unless given)."""
    if not cols:
        return spark.range(1).select(col.alias("v")).first()["v"]
    names = list(cols)
    df = spark.createDataFrame([tuple(cols[n] for n in names)], names)
    return df.select(col.alias("v")).first()["v"]

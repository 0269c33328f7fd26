"""Joins when one key may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_join(rows: DataFrame, table: DataFrame, key: str, how: str = "inner", hot_rows: int = 1_000_000,
                counts: DataFrame | None = None) -> DataFrame:
    """Join ``rows`` with ``table`` on ``key``; rows of a hot key are spread, its table rows repeated.

    A key is hot above ``hot_rows`` rows, so there are at most total rows / ``hot_rows`` of them: few enough to
    broadcast. A hot key gets one part per ``hot_rows`` rows. ``counts`` (key, n) saves counting the rows again.
    """
    if counts is None:
        counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    hot = F.broadcast(
        counts.where(F.col("n") > hot_rows).select(key, F.ceil(F.col("n") / hot_rows).cast("int").alias("_parts"))
    )
    any_column = F.xxhash64(*rows.columns)
    left = rows.join(hot, key, "left").withColumn(
        "_salt", F.when(F.col("_parts").isNotNull(), F.pmod(any_column, F.col("_parts").cast("long")).cast("int")).otherwise(0)
    ).drop("_parts")
    each = F.when(F.col("_parts").isNotNull(), F.sequence(F.lit(0), F.col("_parts") - 1)).otherwise(F.array(F.lit(0)))
    right = table.join(hot, key, "left").withColumn("_salt", F.explode(each)).drop("_parts")
    return left.join(right, [key, "_salt"], how).drop("_salt")

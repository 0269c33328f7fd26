"""The inbox folder: file names encode the state of a result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subtlake.functions.names import legacy_num
from subtlake.sources.listing import list_files


def classify_inbox(listing: DataFrame, path: str = "path", size: str = "size") -> DataFrame:
    """(path, name, num, state, size) of listed files.

    States: archive, not_found (also a zero-size archive), takedown, html, broken, unknown, other.
    """
    name = F.regexp_extract(F.col(path), r"([^/]*)$", 1)
    lead = F.regexp_extract("name", r"^([0-9]+)\.", 1).try_cast("long")
    state = (
        F.when(F.col("name").rlike(r"^[0-9]+\.(?:not-found-)?(?:dmca|dcma)$"), "takedown")
        .when(F.col("name").rlike(r"^[0-9]+\.not-found$"), "not_found")
        .when(F.endswith("name", F.lit(".broken")), "broken")
        .when(F.col("name").rlike(r"^[0-9]+\.(?:[0-9]+\.)?html$"), "html")
        .when(F.col("name").rlike(r"^[0-9]+\.unknown$"), "unknown")
        .when(F.endswith("name", F.lit(".zip")) & F.col("num").isNotNull() & (F.col(size) == 0), "not_found")
        .when(F.endswith("name", F.lit(".zip")) & F.col("num").isNotNull(), "archive")
        .otherwise("other")
    )
    return (
        listing.withColumn("name", name)
        .withColumn("num", F.coalesce(legacy_num(F.col("name")), lead)).withColumn("state", state)
        .select(path, "name", "num", "state", size)
    )


def list_inbox(spark: SparkSession, *folders: str) -> DataFrame:
    """Files of one or more folders, classified; contents are not read."""
    return classify_inbox(list_files(spark, list(folders)))


def done_ids(inbox: DataFrame) -> DataFrame:
    """Ids that need no further fetch: new and legacy names of finished results."""
    return inbox.where(legacy_num(F.col("name")).isNotNull()).select("num").distinct()

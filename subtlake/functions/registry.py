"""Derived columns by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtlake.fixed_values import EXPORT_COLUMNS, STORED_COLUMNS
from subtlake.functions.dates import added_epoch
from subtlake.functions.text import clean_title, release_title

DERIVED: dict[str, Callable[[], Column]] = {
    "_MovieNameClean": lambda: clean_title(F.col("MovieName")),
    "MovieReleaseName": lambda: release_title(F.col("MovieReleaseName"), F.col("MovieYear")),
}

#: Derived columns of the id export: what the catalogue id does not tell, the time, the kind as a flag.
EXPORTED: dict[str, Callable[[], Column]] = dict(zip(EXPORT_COLUMNS, (
    lambda: F.when(F.col("ImdbID") == 0, F.col("MovieName")).otherwise(F.lit("")),
    lambda: F.when(F.col("ImdbID") == 0, F.col("MovieYear")).otherwise(F.lit(0)),
    lambda: added_epoch(F.col("SubAddDate")),
    lambda: (F.col("MovieKind") == "movie").cast("int"),
)))


def select_columns(df: DataFrame, names: list[str] = STORED_COLUMNS) -> DataFrame:
    """Project and order columns by name; a registered name wins over a plain column."""

    def build(name: str) -> Column:
        derived = DERIVED.get(name) or EXPORTED.get(name)
        return derived().alias(name) if derived else F.col(name)

    return df.select([build(name) for name in names])

"""Rows of a listing page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from subtlake.functions.dates import rating_x10

# What opens a listing row, and the text around each of its fields.
ROW_OPENS = "<tr onclick"
FIELDS = {
    "num": r'\bid="name(\d{1,10})"',
    "downloads": r">(\d+)x\n</a>",
    "votes": r'title="(\d+) votes"',
    "rating": r' votes">([0-9.]+)<',
    "uploader_id": r'/iduser-(\d+)"',
}


def extract_listing(html: Column) -> Column:
    """Page -> array of struct(num, downloads, rating 0–100, votes, uploader_id).

    The page is cut where rows open, and each field is taken from its own row: one that is missing is null.
    """
    pieces = F.split(html, ROW_OPENS, -1)
    rows = F.filter(F.slice(pieces, F.lit(2), F.size(pieces) - 1), lambda row: row.rlike(FIELDS["num"]))
    field = lambda row, name: F.regexp_extract(row, FIELDS[name], 1)
    return F.transform(
        rows,
        lambda row: F.struct(
            field(row, "num").try_cast("long").alias("num"), field(row, "downloads").try_cast("long").alias("downloads"),
            rating_x10(field(row, "rating").try_cast("decimal(6,2)")).alias("rating"), field(row, "votes").try_cast("long").alias("votes"),
            field(row, "uploader_id").try_cast("long").alias("uploader_id"),
        ),
    )


def captures(html: Column, pattern: str, groups: int) -> Column:
    """Page -> array of struct(c1…cn) for any pattern."""
    found = [F.regexp_extract_all(html, F.lit(pattern), F.lit(g)).alias(f"c{g}") for g in range(1, groups + 1)]
    return F.arrays_zip(*found)

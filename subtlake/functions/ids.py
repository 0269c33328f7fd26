"""Id arithmetic: shards, releases and their names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from subtlake.fixed_values import RELEASE_SIZE, SHARD_SIZE


def bucket_of(num: Column, size: int) -> Column:
    """Zero-based id bucket as a long."""
    return F.floor(num / F.lit(size)).cast("long") if size > 1 else num.cast("long")


def shard_of(num: Column, size: int = SHARD_SIZE) -> Column:
    return bucket_of(num, size)


def release_of(num: Column, size: int = RELEASE_SIZE) -> Column:
    return bucket_of(num, size)


def shard_name(shard: Column) -> Column:
    """7 -> 7xxx"""
    return F.concat(shard.cast("string"), F.lit("xxx"))


def shard_dir(shard: Column) -> Column:
    """60413 -> 604xxxxx; fewer than three digits -> 0xxxxx"""
    digits = shard.cast("string")
    return F.when(F.length(digits) > 2, F.concat(_drop_right(digits, 2), F.lit("xxxxx"))).otherwise(
        F.lit("0xxxxx")
    )


def shard_file(shard: Column) -> Column:
    return F.concat_ws("/", shard_dir(shard), shard_name(shard))


def shard_path(shard: Column) -> Column:
    """987654 -> 98/76/54xxx.db; a shard outside 0..999999 ends the job, a null one is null."""
    padded = F.lpad(shard.cast("string"), 6, "0")
    tree = F.concat(
        padded.substr(1, 2), F.lit("/"), padded.substr(3, 2), F.lit("/"), padded.substr(5, 2), F.lit("xxx.db")
    )
    beyond = F.raise_error(F.concat(F.lit("no path for shard "), shard.cast("string"))).cast("string")
    return F.when((shard >= 0) & (shard < 1_000_000), tree).when(shard.isNotNull(), beyond)


def pad_num(num: Column, width: int = 8) -> Column:
    """Zero-padded id; ids that are already longer stay whole."""
    digits = num.cast("string")
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)


def release_range(name: Column, size: int = RELEASE_SIZE) -> Column:
    """Release name -> struct(release_id, num_from, num_to, version).

    Two forms: ``….dump.<from>.to.<to>[.v<version>]`` and ``….dump.<id>xxxxx[.v<version>]``; null
    when the name fits neither or its range is not one whole release.
    """
    ranged = r"^.*\.dump\.([0-9]+)\.to\.([0-9]+)(?:\.v([0-9]+))?$"
    short = r"^.*\.dump\.([0-9]+)x{5}(?:\.v([0-9]+))?$"
    number = lambda pattern, group: F.nullif(F.regexp_extract(name, pattern, group), F.lit("")).try_cast("long")
    first, last = number(ranged, 1), number(ranged, 2)
    by_range = F.struct(
        bucket_of(first, size).alias("release_id"), first.alias("num_from"), last.alias("num_to"),
        number(ranged, 3).alias("version"),
    )
    release = number(short, 1)
    by_id = F.struct(
        release.alias("release_id"), (release * size).alias("num_from"),
        (release * size + size - 1).alias("num_to"), number(short, 2).alias("version"),
    )
    whole = (first % size == 0) & (first + size - 1 == last)
    return F.when(name.rlike(ranged) & whole, by_range).when(name.rlike(short), by_id)


def _drop_right(text: Column, count: int) -> Column:
    return F.substring(text, F.lit(1), F.length(text) - F.lit(count))

"""Title catalogue, blob table, id lists and ad samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subtlake.fixed_values import SHARD_SIZE
from subtlake.session import spread

_BASICS = ("tconst string, titleType string, primaryTitle string, originalTitle string, isAdult string, "
           "startYear string, endYear string, runtimeMinutes string, genres string")
_EPISODES = "tconst string, parentTconst string, seasonNumber string, episodeNumber string"
AD_SAMPLE_SCHEMA = "txt string, len int, pos int, sub long, lang string"


def _read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    r"""Header row, tabs, no quoting, ``\N`` for no value."""
    return spark.read.schema(schema).csv(path, sep="\t", header=True, quote="", escape="", nullValue="\\N")


def _catalogue_number(code: Column) -> Column:
    return F.substring(code, F.lit(3), F.length(code)).try_cast("long")


def _number(value: Column) -> Column:
    return F.coalesce(value.try_cast("long"), F.lit(0).cast("long"))


def read_title_basics(spark: SparkSession, path: str) -> DataFrame:
    raw = _read_tsv(spark, path, _BASICS)
    text = lambda name: F.coalesce(F.col(name), F.lit("")).alias(name)
    return raw.select(
        _catalogue_number(F.col("tconst")).alias("id"), text("titleType"), text("primaryTitle"), text("originalTitle"),
        _number(F.col("isAdult")).alias("isAdult"), _number(F.col("startYear")).alias("startYear"),
        _number(F.col("endYear")).alias("endYear"), _number(F.col("runtimeMinutes")).alias("runtimeMinutes"),
        text("genres"),
    )


def read_title_episodes(spark: SparkSession, path: str) -> DataFrame:
    raw = _read_tsv(spark, path, _EPISODES)
    return raw.select(
        _catalogue_number(F.col("tconst")).alias("id"), _catalogue_number(F.col("parentTconst")).alias("parent"),
        _number(F.col("seasonNumber")).alias("season"), _number(F.col("episodeNumber")).alias("episode"),
    )


def scan_blobs(blobs: DataFrame, first: int, last: int, num: str = "num") -> DataFrame:
    """Rows with ids in a closed range; the bounds reach the Parquet scan."""
    return blobs.where(F.col(num).between(first, last))


def read_ad_samples(spark: SparkSession, path: str) -> DataFrame:
    """``txt|len|pos|sub|lang``; the text may itself hold separators, so the last four fields are cut off."""
    parts = F.regexp_extract("value", r"(?s)^(.*)\|(-?\d+)\|(-?\d+)\|(\d+)\|([^|]*)$", 0)
    group = lambda i: F.regexp_extract("value", r"(?s)^(.*)\|(-?\d+)\|(-?\d+)\|(\d+)\|([^|]*)$", i)
    return spark.read.text(path).where(parts != "").select(
        group(1).alias("txt"), group(2).try_cast("int").alias("len"), group(3).try_cast("int").alias("pos"),
        group(4).try_cast("long").alias("sub"), group(5).alias("lang"),
    )


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Ids one per line; a leading ``+`` (added line of a diff) is allowed, other lines are not ids."""
    num = F.regexp_extract("value", r"^\+?([0-9]+)\s*$", 1).try_cast("long")
    return spark.read.text(path).select(num.alias("num")).where("num is not null")


def ids_of_shards(shards: DataFrame, shard: str = "shard", size: int = SHARD_SIZE) -> DataFrame:
    """All ids of finished shards: shard n covers n*size … n*size+size-1.

    A few shards are many ids, so a short input is spread before they are listed.
    """
    first = F.col(shard).cast("long") * size
    return spread(shards.select(shard)).select(F.explode(F.sequence(first, first + size - 1)).alias("num"))


def shard_of_file(path: Column) -> Column:
    """Shard id of a file named ``NNNxxx`` with or without an ending."""
    return F.regexp_extract(path, r"(?:^|/)([0-9]+)xxx(?:\.[a-z]+)?$", 1).try_cast("long")

"""Latest row per key, order, top rows and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtlake.functions.names import version_key
from subtlake.operators.numbering import Descending, number_rows


def dedupe_latest(df: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """One row per key, the one with the highest ``seq`` (last write wins). Combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    latest = F.max_by(F.struct(*rest), F.struct(*seq)).alias("_r")
    return df.groupBy(*keys).agg(latest).select(*keys, "_r.*").select(df.columns)


def last_row(df: DataFrame, num: str, columns: list[str]) -> DataFrame:
    """The row with the greatest id."""
    return df.select(num, *columns).orderBy(F.col(num).desc()).limit(1)


def sample_rows(df: DataFrame, num: str, n: int, seed: int = 42) -> DataFrame:
    """Repeatable sample of ``n`` ids."""
    return df.select(num).orderBy(F.md5(F.concat_ws(":", F.col(num).cast("string"), F.lit(str(seed)))), num).limit(n)


def version_sort(df: DataFrame, name: str) -> DataFrame:
    return df.orderBy(version_key(F.col(name)))


def place_by_version(df: DataFrame, name: str, tie: list[str], out: str = "place") -> DataFrame:
    """``out``: the place of each row in the version order of its name, equal names by ``tie``."""
    return number_rows(df, [], [version_key(F.col(name)), *[F.col(c) for c in tie]], out)


def shards_descending(shards: DataFrame, shard: str = "shard") -> DataFrame:
    """Numeric descending order of shard ids kept as text."""
    return shards.orderBy(F.col(shard).try_cast("long").desc())


def rank_newest_first(df: DataFrame, keys: list[str], num: str, **options) -> DataFrame:
    return number_rows(df, keys, [Descending(F.col(num))], "rank", **options)


def rank_by_popularity(df: DataFrame, keys: list[str], num: str, rating: str, votes: str, downloads: str,
                       **options) -> DataFrame:
    """Rank by rating, votes and downloads; the newer id first among equals."""
    order = [Descending(F.col(c)) for c in (rating, votes, downloads, num)]
    return number_rows(df, keys, order, "rank", **options)


def title_like(df: DataFrame, title: str, pattern: str) -> DataFrame:
    r"""Case-insensitive LIKE; ``\`` escapes ``%`` and ``_``."""
    return df.where(F.col(title).ilike(pattern))


def like_literal(text: str) -> str:
    """A literal text as a LIKE pattern."""
    return text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def filter_meta(
    df: DataFrame, *, lang: list[str] | None = None, kind: str | None = None, year: int | None = None,
    single_part: bool = False,
) -> DataFrame:
    """The lookup's predicates on metadata columns; what is None is not asked."""
    conditions: list[Column] = []
    if lang is not None:
        conditions.append(F.col("ISO639").isin(*lang))
    if kind is not None:
        conditions.append(F.col("MovieKind") == kind)
    if year is not None:
        conditions.append(F.col("MovieYear") == year)
    if single_part:
        conditions.append(F.col("SubSumCD") == 1)
    for condition in conditions:
        df = df.where(condition)
    return df

"""Archive statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtlake.operators.numbering import rolling
from subtlake.operators.skew import salted_join


def count_by_date(df: DataFrame, date: Column, chars: int, name: str) -> DataFrame:
    """Rows per prefix of the date text: 4 year, 7 month, 10 day."""
    return df.groupBy(F.substring(date, 1, chars).alias(name)).agg(F.count(F.lit(1)).alias("n"))


def rollup_date(df: DataFrame, date: Column) -> DataFrame:
    """Day, month, year and total counts in one pass."""
    parts = df.select(
        F.substring(date, 1, 4).alias("year"), F.substring(date, 1, 7).alias("month"), F.substring(date, 1, 10).alias("day")
    )
    return parts.rollup("year", "month", "day").agg(F.count(F.lit(1)).alias("n"))


def distinct_titles(df: DataFrame, title: str, kind: Column) -> DataFrame:
    return df.where(kind).agg(F.count_distinct(title).alias("titles"))


def distinct_groups(df: DataFrame, title: str, year: str, lang: Column) -> DataFrame:
    return df.where(lang).select(title, year).distinct().agg(F.count(F.lit(1)).alias("groups"))


def outcome_totals(df: DataFrame, outcome: Column, keys: list[str]) -> DataFrame:
    """Requests, ok, failed and takedowns; each request counts once."""
    row = df.withColumn("_o", outcome)
    return row.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("_o") == "ok").alias("ok"),
        F.count_if(F.col("_o") != "ok").alias("failed"), F.count_if(F.col("_o") == "takedown").alias("takedown"),
    )


def fetch_windows(df: DataFrame, keys: list[str], ts: str, tie: str, duration: Column, is_error: Column,
                  short: int = 100, long: int = 1000, **options) -> DataFrame:
    """Per result: mean duration and mean microseconds between completions over the last ``short`` results, and
    the share of errors over the last ``long``."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts).cast("timestamp_ntz"))
    timed = df.withColumn("_us", micros)

    def columns(last):
        near = last(short)
        steps = F.count(F.lit(1)).over(near) - 1
        span = F.max("_us").over(near) - F.min("_us").over(near)
        return {
            "avg_duration": F.avg(duration).over(near),
            "avg_between_us": F.when(steps > 0, F.floor(span / steps)),
            "error_rate": F.avg(is_error.cast("int")).over(last(long)),
        }

    return rolling(timed, keys, [F.col(ts), F.col(tie)], columns, long, **options).drop("_us")


def quota_delta(df: DataFrame, keys: list[str], ts: str, tie: str, quota: str, **options) -> DataFrame:
    """Quota against the result before, per group."""
    def columns(last):
        two = last(2)
        before = F.when(F.count(F.lit(1)).over(two) > 1, F.first(quota).over(two))
        return {"delta": F.col(quota) - before}

    return rolling(df, keys, [F.col(ts), F.col(tie)], columns, 2, **options)


def quota_used(df: DataFrame, keys: list[str], ts: str, tie: str, quota: str) -> DataFrame:
    """Last minus first quota per group."""
    at = F.struct(ts, tie)
    return df.groupBy(*keys).agg((F.max_by(quota, at) - F.min_by(quota, at)).alias("used"))


def capture_bounds(df: DataFrame, captures: Column, groups: list[str]) -> DataFrame:
    """Shortest and longest text per capture group, over all matches."""
    found = df.select(F.inline(captures))
    return found.agg(
        *[f(F.length(g)).cast("long").alias(f"{n}_{g}") for g in groups for n, f in (("min", F.min), ("max", F.max))]
    )


def size_summary(df: DataFrame, size: Column, total_rows: int) -> DataFrame:
    """Rows, bytes, average, progress against the expected number of rows, and the projected total size."""
    sums = df.agg(F.count(F.lit(1)).alias("files"), F.sum(size).alias("bytes"))
    progress = F.col("files") / F.lit(total_rows) * 100
    return sums.select(
        "files", "bytes", F.round(F.col("bytes") / F.col("files"), 4).alias("avg_bytes"),
        F.round(progress, 4).alias("progress_percent"), projected_size(F.col("bytes"), progress).alias("projected_bytes"),
    )


def projected_size(size: Column, progress_percent: Column) -> Column:
    """Linear projection to 100 %, cut to a whole number."""
    return F.floor(size / (progress_percent / F.lit(100))).cast("long")


def group_size_ratio(df: DataFrame, keys: list[str], stored: Column, plain: Column) -> DataFrame:
    """Stored and plain bytes per group, and the rounded percentage."""
    return (
        df.groupBy(*keys).agg(F.sum(stored).alias("stored_bytes"), F.sum(plain).alias("plain_bytes"))
        .withColumn("percent", F.round(F.col("stored_bytes") / F.col("plain_bytes") * 100).cast("long"))
    )


def average_saving(log: DataFrame, line: str) -> DataFrame:
    """Mean of the ``N% smaller`` figures in log lines."""
    value = F.regexp_extract(F.col(line), r"(\d+)% smaller", 1).try_cast("long")
    return log.select(value.alias("v")).agg(F.round(F.avg("v"), 4).alias("avg_saving"), F.count("v").alias("lines"))


def lang_histogram(df: DataFrame, lang: Column, size: Column) -> DataFrame:
    return df.groupBy(lang.alias("lang")).agg(F.count(F.lit(1)).alias("files"), F.sum(size).alias("bytes"))


def error_histogram(df: DataFrame, errors: Column) -> DataFrame:
    return df.select(F.explode(errors).alias("error")).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


def row_count(df: DataFrame, kind: Column | None = None) -> DataFrame:
    """(rows): all rows, or those of a kind."""
    return df.agg((F.count(F.lit(1)) if kind is None else F.count_if(kind)).alias("rows"))


def daily_quota(df: DataFrame, account: str, ts: str, quota: int, share: float) -> DataFrame:
    """Downloads per account and day; exceeded above the given share of the quota."""
    return (
        df.groupBy(account, F.col(ts).cast("date").alias("day")).agg(F.count(F.lit(1)).alias("downloads"))
        .withColumn("exceeded", F.col("downloads") > F.lit(quota * share))
    )


def title_to_subs(titles: DataFrame, meta: DataFrame, catalogue_id: str) -> DataFrame:
    """Metadata rows of each title. One title may own most rows."""
    return salted_join(meta, titles, catalogue_id)


def episode_rollup(episodes: DataFrame, titles: DataFrame, meta: DataFrame) -> DataFrame:
    """Subtitles per parent title, season and episode. ``episodes`` (id, parent, season, episode), ``titles``
    (id, title), ``meta`` (imdb_id, num). Rows are counted per episode before the parents are joined."""
    per_episode = meta.groupBy("imdb_id").agg(F.count(F.lit(1)).alias("subs"))
    named = titles.select(F.col("id").alias("parent"), F.col("title").alias("parent_title"))
    return (
        episodes.join(per_episode, episodes["id"] == per_episode["imdb_id"]).join(named, "parent")
        .select("parent", "parent_title", "season", "episode", "id", "subs")
    )

"""Fetch results. Events stand for them: type and value give status and page, value the duration."""

from __future__ import annotations

from pyspark.sql import functions as F

from subtlake.fixed_values import PAGE_PHRASES
from subtlake.functions.dates import epoch_seconds, week_end, week_index, week_start
from subtlake.functions.outcome import classify_outcome, outcome_flags
from subtlake.operators import stats
from subtlake.plans.registry import query, table

# outcome of each event as the SQL side sees it; view pages of value k*10.. carry phrase k
_VIEW = " ".join(
    f"WHEN event_type = 'view' AND value >= {i * 10} AND value < {i * 10 + 10} THEN '{outcome}'"
    for i, (_, outcome) in enumerate(PAGE_PHRASES)
)
_OUTCOME = f"""CASE WHEN event_type = 'click' THEN 'ok' {_VIEW} WHEN event_type = 'view' THEN 'html'
  WHEN event_type = 'purchase' THEN 'not_found'
  WHEN event_type = 'error' AND value < 10 THEN 'retry' WHEN event_type = 'error' AND value < 20 THEN 'takedown'
  WHEN event_type = 'error' AND value < 40 THEN 'pause' WHEN event_type = 'error' AND value < 60 THEN 'blocked'
  WHEN event_type = 'error' AND value < 80 THEN 'pause' WHEN event_type = 'error' AND value < 100 THEN 'wait'
  WHEN event_type = 'error' THEN 'retry' ELSE 'html' END"""


def results(spark, sf):
    """Events as fetch results: status, content_type, body, outcome, duration in ms."""
    kind, value = F.col("event_type"), F.col("value")
    page = F.lit("<html><body>page</body></html>")
    for i, (phrase, _) in enumerate(PAGE_PHRASES):
        page = F.when((value >= i * 10) & (value < i * 10 + 10), F.lit(f"<html>{phrase}</html>")).otherwise(page)
    refusal = (
        F.when(value < 10, F.lit("")).when(value < 20, F.lit('{"code":"RESP001"}'))
        .when(value < 40, F.lit('{"code":"AUTH006"}')).when(value < 60, F.lit('{"code":"BLK0001"}'))
        .when(value < 80, F.lit("forbidden")).otherwise(F.lit("overloaded"))
    )
    status = (
        F.when(kind == "purchase", 404)
        .when((kind == "error") & (value < 80), 403).when((kind == "error") & (value < 100), 503)
        .when(kind == "error", 429).otherwise(200)
    )
    content_type = F.when(kind == "click", "application/zip").otherwise("text/html; charset=UTF-8")
    body = F.when(kind == "view", page).when(kind == "error", refusal).otherwise("")
    events = table(spark, sf, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", status.alias("status"),
        content_type.alias("content_type"), body.alias("body"),
    )
    outcome = classify_outcome(F.col("status"), F.col("content_type"), F.col("body"))
    return events.withColumn("outcome", outcome).withColumn("ms", F.round(F.col("value") * 100).cast("long"))


@query(f"SELECT event_id, {_OUTCOME} AS outcome FROM events")
def classify_outcomes(spark, sf):
    return results(spark, sf).select("event_id", "outcome")


@query(f"""
SELECT outcome, ok, retry, pause, wait, not_found, takedown, change_address, n FROM (
  SELECT {_OUTCOME} AS outcome, count(*) AS n FROM events GROUP BY 1) o JOIN (
  SELECT unnest(['ok','wait','not_found','takedown','quota','challenge','pause','blocked','retry','html']) AS outcome,
    unnest([true,false,false,false,false,false,false,false,false,false]) AS ok,
    unnest([false,true,false,false,false,false,true,true,true,true]) AS retry,
    unnest([false,false,false,false,false,false,true,true,false,false]) AS pause,
    unnest([false,true,false,false,false,false,false,false,false,false]) AS wait,
    unnest([false,false,true,true,false,false,false,false,false,false]) AS not_found,
    unnest([false,false,false,true,false,false,false,false,false,false]) AS takedown,
    unnest([false,false,false,false,false,false,false,true,false,false]) AS change_address) USING (outcome)""")
def outcome_flag_counts(spark, sf):
    rows = results(spark, sf).withColumn("f", outcome_flags(F.col("outcome"))).select("outcome", "f.*")
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


@query(f"""
SELECT user_id, count(*) AS requests, count(*) FILTER (o = 'ok') AS ok, count(*) FILTER (o <> 'ok') AS failed,
       count(*) FILTER (o = 'takedown') AS takedown
FROM (SELECT user_id, {_OUTCOME} AS o FROM events) GROUP BY user_id""")
def outcome_totals(spark, sf):
    return stats.outcome_totals(results(spark, sf), F.col("outcome"), ["user_id"])


def _windows(spark, sf):
    return stats.fetch_windows(
        results(spark, sf), ["event_type"], "ts", "event_id", F.col("ms"), F.col("value") > 100
    )


@query("""
SELECT event_id, round(avg(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY event_type ORDER BY ts, event_id
       ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), 6) AS avg_duration FROM events""")
def moving_avg(spark, sf):
    return _windows(spark, sf).select("event_id", F.round("avg_duration", 6).alias("avg_duration"))


@query("""
SELECT event_id, CASE WHEN n > 0 THEN (last - first) // n END AS avg_between_us FROM (
  SELECT event_id, epoch_us(max(ts) OVER w) AS last, epoch_us(min(ts) OVER w) AS first, count(*) OVER w - 1 AS n
  FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW))""")
def inter_completion(spark, sf):
    return _windows(spark, sf).select("event_id", "avg_between_us")


@query("""
SELECT event_id, round(avg(CASE WHEN value > 100 THEN 1 ELSE 0 END) OVER (PARTITION BY event_type ORDER BY ts, event_id
       ROWS BETWEEN 999 PRECEDING AND CURRENT ROW), 9) AS error_rate FROM events""")
def error_rate(spark, sf):
    return _windows(spark, sf).select("event_id", F.round("error_rate", 9).alias("error_rate"))


@query("""
SELECT event_id, quota - lag(quota) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS delta
FROM (SELECT *, CAST(floor(value) AS BIGINT) AS quota FROM events)""")
def quota_delta(spark, sf):
    events = table(spark, sf, "events").withColumn("quota", F.floor("value").cast("long"))
    return stats.quota_delta(events, ["user_id"], "ts", "event_id", "quota").select("event_id", "delta")


@query("""
SELECT user_id, arg_max(q, epoch_us(ts)) - arg_min(q, epoch_us(ts)) AS used
FROM (SELECT user_id, ts, CAST(floor(value) AS BIGINT) AS q FROM events) GROUP BY user_id""")
def quota_used(spark, sf):
    events = table(spark, sf, "events").withColumn("quota", F.floor("value").cast("long"))
    return stats.quota_used(events, ["user_id"], "ts", "event_id", "quota")


@query("""
SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS downloads, count(*) > 10 * 0.5 AS exceeded FROM events GROUP BY 1, 2""")
def daily_quota(spark, sf):
    return stats.daily_quota(table(spark, sf, "events"), "user_id", "ts", 10, 0.5)


@query("""
SELECT week, count(*) AS n, week * 604800 AS first_second, (week + 1) * 604800 - 1 AS last_second,
       CAST(min(d) AS BIGINT) AS first_day
FROM (SELECT CAST(floor(epoch(ts) / 604800) AS BIGINT) AS week, date_diff('day', DATE '2000-01-01', CAST(ts AS DATE)) AS d
      FROM events) GROUP BY week""")
def week_idx(spark, sf):
    from subtlake.functions.dates import days_since_2000

    weeks = table(spark, sf, "events").select(week_index(F.col("ts")).alias("week"), days_since_2000(F.col("ts")).alias("d"))
    return weeks.groupBy("week").agg(F.count(F.lit(1)).alias("n"), F.min("d").cast("long").alias("first_day")).select(
        "week", "n", week_start(F.col("week")).alias("first_second"), week_end(F.col("week")).alias("last_second"), "first_day"
    )


@query("SELECT event_id, CAST(round(CAST(value AS DECIMAL(10,2)) * 10) AS INTEGER) AS rating FROM events")
def rating_int(spark, sf):
    from subtlake.functions.dates import rating_x10

    return table(spark, sf, "events").select("event_id", rating_x10(F.col("value").cast("decimal(10,2)")).alias("rating"))

"""Streams over the events table, dealt to several files with late rows, run until their input is used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from subtlake.operators import ranking
from subtlake.plans.inputs import write_marks
from subtlake.plans.registry import query, table
from subtlake.session import scratch_path
from subtlake.streaming import streams


#: Rows come at most so late.
LATE = "8 days"


def event_streams(spark, sf):
    """The events as a stream that grows five times: by time, but every seventh id a time late.

    Each turn writes one part; what runs on the stream then takes all its files as one batch, and goes on from its checkpoint the next
    turn. So a part may have many files, and rows of its first file are not late because of its last one.
    """
    rows = table(spark, sf, "events").withColumn("at", F.col("ts").cast("timestamp"))
    part = F.least(F.lit(3), F.floor(F.dayofmonth("ts") / 8)) + (F.col("event_id") % 7 == 0).cast("int")
    path = scratch_path(spark, "events")
    for i in range(5):
        rows.where(part == i).write.mode("append").parquet(path)
        yield spark.readStream.schema(rows.schema).parquet(path)


@query("""
SELECT event_id AS num, CASE event_type WHEN 'click' THEN 'archive' WHEN 'error' THEN 'takedown' WHEN 'purchase' THEN 'not_found'
  ELSE 'html' END AS state FROM events""")
def stream_inbox(spark, sf):
    """A file per event in folders; the stream runs after the first half of the month and again after the second."""
    num = F.col("event_id").cast("string")
    ending = (
        F.when(F.col("event_type") == "click", ".t.(1999).eng.1cd.zip").when(F.col("event_type") == "error", ".dmca")
        .when(F.col("event_type") == "purchase", ".not-found").otherwise(".html")
    )
    root = scratch_path(spark, "inbox")
    size = F.when(F.col("event_type") == "click", 10).otherwise(0)
    names = table(spark, sf, "events").select(F.concat(num, ending).alias("name"), size.alias("size"), F.dayofmonth("ts").alias("day"))
    for half in (names.where("day <= 15"), names.where("day > 15")):
        folders = write_marks(half, f"{root}/new")
        listed = streams.stream_inbox(spark, *folders, settle_ms=0)
        streams.run_available(listed, f"{root}/table", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/table").select("num", "state")


@query("""
SELECT user_id, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def upsert_latest(spark, sf):
    root = scratch_path(spark, "ratings")
    for rows in event_streams(spark, sf):
        streams.upsert_latest(rows.select("user_id", "event_id", "ts", "value"), ["user_id"], ["ts", "event_id"], root, every=2)
    return streams.read_latest(spark, root, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "value")


@query("""
SELECT num, value FROM (
  SELECT o_orderkey AS num, o_totalprice AS value FROM orders WHERE o_orderkey NOT IN (SELECT event_id FROM events)
  UNION ALL SELECT event_id, value FROM events)""")
def incremental_metadata(spark, sf):
    """A full table, then the rows of a stream laid over it by id."""
    root = scratch_path(spark, "meta")
    full = table(spark, sf, "orders").select(F.col("o_orderkey").alias("num"), F.lit(0).alias("seq"), F.col("o_totalprice").alias("value"))
    streams.replace_table(full, root)
    for newer in event_streams(spark, sf):
        streams.upsert_latest(newer.select(F.col("event_id").alias("num"), F.lit(1).alias("seq"), "value"), ["num"], ["seq"], root)
    return streams.read_latest(spark, root, ["num"], ["seq"]).select("num", "value")


@query("""
SELECT user_id, event_id, value FROM (
  SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next, max(ts) OVER () AS newest FROM events)
WHERE (next IS NULL OR next >= ts + INTERVAL 1 DAY) AND ts <= newest - INTERVAL 9 DAY""")
def delayed_release(spark, sf):
    """The newest row of each user that no other followed within a day, once nothing late can come before that."""
    root = scratch_path(spark, "delayed")
    for stream in event_streams(spark, sf):
        rows = stream.select("user_id", "event_id", "at", "value")
        streams.run_available(streams.delayed_release(rows, ["user_id"], "at", days=1, late=LATE), f"{root}/table", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/table").select("user_id", "event_id", "value")


@query("SELECT event_id, value FROM events WHERE ts <= (SELECT max(ts) FROM events) - INTERVAL 7 DAY")
def releasable(spark, sf):
    return streams.releasable(table(spark, sf, "events"), "ts").select("event_id", "value")


@query("""
SELECT o_orderkey // 5 AS shard, count(*) AS have, max(ts) AS last_arrival FROM orders LEFT JOIN events ON event_id = o_orderkey
GROUP BY 1 HAVING count(event_id) = count(*)""")
def shard_completion(spark, sf):
    """Shards of five ids whose expected ids (orders) have all arrived as events; other events do not count."""
    root = scratch_path(spark, "completion")
    expected = table(spark, sf, "orders").select(F.col("o_orderkey").alias("event_id"))
    for stream in event_streams(spark, sf):
        streams.shard_completion(stream, expected, "event_id", "at", root, 5)
    done = spark.read.option("pathGlobFilter", "*.parquet").parquet(f"{root}/version=*")
    return done.select("shard", "have", F.col("last_arrival").cast("timestamp_ntz").alias("last_arrival"))


@query("""
SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS requests,
  count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1, 2""")
def tumbling_totals(spark, sf):
    root = scratch_path(spark, "tumbling")
    outcome = F.when(F.col("event_type") == "error", "retry").otherwise("ok")
    for stream in event_streams(spark, sf):
        _write_updates(streams.tumbling_totals(stream, "at", ["event_type"], outcome, late=LATE), root)
    return _window_rows(spark, root, ["window_start", "event_type"])


@query("""
SELECT window_start, count(*) AS requests, round(avg(e), 6) AS error_rate FROM (
  SELECT CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS e,
    time_bucket(INTERVAL 10 MINUTE, ts) - to_minutes(CAST(10 * k AS BIGINT)) AS window_start
  FROM events, (SELECT unnest(generate_series(0, 5)) AS k)) GROUP BY window_start""")
def sliding_error_rate(spark, sf):
    root = scratch_path(spark, "sliding")
    for stream in event_streams(spark, sf):
        _write_updates(streams.sliding_error_rate(stream, "at", F.col("event_type") == "error", late=LATE), root)
    return _window_rows(spark, root, ["window_start"])


def _write_updates(rows, root):
    """The rows that each batch updates, with its number."""
    def write(batch, epoch):
        batch.withColumn("_epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{root}/version={epoch}")

    streams.run_batches(rows, write, f"{root}/_checkpoint", "update")


def _updated(spark, root, keys):
    """The last update of each key."""
    rows = spark.read.option("pathGlobFilter", "*.parquet").parquet(f"{root}/version=*")
    return ranking.dedupe_latest(rows.drop("version"), keys, ["_epoch"]).drop("_epoch")


def _window_rows(spark, root, keys):
    latest = _updated(spark, root, keys)
    return latest.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("""
SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS downloads, count(*) > 10 * 0.5 AS exceeded FROM events GROUP BY 1, 2""")
def stream_daily_quota(spark, sf):
    """The same count kept by a stream, updated batch by batch."""
    root = scratch_path(spark, "quota")
    for stream in event_streams(spark, sf):
        _write_updates(streams.daily_quota(stream, "user_id", "at", 10, 0.5, LATE), root)
    return _updated(spark, root, ["user_id", "day"])

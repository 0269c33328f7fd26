"""The archive's tables kept current by streams.

Each job takes a streaming DataFrame and returns either a streaming DataFrame or a started-and-finished
query (``availableNow``), so the same code serves a steady trigger.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from subtlake.fixed_values import SHARD_SIZE
from subtlake.functions.ids import bucket_of
from subtlake.operators.ranking import dedupe_latest
from subtlake.sources.inbox import classify_inbox
from subtlake.sources.listing import stream_files

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Append a stream's rows to a Parquet table until its input is used up."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer.outputMode(mode).trigger(availableNow=True).start().awaitTermination()


def run_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                mode: str = "update") -> None:
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(mode)
    query.trigger(availableNow=True).start().awaitTermination()


def stream_inbox(spark: SparkSession, *folders: str, settle_ms: int = 1000) -> DataFrame:
    """New result files of folders, classified by name."""
    return classify_inbox(stream_files(spark, list(folders), settle_ms))


def classify_stream(listing: DataFrame) -> DataFrame:
    """The same for a stream of listing rows (path, size)."""
    return classify_inbox(listing)


def _generation(spark: SparkSession, root: str) -> int:
    """Number of the table's current folder: the highest in its log, 0 before the first entry."""
    try:
        return spark.read.schema("generation long").json(f"{root}/log").agg(F.max("generation")).first()[0] or 0
    except AnalysisException as error:  # no log yet
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0


def replace_table(rows: DataFrame, root: str) -> None:
    """Make ``rows`` the whole content of the table below ``root``.

    They are written as the base of a new folder; the log then points readers and later batches to it. A run that
    ends before the log entry leaves the table as it was. Folders of lower numbers are read no more and may be deleted.
    """
    spark = rows.sparkSession
    generation = _generation(spark, root) + 1
    rows.write.mode("overwrite").parquet(f"{root}/generation-{generation}/base")
    spark.createDataFrame([(generation,)], "generation long").coalesce(1).write.mode("append").json(f"{root}/log")


def upsert_latest(stream: DataFrame, keys: list[str], seq: list[str], root: str, every: int = 50) -> None:
    """Keep the latest row per key of a stream in the table below ``root``, one writer at a time.

    Every batch is reduced to its own latest rows and added to the current folder under the stream's id and the batch
    number, so a repeated batch replaces itself, and another stream on the same table replaces nothing. After each
    ``every`` batches the folder is folded into a new one, so a read never merges more than that.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        stream_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        place = f"{root}/generation-{_generation(spark, root)}"
        dedupe_latest(batch, keys, seq).write.mode("overwrite").parquet(f"{place}/{stream_id}-{epoch}")
        if epoch % every == every - 1:
            compact_latest(spark, root, keys, seq)

    run_batches(stream, write, f"{root}/_checkpoint", "append")


def read_latest(spark: SparkSession, root: str, keys: list[str], seq: list[str]) -> DataFrame:
    return dedupe_latest(spark.read.parquet(f"{root}/generation-{_generation(spark, root)}/*"), keys, seq)


def compact_latest(spark: SparkSession, root: str, keys: list[str], seq: list[str]) -> None:
    """Fold the table into one sorted-out copy; not beside a running stream, which folds by itself."""
    replace_table(read_latest(spark, root, keys, seq), root)


def delayed_release(stream: DataFrame, keys: list[str], ts: str, days: int = 7, late: str = "0 seconds") -> DataFrame:
    """Rows that stayed unchanged for ``days`` after their arrival; a change before that replaces the row.

    One session per key closes when no newer row came within the delay.
    """
    rest = [c for c in stream.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.col(ts)).alias("_r")
    sessions = stream.withWatermark(ts, late).groupBy(F.session_window(ts, f"{days} days"), *keys)
    return sessions.agg(newest).select(*keys, "_r.*")


def releasable(df: DataFrame, ts: str, days: int = 7) -> DataFrame:
    """Batch form: rows at least ``days`` older than the newest row."""
    return df.where(F.col(ts) <= df.agg(F.max(ts)).scalar() - F.expr(f"interval {days} days"))


#: Ids whose shards share one state.
STATE_IDS = 1 << 16


def shard_completion(stream: DataFrame, expected: DataFrame, num: str, ts: str, root: str, shard_size: int = SHARD_SIZE) -> None:
    """Append (shard, have, last_arrival) to the table at ``root`` once the last expected id of a shard has arrived.

    ``expected`` holds the ids that shards consist of; other ids and repeats do not count, null ids neither. The state
    is one bit per id and the latest time and a mark per shard, kept for a run of shards together: the work of a batch grows
    with its rows, not with the number of small shards. A shard that is marked complete is not reported again.
    ``last_arrival`` is the latest time among the ids that counted.
    """
    ids = expected.select(F.col(num)).where(F.col(num).isNotNull()).distinct()
    counts = ids.groupBy(bucket_of(F.col(num), shard_size).alias("shard")).agg(F.count(F.lit(1)).alias("expected"))
    shard = bucket_of(F.col(num), shard_size)
    run = max(1, STATE_IDS // shard_size)
    arrived = stream.join(ids, num, "left_semi").select(
        shard.alias("shard"), (F.col(num) - shard * shard_size).cast("int").alias("slot"), F.unix_micros(ts).alias("at")
    )
    none = -(1 << 62)

    def fill(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, last, done = np.zeros((run, shard_size), bool), np.full(run, none, np.int64), np.zeros(run, bool)
        if state.exists:
            bits, times, marks = state.get
            seen = np.unpackbits(np.frombuffer(bits, np.uint8), count=run * shard_size).astype(bool).reshape(run, shard_size)
            last, done = np.frombuffer(times, np.int64).copy(), np.unpackbits(np.frombuffer(marks, np.uint8), count=run).astype(bool)
        want, before = np.zeros(run, np.int64), seen.copy()
        for frame in frames:
            places, slots = (frame["shard"] - key[0] * run).to_numpy(), frame["slot"].to_numpy()
            want[places] = frame["expected"].to_numpy()
            new = ~before[places, slots] & ~done[places]
            np.maximum.at(last, places[new], frame["at"].fillna(none).to_numpy().astype(np.int64)[new])
            seen[places, slots] = True
        full = np.flatnonzero((want > 0) & ~done & (seen.sum(axis=1) >= want))
        done[full] = True
        state.update((np.packbits(seen).tobytes(), last.tobytes(), np.packbits(done).tobytes()))
        if len(full):
            yield pd.DataFrame({"shard": key[0] * run + full, "have": want[full], "last": last[full]})

    done = arrived.join(counts, "shard").withColumn("run", bucket_of(F.col("shard"), run)).groupBy("run").applyInPandasWithState(
        fill, "shard long, have long, last long", "seen binary, last binary, done binary", "update", GroupStateTimeout.NoTimeout
    )

    def write(batch: DataFrame, epoch: int) -> None:
        rows = batch.select("shard", "have", F.when(F.col("last") > -(1 << 62), F.timestamp_micros("last")).alias("last_arrival"))
        rows.write.mode("overwrite").parquet(f"{root}/version={epoch}")

    run_batches(done, write, f"{root}/_checkpoint")


def daily_quota(stream: DataFrame, account: str, ts: str, quota: int, share: float, late: str = "1 day") -> DataFrame:
    """Downloads per account and day, exceeded above the given share of the quota.

    Days are those of UTC; the state of a day ends ``late`` after it.
    """
    counts = stream.withWatermark(ts, late).groupBy(account, F.window(ts, "1 day")).agg(F.count(F.lit(1)).alias("downloads"))
    return counts.select(
        account, F.date_from_unix_date(F.floor(F.unix_seconds("window.start") / 86_400).cast("int")).alias("day"), "downloads",
        (F.col("downloads") > F.lit(quota * share)).alias("exceeded"),
    )


def tumbling_totals(stream: DataFrame, ts: str, keys: list[str], outcome: Column, size: str = "1 hour",
                    late: str = "10 minutes") -> DataFrame:
    """Requests and errors per time window."""
    return (
        stream.withWatermark(ts, late).withColumn("_o", outcome).groupBy(F.window(ts, size), *keys)
        .agg(F.count(F.lit(1)).alias("requests"), F.count_if(F.col("_o") != "ok").alias("errors"))
        .select(F.col("window.start").alias("window_start"), *keys, "requests", "errors")
    )


def sliding_error_rate(stream: DataFrame, ts: str, is_error: Column, size: str = "1 hour", step: str = "10 minutes",
                       late: str = "10 minutes") -> DataFrame:
    """Share of errors per sliding window."""
    return (
        stream.withWatermark(ts, late).groupBy(F.window(ts, size, step))
        .agg(F.count(F.lit(1)).alias("requests"), F.avg(is_error.cast("int")).alias("_rate"))
        .select(F.col("window.start").alias("window_start"), "requests", F.round("_rate", 6).alias("error_rate"))
    )

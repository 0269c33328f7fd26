"""Which ids are expected, present, deleted, missing; which shards and releases are complete."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from subtlake.fixed_values import RELEASE_SIZE, SHARD_SIZE
from subtlake.functions.ids import bucket_of, shard_of

STATES = ["expected", "actual", "not_found", "takedown"]


def union_ids(*frames: DataFrame) -> DataFrame:
    """Distinct ids over several snapshots or sources (column ``num``)."""
    return reduce(DataFrame.unionByName, [f.select("num") for f in frames]).distinct()


def reconcile(expected: DataFrame, actual: DataFrame, not_found: DataFrame, takedown: DataFrame) -> DataFrame:
    """One row per id with a flag per state and ``missing``.

    One union and one aggregate: repeated ids collapse before the only shuffle.
    """
    frames = dict(zip(STATES, (expected, actual, not_found, takedown)))
    flagged = [
        frame.select(F.col("num").cast("long").alias("num"), *[F.lit(s == name).alias(s) for s in STATES])
        for name, frame in frames.items()
    ]
    merged = reduce(DataFrame.unionByName, flagged).groupBy("num").agg(*[F.max(s).alias(s) for s in STATES])
    missing = F.col("expected") & ~F.col("actual") & ~F.col("not_found") & ~F.col("takedown")
    return merged.withColumn("missing", missing)


def shard_status(flags: DataFrame, shard_size: int = SHARD_SIZE) -> DataFrame:
    """Counts per shard; complete when something is expected and nothing is missing."""
    count = lambda condition, name: F.count_if(condition).alias(name)
    return (
        flags.groupBy(shard_of(F.col("num"), shard_size).alias("shard"))
        .agg(
            count(F.col("expected"), "expected"), count(F.col("expected") & F.col("actual"), "have"),
            count(F.col("not_found"), "not_found"), count(F.col("takedown"), "takedown"),
            count(F.col("missing"), "missing"),
        )
        .withColumn("complete", (F.col("expected") > 0) & (F.col("missing") == 0))
    )


def release_status(shards: DataFrame, shards_per_release: int = RELEASE_SIZE // SHARD_SIZE) -> DataFrame:
    """Complete shards per release; a release is complete when it has all of them."""
    return (
        shards.groupBy(bucket_of(F.col("shard"), shards_per_release).alias("release_id"))
        .agg(F.count_distinct(F.when(F.col("complete"), F.col("shard"))).alias("shards"))
        .withColumn("complete", F.col("shards") == shards_per_release)
    )


def missing_per_shard(flags: DataFrame, shard_size: int = SHARD_SIZE) -> DataFrame:
    return flags.where("missing").groupBy(shard_of(F.col("num"), shard_size).alias("shard")).agg(
        F.count(F.lit(1)).alias("missing")
    )


def nearly_complete_first(flags: DataFrame, shard_size: int = SHARD_SIZE) -> DataFrame:
    """Missing ids, those of the shard that lacks least first. Shards hold at most ``shard_size`` ids."""
    return (
        flags.where("missing").select("num", shard_of(F.col("num"), shard_size).alias("shard"))
        .withColumn("shard_missing", F.count(F.lit(1)).over(W.partitionBy("shard")))
        .orderBy("shard_missing", "shard", "num")
    )


def next_missing(flags: DataFrame, n: int = 200, release_size: int = RELEASE_SIZE) -> DataFrame:
    """The first ``n`` missing ids of the lowest release that lacks any."""
    missing = flags.where("missing").select("num", bucket_of(F.col("num"), release_size).alias("release_id"))
    lowest = missing.agg(F.min("release_id").alias("release_id"))
    return missing.join(F.broadcast(lowest), "release_id").orderBy("num").limit(n)


def packable(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Expected ids that are present."""
    return expected.select("num").intersect(actual.select("num"))


def except_done(missing: DataFrame, done: DataFrame) -> DataFrame:
    """Missing list without done ids."""
    return missing.join(done.select("num"), "num", "left_anti")


def release_semi(blobs: DataFrame, meta: DataFrame) -> DataFrame:
    """Blobs that the metadata still lists; nothing is required of the rest."""
    return blobs.join(meta.select("num"), "num", "left_semi")


def already_released(shards: DataFrame, released: DataFrame, shards_per_release: int) -> DataFrame:
    """Complete releases without an entry in ``released`` (column ``release_id``)."""
    return (
        release_status(shards, shards_per_release).where("complete").select("release_id")
        .join(released.select("release_id"), "release_id", "left_anti")
    )


def reconcile_counts(blobs: DataFrame, meta: DataFrame) -> DataFrame:
    """Ids on both sides, only in the blobs, only in the metadata: (presence, ids)."""
    both = (
        blobs.select("num", F.lit(1).alias("side")).unionByName(meta.select("num", F.lit(2).alias("side")))
        .groupBy("num").agg(F.bit_or("side").alias("sides"))
    )
    label = F.when(F.col("sides") == 3, "both").when(F.col("sides") == 1, "blob only").otherwise("metadata only")
    return both.groupBy(label.alias("presence")).agg(F.count(F.lit(1)).alias("ids"))


def work_queue(wanted: DataFrame, done: DataFrame, first: int, last: int, n: int | None = None,
               seed: int | None = None) -> DataFrame:
    """Wanted ids of a window that are not done, ascending or in seeded order, cut to the remaining budget."""
    todo = (
        wanted.where(F.col("num").between(first, last)).select("num").distinct()
        .join(done.select("num"), "num", "left_anti")
    )
    ordered = todo.orderBy("num") if seed is None else todo.orderBy(F.xxhash64("num", F.lit(seed)), "num")
    return ordered if n is None else ordered.limit(n)


def drop_html_if_archive(inbox: DataFrame) -> DataFrame:
    """Error pages whose id also has an archive: the ones to delete."""
    archives = inbox.where(F.col("state") == "archive").select("num")
    return inbox.where(F.col("state") == "html").join(archives, "num", "left_semi")

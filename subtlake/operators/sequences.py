"""Gaps, islands and carry-over along the id axis, by id bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from subtlake.functions.ids import bucket_of

BUCKET = 100_000


def _by_bucket(ids: DataFrame, num: str, bucket: int) -> DataFrame:
    return (
        ids.select(F.col(num).cast("long").alias("num")).distinct().withColumn("b", bucket_of(F.col("num"), bucket))
    )


def gap_ranges(ids: DataFrame, num: str = "num", bucket: int = BUCKET) -> DataFrame:
    """(gap_from, gap_to) between consecutive present ids.

    Gaps inside a bucket come from ``lead``; gaps between buckets from the table of bucket edges, which
    has one row per occupied bucket.
    """
    rows = _by_bucket(ids, num, bucket)
    inner = rows.withColumn("nxt", F.lead("num").over(W.partitionBy("b").orderBy("num")))
    edges = rows.groupBy("b").agg(F.min("num").alias("lo"), F.max("num").alias("hi"))
    outer = edges.select(F.col("hi").alias("num"), F.lead("lo").over(W.orderBy("b")).alias("nxt"))
    return (
        inner.select("num", "nxt").unionByName(outer).where(F.col("nxt") > F.col("num") + 1)
        .select((F.col("num") + 1).alias("gap_from"), (F.col("nxt") - 1).alias("gap_to"))
    )


def expand_ranges(ranges: DataFrame, lo: str, hi: str, out: str = "num", step: int = 10_000) -> DataFrame:
    """One row per id of each range; long ranges are cut first so that no array exceeds ``step``."""
    cut = F.explode(F.sequence(F.col(lo), F.col(hi), F.lit(step).cast("long")))
    return (
        ranges.withColumn("_from", cut).withColumn("_to", F.least(F.col(hi), F.col("_from") + step - 1))
        .repartition(F.col("_from"))
        .withColumn(out, F.explode(F.sequence("_from", "_to"))).drop("_from", "_to")
    )


def id_gaps(ids: DataFrame, num: str = "num", bucket: int = BUCKET) -> DataFrame:
    """Every missing id between the lowest and the highest present id."""
    return expand_ranges(gap_ranges(ids, num, bucket), "gap_from", "gap_to").select("num")


def islands(ids: DataFrame, num: str = "num", bucket: int = BUCKET) -> DataFrame:
    """(lo, hi) of each maximal run of consecutive ids.

    Runs are found per bucket; only runs that touch a bucket border can join a neighbour, at most two per
    bucket, and only those pass the ordered merge.
    """
    rows = _by_bucket(ids, num, bucket)
    run = F.col("num") - F.row_number().over(W.partitionBy("b").orderBy("num"))
    runs = rows.withColumn("run", run).groupBy("b", "run").agg(F.min("num").alias("lo"), F.max("num").alias("hi"))
    touches = (F.col("lo") == F.col("b") * bucket) | (F.col("hi") == F.col("b") * bucket + (bucket - 1))
    inner = runs.where(~touches).select("lo", "hi")
    by_lo = W.orderBy("lo")
    border = (
        runs.where(touches).select("lo", "hi")
        .withColumn("first", F.when(F.lag("hi").over(by_lo) == F.col("lo") - 1, 0).otherwise(1))
        .withColumn("chain", F.sum("first").over(by_lo.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy("chain").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select("lo", "hi")
    )
    return inner.unionByName(border)


def compress_runs(runs: DataFrame) -> DataFrame:
    """Range-list form: runs of one or two ids are single numbers, longer ones ``[lo,hi]``."""
    lo, hi = F.col("lo"), F.col("hi")
    pair = lambda a, b: F.struct(a.alias("lo"), b.alias("hi"))
    short = F.transform(F.sequence(lo, F.least(hi, lo + 1)), lambda n: pair(n, n))
    return (
        runs.select(F.inline(F.when(hi - lo >= 2, F.array(pair(lo, hi))).otherwise(short)))
        .withColumn(
            "entry",
            F.when(F.col("lo") == F.col("hi"), F.col("lo").cast("string"))
            .otherwise(F.format_string("[%d,%d]", "lo", "hi")),
        )
    )


def is_num_done(ids: DataFrame, runs: DataFrame, num: str = "num", cell: int = 256) -> DataFrame:
    """Adds ``done``: the id lies in one of the disjoint ranges.

    Equi-join on small cells of the id axis: a cell meets at most ``cell / 2`` disjoint ranges, usually one, so an
    id is compared with few of them. A long range becomes one row per cell.
    """
    cells = runs.select(
        F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), bucket_of(F.col("lo"), cell).alias("_first"),
        bucket_of(F.col("hi"), cell).alias("_last"),
    )
    pieces = expand_ranges(cells, "_first", "_last", "_cell").select("_cell", "_lo", "_hi")
    rows = ids.withColumn("_c", bucket_of(F.col(num), cell))
    covers = (F.col("_c") == F.col("_cell")) & F.col(num).between(F.col("_lo"), F.col("_hi"))
    joined = rows.join(pieces, covers, "left").withColumn("done", F.col("_lo").isNotNull())
    return joined.drop("_c", "_cell", "_lo", "_hi")


def first_missing(runs: DataFrame, after: int) -> DataFrame:
    """Smallest id above ``after`` that is in no run: one row ``first_missing``."""
    covering = F.when((F.col("lo") <= after + 1) & (F.col("hi") >= after + 1), F.col("hi") + 1)
    return runs.agg(F.coalesce(F.max(covering), F.lit(after + 1).cast("long")).alias("first_missing"))


def steady_run(ids: DataFrame, num: str = "num", lowest: int = 0, bucket: int = BUCKET) -> DataFrame:
    """(num, last_steady, after_break) of the ids from ``lowest`` on.

    ``last_steady`` ends the first run without a break; ids behind it carry ``after_break``.
    """
    kept = ids.where(F.col(num) >= lowest)
    last = islands(kept, num, bucket).agg(F.min_by("hi", "lo")).first()[0]
    return (
        kept.select(F.col(num).cast("long").alias("num")).distinct()
        .withColumn("last_steady", F.lit(last).cast("long"))
        .withColumn("after_break", F.col("num") > F.col("last_steady"))
    )


def time_outliers(df: DataFrame, num: str, ts: str, bucket: int = BUCKET) -> DataFrame:
    """Rows whose time is lower than that of some lower id, with the highest earlier time.

    A bucket receives the running maximum of the buckets before it from a table of one row per bucket.
    """
    rows = df.withColumn("_b", bucket_of(F.col(num), bucket))
    up_to = W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    carry = (
        rows.groupBy("_b").agg(F.max(ts).alias("_max")).select("_b", F.max("_max").over(up_to).alias("_carry"))
    )
    inside = F.max(ts).over(W.partitionBy("_b").orderBy(num).rowsBetween(W.unboundedPreceding, -1))
    return (
        rows.withColumn("_seen", inside).join(carry, "_b")
        .withColumn("earlier_max", F.greatest("_seen", "_carry"))
        .where(F.col(ts) < F.col("earlier_max")).drop("_b", "_seen", "_carry")
    )


def bucket_bounds(df: DataFrame, num: str, ts: Column, bucket: int = BUCKET) -> DataFrame:
    """First and last id of each id bucket, with their times."""
    return (
        df.withColumn("bucket", bucket_of(F.col(num), bucket)).groupBy("bucket")
        .agg(
            F.min(num).alias("first_num"), F.min_by(ts, F.col(num)).alias("first_time"),
            F.max(num).alias("last_num"), F.max_by(ts, F.col(num)).alias("last_time"),
        )
    )

"""Positions inside groups, safe when one group holds most rows.

Two ways. Ids (unique, dense) are counted per id bucket and numbered inside it. Any other order is cut at split points of
(group, order): a small list taken from a sample that depends on the rows' values alone. A row's bucket follows from its own
values and that list, never from a partition number, so nothing has to be fixed by a checkpoint and a task that runs again
finds the same buckets.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from subtlake.functions.ids import bucket_of
from subtlake.session import shuffle_partitions

#: Sampled rows for each bucket: the more, the more even the buckets.
SAMPLED = 16


@dataclass(frozen=True)
class Descending:
    """A column to order by from the greatest value down, nulls last."""

    column: Column


def _digits_down(text: Column) -> Column:
    """Hex digits whose ascending order is the descending order of the bytes; a text behind its own continuations."""
    return F.concat(F.translate(F.hex(text), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))


def sort_key(df: DataFrame, order: list[Column | Descending]) -> Column:
    """One struct that ascends in the given order. Nulls come first in an ascending column and last in a descending one."""
    fields = []
    for i, wish in enumerate(order):
        down = isinstance(wish, Descending)
        value = wish.column if down else wish
        kind = df.select(value.alias("x")).schema["x"].dataType
        fields.append((value.isNull() if down else value.isNotNull()).alias(f"s{i}"))
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            # NaN is the greatest number in Spark's order, and stays it when negated
            fields.append((~F.isnan(value) if down else F.isnan(value)).alias(f"n{i}"))
            value = F.when(F.isnan(value), 0.0).otherwise(-value if down else value)
        elif down and isinstance(kind, (T.StringType, T.BinaryType)):
            value = _digits_down(value)
        elif down and isinstance(kind, T.BooleanType):
            value = ~value
        elif down and isinstance(kind, T.DateType):
            value = -F.unix_date(value)
        elif down and isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            value = -F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast(kind), value)
        elif down and isinstance(kind, T.IntegralType):
            value = F.bitwise_not(value)
        elif down and isinstance(kind, T.DecimalType):
            value = -value
        elif down:
            raise ValueError(f"no descending order of {kind.simpleString()}")
        fields.append(value.alias(f"v{i}"))
    return F.struct(*fields)


def split_points(rows: DataFrame, place: str, buckets: int) -> Column:
    """At most ``buckets - 1`` split points of the column ``place``, as one array.

    The sample holds the values whose hash falls into a share that leaves about ``SAMPLED * buckets`` rows: the same for the same
    rows in any order, and of that size however many there are.
    """
    every = rows.agg(F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) / F.lit(SAMPLED * buckets))).alias("n")).scalar()
    sample = rows.select(place).where(F.pmod(F.xxhash64(place), every) == 0)
    points = sample.agg(F.array_sort(F.collect_set(place)).alias("p"))
    n = F.size("p")
    at = F.transform(F.sequence(F.lit(1), F.lit(max(buckets - 1, 1))), lambda i: F.get("p", F.floor(i * n / F.lit(buckets)).cast("int")))
    return points.select(F.array_distinct(F.filter(at, lambda x: x.isNotNull())).alias("p")).scalar()


def with_bucket(rows: DataFrame, place: str, points: Column, buckets: int, out: str) -> DataFrame:
    """``out``: how many of the ascending ``points`` are at or below ``place``, by halving.

    A step is a projection of its own: generated code keeps the steps apart, while a lambda over them would be interpreted.
    """
    rows = rows.withColumn("_points", points).withColumn(out, F.lit(0))
    for i in reversed(range(max(buckets, 2).bit_length())):
        higher = F.get("_points", F.col(out) + F.lit((1 << i) - 1)) <= F.col(place)
        rows = rows.withColumn(out, F.when(higher, F.col(out) + F.lit(1 << i)).otherwise(F.col(out)))
    return rows.drop("_points")


def number_by_id(df: DataFrame, keys: list[str], num: str, out: str = "rn", bucket: int = 100_000) -> DataFrame:
    """1-based position of each row in its group by ascending id. One shuffle of the rows, by group and bucket."""
    group = F.struct(*keys) if keys else F.lit(0)
    rows = df.withColumn("_g", group).withColumn("_b", bucket_of(F.col(num), bucket))
    before = W.partitionBy("_g").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_g", "_b").agg(F.count(F.lit(1)).alias("_n"))
        .select("_g", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = F.row_number().over(W.partitionBy("_g", "_b").orderBy(num))
    return (
        rows.withColumn("_inside", inside).join(offsets, ["_g", "_b"])
        .withColumn(out, F.col("_offset") + F.col("_inside"))
        .drop("_g", "_b", "_inside", "_offset")
    )


def number_rows(df: DataFrame, keys: list[str], order: list[Column | Descending], out: str = "rn", bounded: bool = False,
                buckets: int | None = None) -> DataFrame:
    """1-based position of each row in its group by any total order.

    ``df`` is read three times: its groups and order columns for the split points and for the counts of rows per bucket, then
    whole. The counts of earlier buckets of the same group give a bucket's offset. ``bounded`` says that groups are small by
    nature (each came from one row), so one window per group will do.
    """
    if bounded:
        plain = [w.column.desc_nulls_last() if isinstance(w, Descending) else w.asc_nulls_first() for w in order]
        return df.withColumn(out, F.row_number().over(W.partitionBy(*keys).orderBy(*plain)).cast("long"))
    buckets = buckets or 2 * shuffle_partitions(df)
    group = F.struct(*keys) if keys else F.struct(F.lit(0))
    rows = df.withColumn("_p", F.struct(group.alias("g"), sort_key(df, order).alias("k")))
    points = split_points(rows, "_p", buckets)
    rows = with_bucket(rows, "_p", points, buckets, "_b").withColumn("_g", F.col("_p.g"))
    before = W.partitionBy("_g").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    # only groups that go on from an earlier bucket have an offset: at most one per bucket
    offsets = (
        rows.groupBy("_g", "_b").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.sum("_n").over(before)).where("_offset > 0").drop("_n")
    )
    inside = F.row_number().over(W.partitionBy("_g", "_b").orderBy("_p.k"))
    numbered = rows.withColumn("_inside", inside).join(F.broadcast(offsets), same_place(rows, offsets), "left")
    return numbered.withColumn(out, F.coalesce(offsets["_offset"], F.lit(0)) + F.col("_inside")).select(*df.columns, out)


def same_place(rows: DataFrame, offsets: DataFrame) -> Column:
    return rows["_g"].eqNullSafe(offsets["_g"]) & (rows["_b"] == offsets["_b"])


def rolling(
    df: DataFrame,
    keys: list[str],
    order: list[Column | Descending],
    columns: Callable[[Callable[[int], WindowSpec]], dict[str, Column]],
    longest: int,
    block: int = 100_000,
) -> DataFrame:
    """Columns over frames of the last n rows (n <= ``longest``) of each group.

    ``columns`` receives ``last(n) -> WindowSpec``. Groups are cut into blocks of ``block`` rows; each block also
    receives the ``longest - 1`` rows before it, so frames stay whole.
    """
    if longest > block:
        raise ValueError("longest frame exceeds the block size")
    numbered = number_rows(df, keys, order, "_rn")
    own = F.floor((F.col("_rn") - 1) / F.lit(block)).cast("long")
    late = (F.col("_rn") - 1) % block >= block - (longest - 1)
    blocks = (
        numbered.withColumn("_own", own)
        .withColumn("_block", F.explode(F.when(late, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))))
    )
    spec = W.partitionBy(*keys, "_block").orderBy("_rn")
    return (
        blocks.withColumns(columns(lambda n: spec.rowsBetween(-(n - 1), 0)))
        .where(F.col("_own") == F.col("_block")).drop("_own", "_block", "_rn")
    )


def id_lists(
    df: DataFrame, keys: list[str], num: str, entry: Column | None = None, bucket: int = 100_000
) -> DataFrame:
    """Group members as lists of bounded length: one row per group and id bucket.

    Columns: keys, ``part`` (id bucket), ``members`` (by ascending id), ``group_len`` (whole group). An id that a group
    repeats with the same entry is listed and counted once, so no list exceeds ``bucket`` ids with their entries. Null ids are left out.
    """
    entry = F.col(num) if entry is None else entry
    rows = df.withColumn("_g", F.struct(*keys)).withColumn("part", bucket_of(F.col(num), bucket)).where("part is not null")
    lists = (
        rows.groupBy("_g", "part")
        .agg(F.sort_array(F.collect_set(F.struct(F.col(num).alias("k"), entry.alias("v")))).alias("_m"))
        .withColumn("members", F.transform("_m", lambda m: m["v"])).drop("_m")
    )
    # totals come from the small table of sizes, so no list is moved again
    counts = lists.select("_g", "part", F.size("members").cast("long").alias("_n"))
    totals = counts.select("_g", "part", F.sum("_n").over(W.partitionBy("_g")).alias("group_len"))
    return lists.join(totals, ["_g", "part"]).select("_g.*", "part", "members", "group_len")

"""Positions, rolling frames and joins when one group is hot: the split form equals the plain one."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from subtlake.operators.numbering import Descending, id_lists, number_by_id, number_rows, rolling, split_points, with_bucket
from subtlake.operators.skew import salted_join
from subtlake.operators.stats import fetch_windows


def hot_rows(spark, n=3000):
    """A third of all rows under one key, one group without a key."""
    rng = random.Random(5)
    keys = ["hot" if rng.random() < 0.4 else rng.choice(["a", "b", None, "c"]) for _ in range(n)]
    order = list(range(n))
    rng.shuffle(order)
    rows = [(keys[i], order[i], order[i] // 7, rng.randint(0, 500)) for i in range(n)]
    return spark.createDataFrame(rows, "k string, id long, t long, v long").repartition(7)


def test_number_by_id(spark):
    df = hot_rows(spark)
    want = {r.id: r.n for r in df.withColumn("n", F.row_number().over(W.partitionBy("k").orderBy("id"))).collect()}
    for bucket in (10, 1000, 100_000):
        got = {r.id: r.n for r in number_by_id(df, ["k"], "id", "n", bucket).collect()}
        assert got == want


def test_number_rows_split_groups(spark):
    df = hot_rows(spark)
    order = [Descending(F.col("t")), F.col("id")]
    window = W.partitionBy("k").orderBy(F.desc("t"), "id")
    plain = {r.id: r.n for r in df.withColumn("n", F.row_number().over(window)).collect()}
    split = {r.id: r.n for r in number_rows(df, ["k"], order, "n").collect()}
    assert len(plain) == 3000 and split == plain
    assert plain == {r.id: r.n for r in number_rows(df, ["k"], order, "n", bounded=True).collect()}
    whole = {r.id: r.n for r in number_rows(df, [], [F.col("id")], "n").collect()}
    assert all(n == i + 1 for i, n in whole.items())


def test_number_rows_by_every_type_and_direction(spark):
    rows = [(i, i % 3 if i % 7 else None, float("nan") if i % 11 == 0 else (i % 13) - 6.0, "ab"[: i % 3] + chr(97 + i % 5), i % 2 == 0) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, n int, x double, s string, b boolean").repartition(5)
    df = df.withColumn("d", F.date_add(F.lit("1969-12-20"), F.col("id").cast("int") % 30)).withColumn("t", F.col("d").cast("timestamp"))
    for name in ("n", "x", "s", "b", "d", "t"):
        for down in (True,) if name != "x" else (True, False):
            plain = F.col(name).desc_nulls_last() if down else F.col(name).asc_nulls_first()
            want = {r.id: r.rn for r in df.withColumn("rn", F.row_number().over(W.orderBy(plain, F.desc("id")))).collect()}
            order = [Descending(F.col(name)) if down else F.col(name), Descending(F.col("id"))]
            assert {r.id: r.rn for r in number_rows(df, [], order, "rn").collect()} == want, (name, down)


def test_number_rows_plan(spark):
    """No checkpoint, no partition numbers; one group of all rows is dealt over many buckets."""
    df = hot_rows(spark)
    numbered = number_rows(df, [], [F.col("id")], "n", buckets=16)
    plan = numbered._jdf.queryExecution().toString()
    assert "spark_partition_id" not in plan.lower() and "checkpoint" not in plan.lower()
    rows = df.withColumn("p", F.struct(F.lit(0).alias("g"), "id"))
    points = split_points(rows, "p", 16)
    sizes = [r["count"] for r in with_bucket(rows, "p", points, 16, "b").groupBy("b").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * 3000 / 16


def test_rolling_blocks(spark):
    df = hot_rows(spark).withColumn("w", F.coalesce("k", F.lit("none")))

    def columns(last):
        return {"s": F.sum("v").over(last(9)), "m": F.max("v").over(last(30)), "n": F.count(F.lit(1)).over(last(30))}

    order = [F.col("t"), F.col("id")]
    spec = W.partitionBy("w").orderBy(*order)
    plain = {r.id: (r.s, r.m, r.n) for r in df.withColumns(columns(lambda n: spec.rowsBetween(1 - n, 0))).collect()}
    for block in (40, 100_000):
        split = {r.id: (r.s, r.m, r.n) for r in rolling(df, ["w"], order, columns, 30, block=block).collect()}
        assert len(plain) == 3000 and split == plain
    with pytest.raises(ValueError):
        rolling(df, ["w"], order, columns, 30, block=29)


def test_fetch_windows_brute_force(spark):
    rows = [(1, "w", f"2024-01-01 00:00:{i:02d}", i * i, i % 3 == 0) for i in range(40)]
    df = spark.createDataFrame(rows, "x int, w string, ts string, d long, bad boolean").select(
        "w", F.col("ts").cast("timestamp_ntz").alias("ts"), "d", "bad", F.col("d").alias("id")
    )
    out = fetch_windows(df, ["w"], "ts", "id", F.col("d"), F.col("bad"), short=5, long=10).orderBy("ts").collect()
    for i, r in enumerate(out):
        last = list(range(max(0, i - 4), i + 1))
        assert r.avg_duration == sum(j * j for j in last) / len(last)
        assert r.avg_between_us == (1_000_000 if i else None)
        tail = list(range(max(0, i - 9), i + 1))
        assert abs(r.error_rate - sum(j % 3 == 0 for j in tail) / len(tail)) < 1e-12


def test_id_lists_are_whole_and_bounded(spark):
    df = hot_rows(spark)
    lists = id_lists(df, ["k"], "id", bucket=100).collect()
    assert max(len(r.members) for r in lists) <= 100
    want = {}
    for r in df.collect():
        want.setdefault(r.k, []).append(r.id)
    for key, ids in want.items():
        parts = sorted((r for r in lists if r.k == key), key=lambda r: r.part)
        assert [i for r in parts for i in r.members] == sorted(ids)
        assert {r.group_len for r in parts} == {len(ids)}


def test_salted_join(spark):
    df = hot_rows(spark)
    groups = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    table = groups.where("k <> 'a'").unionByName(groups.where("k = 'hot'"))
    for how in ("inner", "left", "left_semi"):
        want = sorted(map(str, df.join(table, "k", how).collect()))
        got = salted_join(df, table, "k", how, hot_rows=100).select(df.join(table, "k", how).columns)
        assert sorted(map(str, got.collect())) == want
    given = salted_join(df, table, "k", hot_rows=100, counts=groups)
    assert given.count() == df.join(table, "k").count()

"""Orders, top rows and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from subtlake.operators import ranking, recon
from subtlake.plans.registry import query, table


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderkey DESC LIMIT 1")
def last_row(spark, sf):
    return ranking.last_row(table(spark, sf, "orders"), "o_orderkey", ["o_orderdate"])


@query("SELECT o_orderkey FROM orders ORDER BY md5(o_orderkey || ':7'), o_orderkey LIMIT 1000")
def sample_rows(spark, sf):
    return ranking.sample_rows(table(spark, sf, "orders"), "o_orderkey", 1000, seed=7)


@query("""
WITH n AS (SELECT *, CASE WHEN p_type = 'ECONOMY' THEN lpad(CAST(p_size AS VARCHAR), 4, '0') ELSE CAST(p_size AS VARCHAR) END AS pad,
                  CASE WHEN p_partkey % 50 = 0 THEN 3 ELSE 4 END AS dots, CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS ending FROM part)
SELECT p_partkey, row_number() OVER (ORDER BY dots, p_size, replace(p_name, ' ', '-'), ending, pad, p_partkey) AS place FROM n""")
def version_sort(spark, sf):
    """Names ``v<size>-<title>`` with differently padded numbers, some hidden, some with an ending, in version order."""
    pad = F.when(F.col("p_type") == "ECONOMY", F.lpad(F.col("p_size").cast("string"), 4, "0")).otherwise(F.col("p_size").cast("string"))
    hidden = F.when(F.col("p_partkey") % 50 == 0, F.lit(".")).otherwise(F.lit(""))
    ending = F.when(F.col("p_partkey") % 5 == 0, F.lit(".srt")).otherwise(F.lit(""))
    name = F.concat(hidden, F.lit("v"), pad, F.lit("-"), F.replace("p_name", F.lit(" "), F.lit("-")), ending)
    named = table(spark, sf, "part").select("p_partkey", name.alias("name"))
    return ranking.place_by_version(named, "name", ["p_partkey"]).select("p_partkey", "place")


@query("SELECT DISTINCT o_orderkey // 1000 AS shard FROM orders ORDER BY shard DESC")
def shards_desc(spark, sf):
    shards = table(spark, sf, "orders").select(F.floor(F.col("o_orderkey") / 1000).cast("string").alias("shard")).distinct()
    return ranking.shards_descending(shards).select(F.col("shard").cast("long").alias("shard"))


@query("""
SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey DESC) AS rank FROM orders""")
def rank_newest_first(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return ranking.rank_newest_first(orders, ["o_orderpriority"], "o_orderkey").select("o_orderkey", "rank")


@query("""
SELECT p_partkey, row_number() OVER (PARTITION BY p_name ORDER BY p_size DESC, p_retailprice DESC, p_brand DESC,
       p_partkey DESC) AS rank FROM part""")
def rank_by_popularity(spark, sf):
    return ranking.rank_by_popularity(
        table(spark, sf, "part"), ["p_name"], "p_partkey", "p_size", "p_retailprice", "p_brand"
    ).select("p_partkey", "rank")


@query("""
SELECT DISTINCT o_orderkey AS num FROM orders WHERE o_orderkey BETWEEN 10 AND 90000000
AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) ORDER BY num""")
def order_work(spark, sf):
    wanted = table(spark, sf, "orders").select(F.col("o_orderkey").alias("num"))
    done = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("num"))
    return recon.work_queue(wanted, done, 10, 90_000_000, seed=7)

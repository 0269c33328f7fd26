"""Gaps, islands, chunks and packs. Click events are present ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from subtlake.operators import grouping, sequences
from subtlake.plans.registry import query, table

_BUCKET = 1000
_IDS = "WITH ids AS (SELECT DISTINCT event_id AS num FROM events WHERE event_type = 'click')"
_ISLANDS = _IDS + """, islands AS (
  SELECT min(num) AS lo, max(num) AS hi FROM (SELECT num, num - row_number() OVER (ORDER BY num) AS g FROM ids)
  GROUP BY g)"""


def clicks(spark, sf):
    return table(spark, sf, "events").where(F.col("event_type") == "click").select(F.col("event_id").alias("num"))


@query(_IDS + """
SELECT num FROM (SELECT unnest(generate_series((SELECT min(num) FROM ids), (SELECT max(num) FROM ids))) AS num)
WHERE num NOT IN (SELECT num FROM ids)""")
def id_gaps(spark, sf):
    return sequences.id_gaps(clicks(spark, sf), bucket=_BUCKET)


@query(_ISLANDS + """
SELECT lo, hi, CASE WHEN lo = hi THEN CAST(lo AS VARCHAR) ELSE '[' || lo || ',' || hi || ']' END AS entry FROM (
  SELECT lo, hi FROM islands WHERE hi - lo <> 1
  UNION ALL SELECT lo, lo FROM islands WHERE hi - lo = 1
  UNION ALL SELECT hi, hi FROM islands WHERE hi - lo = 1)""")
def id_islands(spark, sf):
    return sequences.compress_runs(sequences.islands(clicks(spark, sf), bucket=_BUCKET))


@query(_ISLANDS + """
SELECT coalesce((SELECT max(hi + 1) FROM islands WHERE lo <= 501 AND hi >= 501), 501) AS first_missing""")
def first_missing(spark, sf):
    return sequences.first_missing(sequences.islands(clicks(spark, sf), bucket=_BUCKET), 500)


@query("""
WITH ids AS (SELECT DISTINCT l_orderkey AS num FROM lineitem WHERE l_orderkey >= 100),
first AS (SELECT min(hi) AS last_steady FROM (
  SELECT max(num) AS hi FROM (SELECT num, num - row_number() OVER (ORDER BY num) AS g FROM ids) GROUP BY g))
SELECT num, last_steady, num > last_steady AS after_break FROM ids, first""")
def steady_run(spark, sf):
    present = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("num"))
    return sequences.steady_run(present, "num", 100, _BUCKET)


@query("""
SELECT o_orderkey AS num, o_orderdate, earlier_max FROM (
  SELECT o_orderkey, o_orderdate, max(o_orderdate) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING
         AND 1 PRECEDING) AS earlier_max FROM orders) WHERE o_orderdate < earlier_max""")
def time_outliers(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("num"), "o_orderdate")
    return sequences.time_outliers(orders, "num", "o_orderdate", _BUCKET)


@query("""
SELECT event_id AS num, event_id IN (SELECT event_id FROM events WHERE event_type = 'click') AS done FROM events""")
def num_done(spark, sf):
    ids = table(spark, sf, "events").select(F.col("event_id").alias("num"))
    runs = sequences.islands(clicks(spark, sf), bucket=_BUCKET)
    return sequences.is_num_done(ids, runs, "num")


@query("""
WITH n AS (SELECT lang, doc_id, (row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) // 25 AS chunk FROM documents)
SELECT lang, chunk, min(doc_id) AS first_num, max(doc_id) AS last_num, count(*) AS ids,
       min(doc_id) || '-' || max(doc_id) AS chunk_name FROM n GROUP BY lang, chunk""")
def chunk_by_count(spark, sf):
    return grouping.chunk_by_count(table(spark, sf, "documents"), "lang", "doc_id", 25, 100)


def _fill_sql(key: str) -> str:
    """Packs one file after the other; ``key`` cuts the ids into series of their own."""
    return f"""
WITH RECURSIVE files AS (
  SELECT {key} AS key, doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS size, row_number() OVER (PARTITION BY {key} ORDER BY doc_id) AS rn
  FROM documents WHERE octet_length(encode(text)) > 0),
fill AS (
  SELECT key, doc_id, size, rn, size AS used, CAST(0 AS BIGINT) AS pack FROM files WHERE rn = 1
  UNION ALL
  SELECT f.key, f.doc_id, f.size, f.rn, CASE WHEN p.used + f.size < 49000.0 THEN p.used + f.size ELSE f.size END,
         CASE WHEN p.used + f.size < 49000.0 THEN p.pack ELSE p.pack + 1 END
  FROM fill p JOIN files f ON f.key = p.key AND f.rn = p.rn + 1)
SELECT key AS lang, doc_id, size, pack FROM fill"""


def _sizes(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", F.octet_length("text").alias("size"))


@query(_fill_sql("'all'"))
def pack_by_size(spark, sf):
    """One series through all ids; small buckets, so that packs cross them and their tree has levels."""
    packed = grouping.pack_by_size(_sizes(spark, sf), [], "doc_id", "size", 50_000, bucket=50, fan=4)
    return packed.withColumn("lang", F.lit("all"))


@query(_fill_sql("lang"))
def pack_by_language(spark, sf):
    """A series of packs for each language, through all of its ids."""
    return grouping.pack_by_size(_sizes(spark, sf), ["lang"], "doc_id", "size", 50_000, bucket=100, fan=4)

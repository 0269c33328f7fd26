"""Expected, present, missing. Orders are expected ids; orders with line items are present; status P of priority
4 and 5 stands for not found, status P of priority 1 for taken down. Shards hold 10 ids, releases 5 shards."""

from __future__ import annotations

from pyspark.sql import functions as F

from subtlake.operators import recon
from subtlake.plans.inputs import write_marks
from subtlake.plans.registry import query, table
from subtlake.session import scratch_path
from subtlake.sources import inbox

_SHARD, _RELEASE = 10, 5

_FLAGS = """
WITH expected AS (SELECT o_orderkey AS num FROM orders),
actual AS (SELECT DISTINCT l_orderkey AS num FROM lineitem),
not_found AS (SELECT o_orderkey AS num FROM orders WHERE o_orderstatus = 'P'
              AND o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')),
takedown AS (SELECT o_orderkey AS num FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'),
flags AS (
  SELECT e.num, a.num IS NOT NULL AS actual, n.num IS NOT NULL AS not_found, t.num IS NOT NULL AS takedown,
         a.num IS NULL AND n.num IS NULL AND t.num IS NULL AS missing
  FROM expected e LEFT JOIN actual a USING (num) LEFT JOIN not_found n USING (num) LEFT JOIN takedown t USING (num)
),
shards AS (
  SELECT num // 10 AS shard, count(*) AS expected, count(*) FILTER (actual) AS have,
         count(*) FILTER (not_found) AS not_found, count(*) FILTER (takedown) AS takedown,
         count(*) FILTER (missing) AS missing, count(*) FILTER (missing) = 0 AS complete
  FROM flags GROUP BY 1
),
releases AS (
  SELECT shard // 5 AS release_id, count(*) FILTER (complete) AS shards, count(*) FILTER (complete) = 5 AS complete
  FROM shards GROUP BY 1
)
"""


def expected_ids(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("num"))


def actual_ids(spark, sf):
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("num"))


def not_found_ids(spark, sf):
    lost = (F.col("o_orderstatus") == "P") & F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW")
    return table(spark, sf, "orders").where(lost).select(F.col("o_orderkey").alias("num"))


def takedown_ids(spark, sf):
    gone = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    return table(spark, sf, "orders").where(gone).select(F.col("o_orderkey").alias("num"))


def flags(spark, sf):
    return recon.reconcile(
        expected_ids(spark, sf), actual_ids(spark, sf), not_found_ids(spark, sf), takedown_ids(spark, sf)
    )


@query(_FLAGS + "SELECT * FROM shards")
def shard_status(spark, sf):
    return recon.shard_status(flags(spark, sf), _SHARD)


@query(_FLAGS + "SELECT * FROM releases")
def release_status(spark, sf):
    return recon.release_status(recon.shard_status(flags(spark, sf), _SHARD), _RELEASE)


@query(_FLAGS + "SELECT num FROM flags WHERE missing")
def missing_ids(spark, sf):
    return flags(spark, sf).where("missing").select("num")


@query(_FLAGS + "SELECT num // 10 AS shard, count(*) AS missing FROM flags WHERE missing GROUP BY 1")
def missing_per_shard(spark, sf):
    return recon.missing_per_shard(flags(spark, sf), _SHARD)


@query(_FLAGS + """
SELECT num, num // 10 AS shard, count(*) OVER (PARTITION BY num // 10) AS shard_missing FROM flags WHERE missing
ORDER BY shard_missing, shard, num""")
def nearly_complete_first(spark, sf):
    return recon.nearly_complete_first(flags(spark, sf), _SHARD)


@query(_FLAGS + """
SELECT num // 500 AS release_id, num FROM flags
WHERE missing AND num // 500 = (SELECT min(num // 500) FROM flags WHERE missing) ORDER BY num LIMIT 200""")
def next_missing(spark, sf):
    return recon.next_missing(flags(spark, sf), 200, 500)


@query("SELECT o_orderkey AS num FROM orders INTERSECT SELECT l_orderkey FROM lineitem")
def packable(spark, sf):
    return recon.packable(expected_ids(spark, sf), actual_ids(spark, sf))


@query(_FLAGS + "SELECT num FROM expected EXCEPT SELECT num FROM actual")
def except_done(spark, sf):
    return recon.except_done(expected_ids(spark, sf), actual_ids(spark, sf))


@query(_FLAGS + "SELECT release_id FROM releases WHERE complete AND release_id NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 3 = 0)")
def already_released(spark, sf):
    shards = recon.shard_status(flags(spark, sf), _SHARD)
    released = table(spark, sf, "part").where(F.col("p_partkey") % 3 == 0).select(F.col("p_partkey").alias("release_id"))
    return recon.already_released(shards, released, _RELEASE)


@query("""
SELECT CASE WHEN l IS NOT NULL AND e IS NOT NULL THEN 'both' WHEN l IS NOT NULL THEN 'blob only'
            ELSE 'metadata only' END AS presence, count(*) AS ids
FROM (SELECT DISTINCT l_orderkey AS l FROM lineitem) FULL OUTER JOIN (SELECT o_orderkey AS e FROM orders) ON l = e
GROUP BY 1""")
def reconcile_counts(spark, sf):
    return recon.reconcile_counts(actual_ids(spark, sf), expected_ids(spark, sf))


@query("""
SELECT l_orderkey AS num, l_partkey, l_linenumber FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def release_semi(spark, sf):
    blobs = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("num"), "l_partkey", "l_linenumber")
    listed = table(spark, sf, "orders").where(F.col("o_orderstatus") != "P").select(F.col("o_orderkey").alias("num"))
    return recon.release_semi(blobs, listed)


@query("""
SELECT DISTINCT event_id AS num FROM events WHERE event_id BETWEEN 1000 AND 900000
AND event_id NOT IN (SELECT event_id FROM events WHERE event_type = 'click') ORDER BY 1""")
def work_queue(spark, sf):
    events = table(spark, sf, "events").select(F.col("event_id").alias("num"), "event_type")
    return recon.work_queue(events, events.where(F.col("event_type") == "click"), 1000, 900_000)


@query("""
SELECT num FROM (SELECT o_orderkey AS num FROM orders UNION SELECT l_orderkey FROM lineitem)""")
def union_metadata(spark, sf):
    return recon.union_ids(expected_ids(spark, sf), actual_ids(spark, sf))


@query("""
SELECT DISTINCT num FROM (
  SELECT unnest(generate_series(p_partkey * 10, p_partkey * 10 + 9)) AS num FROM part
  UNION ALL
  SELECT event_id FROM events WHERE event_type IN ('click', 'error', 'purchase')
)""")
def union_done(spark, sf):
    from subtlake.sources.inbox import classify_inbox, done_ids
    from subtlake.sources.tables import ids_of_shards, shard_of_file

    paths = table(spark, sf, "part").select(
        F.format_string("shards/x/%dxxx.db", F.col("p_partkey")).alias("path")
    )
    shards = ids_of_shards(paths.select(shard_of_file(F.col("path")).alias("shard")), "shard", 10)
    num = F.col("event_id").cast("string")
    # a modern archive, a legacy archive, a not-found mark, an error page and a broken archive
    name = (
        F.when(F.col("event_type") == "click", F.concat(num, F.lit(".a.title.(2001).eng.1cd.zip")))
        .when(F.col("event_type") == "error", F.concat(F.lit("a.title.(2001).eng.1cd.("), num, F.lit(").zip")))
        .when(F.col("event_type") == "purchase", F.concat(num, F.lit(".not-found")))
        .when(F.col("event_type") == "view", F.concat(num, F.lit(".html")))
        .otherwise(F.concat(num, F.lit(".zip.broken")))
    )
    listing = table(spark, sf, "events").select(F.concat(F.lit("inbox/"), name).alias("path"), F.lit(1).alias("size"))
    return recon.union_ids(shards, done_ids(classify_inbox(listing)))


@query("""
SELECT event_type, count(*) AS n, count(DISTINCT num) AS ids, min(state) AS state FROM (
  SELECT event_type, event_id AS num, CASE event_type WHEN 'click' THEN 'archive' WHEN 'error' THEN 'takedown'
    WHEN 'purchase' THEN 'not_found' WHEN 'view' THEN 'html' ELSE 'broken' END AS state FROM events
) GROUP BY event_type""")
def list_inbox(spark, sf):
    """A file per event in several folders, listed and classified."""
    num = F.col("event_id").cast("string")
    ending = (
        F.when(F.col("event_type") == "click", F.lit(".t.(1999).eng.1cd.zip"))
        .when(F.col("event_type") == "error", F.lit(".not-found-dmca")).when(F.col("event_type") == "purchase", F.lit(".zip"))
        .when(F.col("event_type") == "view", F.lit(".2.html")).otherwise(F.lit(".zip.broken"))
    )
    size = F.when(F.col("event_type") == "purchase", 0).otherwise(10)
    names = table(spark, sf, "events").select("event_type", F.concat(num, ending).alias("name"), size.alias("size"))
    folders = write_marks(names, scratch_path(spark, "marks"))
    states = inbox.list_inbox(spark, *folders).join(names.select("event_type", "name"), "name")
    return states.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("num").alias("ids"), F.min("state").alias("state")
    )


@query("""
SELECT e.event_id AS num FROM events e WHERE e.event_type = 'view'
AND e.user_id IN (SELECT user_id FROM events WHERE event_type = 'click')""")
def drop_html(spark, sf):
    state = F.when(F.col("event_type") == "view", "html").when(F.col("event_type") == "click", "archive")
    inbox = table(spark, sf, "events").select(F.col("user_id").alias("num"), "event_id", state.alias("state"))
    return recon.drop_html_if_archive(inbox).select(F.col("event_id").alias("num"))

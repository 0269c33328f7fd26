"""Groups of archives and duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from subtlake.operators import archive, grouping, ranking
from subtlake.plans.registry import files, query, table


@query("""
WITH m AS (SELECT DISTINCT l_partkey AS catalogue_id, l_orderkey AS num FROM lineitem
           WHERE l_partkey > 0 AND l_partkey <= 30050816)
SELECT catalogue_id, num // 5000 AS part, string_agg(CAST(num AS VARCHAR), ',' ORDER BY num) AS members,
       any_value(n) AS group_len, 'imdb-' || catalogue_id || '-len-' || any_value(n) AS group_name
FROM (SELECT *, count(*) OVER (PARTITION BY catalogue_id) AS n FROM m) GROUP BY catalogue_id, num // 5000""")
def group_by_catalogue_id(spark, sf):
    meta = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("catalogue_id"), F.col("l_orderkey").alias("num")
    ).distinct()
    groups = grouping.group_by_catalogue_id(meta, "catalogue_id", "num", 5000)
    return groups.withColumn("members", F.array_join(F.transform("members", lambda n: n.cast("string")), ","))


@query("""
SELECT p_name AS title, p_size AS year, p_brand AS lang, p_partkey // 1000 AS part,
       string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY p_partkey) AS members, any_value(n) AS group_len,
       replace(p_name, ' ', '.') || '.' || p_size || '.' || p_brand AS group_name
FROM (SELECT *, count(*) OVER (PARTITION BY p_name, p_size, p_brand) AS n FROM part WHERE p_type = 'ECONOMY')
GROUP BY p_name, p_size, p_brand, p_partkey // 1000""")
def group_by_title(spark, sf):
    movies = table(spark, sf, "part").where(F.col("p_type") == "ECONOMY").select(
        F.col("p_name").alias("title"), F.col("p_size").alias("year"), F.col("p_brand").alias("lang"),
        F.col("p_partkey").alias("num"),
    )
    groups = grouping.group_by_title(movies, "title", "year", "lang", "num", 1000)
    return groups.withColumn("members", F.array_join(F.transform("members", lambda n: n.cast("string")), ","))


@query("""
SELECT p_brand AS lang, p_name || ' (' || p_size || ')' AS name, p_partkey // 1000 AS part,
       '[' || string_agg('[' || p_partkey || ',' || CAST(p_retailprice AS BIGINT) || ']', ',' ORDER BY p_partkey) || ']'
         AS entries, any_value(n) AS group_len
FROM (SELECT *, count(*) OVER (PARTITION BY p_brand, p_name, p_size) AS n FROM part)
GROUP BY p_brand, p_name, p_size, p_partkey // 1000""")
def group_index(spark, sf):
    rows = table(spark, sf, "part").withColumn("lang", F.col("p_brand"))
    entry = F.array(F.col("p_partkey"), F.rint("p_retailprice").cast("long"))
    return grouping.group_index(rows, "lang", "p_name", "p_size", "p_partkey", entry, 1000)


@query("""
SELECT CAST(('0x' || substr(md5(p_name), 1, 4)) AS BIGINT) AS bucket, count(*) AS rows, count(DISTINCT p_name) AS titles
FROM part GROUP BY 1""")
def bucket_by_title_hash(spark, sf):
    return grouping.title_buckets(table(spark, sf, "part"), "p_name")


@query("""
SELECT doc_id, lang, CASE WHEN rn > 1 THEN source || '.' || rn || '.srt' ELSE source || '.srt' END AS new_path
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS rn FROM documents)""")
def number_duplicates(spark, sf):
    members = files(spark, sf).select("doc_id", "lang", F.concat("source", F.lit(".srt")).alias("path"))
    return archive.number_duplicates(members, "lang", "path", "doc_id", bounded=False).select("doc_id", "lang", "new_path")


@query("""
SELECT doc_id, lang FROM (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang, octet_length(encode(text)), sha1(text) ORDER BY doc_id) AS rn
  FROM documents) WHERE rn = 1""")
def drop_equal_content(spark, sf):
    members = files(spark, sf).select(
        "doc_id", F.col("lang").alias("num"), F.lit("a.srt").alias("path"), F.encode("text", "UTF-8").alias("content")
    )
    kept = archive.drop_equal_content(members, "num", "path", "doc_id", bounded=False)
    return kept.select("doc_id", F.col("num").alias("lang"))


@query("""
SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1""")
def dedupe_latest(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return ranking.dedupe_latest(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("""
WITH t AS (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS body FROM documents)
SELECT doc_id, first_num, copies, body_hash AS text_hash FROM (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY body) AS first_num, count(*) OVER (PARTITION BY body) AS copies,
         sha256(body) AS body_hash FROM t) WHERE copies > 1""")
def same_text(spark, sf):
    # every line becomes a cue; the offset of its times differs per file
    docs = files(spark, sf)
    stamp = F.format_string("00:%02d:01,000 --> 00:%02d:03,000\n", F.pmod("doc_id", F.lit(60)), F.pmod("doc_id", F.lit(60)))
    cues = F.array_join(
        F.transform(F.split("text", "\n", -1), lambda line: F.concat(F.lit("1\n"), stamp, line, F.lit("\n"))), "\n"
    )
    return archive.same_text(docs.select("doc_id", cues.alias("srt")), "doc_id", F.col("srt"))

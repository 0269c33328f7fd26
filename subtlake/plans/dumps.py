"""Files written from the tables and read back: dump, catalogue, exports, splits, shards, snapshots."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from subtlake.fixed_values import DETAIL_PAGE, DUMP_COLUMNS
from subtlake.functions.dates import date_text, epoch_seconds
from subtlake.functions.registry import select_columns
from subtlake.operators import languages, ranking, recon
from subtlake.plans.completeness import _FLAGS, _RELEASE, _SHARD, expected_ids, flags
from subtlake.plans.registry import files, query, table
from subtlake.session import scratch_path
from subtlake.sinks import tables as sinks
from subtlake.sources import dump
from subtlake.sources.tables import read_id_list, read_title_basics, read_title_episodes


def write_dump(spark, sf) -> str:
    """Orders as a metadata dump: status P has a line break in its release name, F a tab and an empty year, O an
    old line end. Damaged, by status and priority: P1 the kind, F2 the language, O1 an overlong number, O2 the address,
    O3 the id, O5 a field lost. Good rows and other damaged ones follow."""
    path = scratch_path(spark, "dump")
    orders = table(spark, sf, "orders")
    status, key = F.col("o_orderstatus"), F.col("o_orderkey").cast("string")
    damaged = lambda s, p: (status == s) & F.startswith("o_orderpriority", F.lit(p))
    release = (
        F.when(status == "P", F.concat(F.lit("Some.Release\nsecond line "), key))
        .when(status == "F", F.concat(F.lit("Some\tRelease "), key)).otherwise(F.concat(F.lit("Some.Release.x\rmore "), key))
    )
    kind = F.when(damaged("P", "1"), "radio").otherwise("movie")
    lang = F.when(damaged("F", "2"), "EN").otherwise("en")
    number = F.concat(F.when(damaged("O", "1"), "9" * 20).otherwise(""), F.lit("202222222222"), F.lpad("o_custkey", 5, "0"))
    page = F.when(damaged("O", "2"), "bad-address/").otherwise(DETAIL_PAGE)
    fields = [
        F.concat(F.when(damaged("O", "3"), "x").otherwise(""), key), F.concat(F.lit("It's "), "o_orderpriority"),
        F.when(status == "F", "").otherwise(F.year("o_orderdate").cast("string")), F.lit("English"), lang,
        date_text(F.col("o_orderdate")), number, F.when(~damaged("O", "5"), "srt"), F.lit("1"), release, F.lit("23.976"),
        F.lit(""), F.lit(""), F.lit(""), kind, F.concat(page, key, F.lit("/it-s")),
    ]
    # each part file starts with the header
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    header = F.lit("\t".join(DUMP_COLUMNS) + "\n")
    line = F.concat_ws("\t", *fields)
    rows = orders.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").select(line.alias("value"))
    rows.select(F.when(first, F.concat(header, "value")).otherwise(F.col("value")).alias("value")).write.text(path)
    return path


_REASON = """CASE o_orderstatus || substr(o_orderpriority, 1, 1) WHEN 'P1' THEN 'MovieKind' WHEN 'F2' THEN 'ISO639' WHEN 'O1' THEN 'ImdbID'
  WHEN 'O2' THEN 'URL' WHEN 'O3' THEN 'IDSubtitle' WHEN 'O5' THEN 'fields' END"""


@query(f"""
SELECT o_orderkey AS IDSubtitle, 'It''s ' || o_orderpriority AS MovieName,
  CASE WHEN o_orderstatus = 'F' THEN 0 ELSE year(o_orderdate) END AS MovieYear,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS SubAddDate,
  CAST('202222222222' || lpad(CAST(o_custkey AS VARCHAR), 5, '0') AS BIGINT) AS ImdbID,
  CASE o_orderstatus WHEN 'P' THEN 'Some.Release' || chr(10) || 'second line ' || o_orderkey
    WHEN 'F' THEN 'Some' || chr(9) || 'Release ' || o_orderkey ELSE 'Some.Release.x' || chr(10) || 'more ' || o_orderkey END
    AS MovieReleaseName, CAST(0 AS BIGINT) AS SeriesSeason, CAST(23.976 AS DOUBLE) AS MovieFPS
FROM orders WHERE {_REASON} IS NULL""")
def dump_parse(spark, sf):
    good, _ = dump.split_valid(dump.read_dump(spark, write_dump(spark, sf)))
    return good.select(
        "IDSubtitle", "MovieName", "MovieYear", "SubAddDate", "ImdbID", "MovieReleaseName", "SeriesSeason", "MovieFPS"
    )


@query(f"""
SELECT {_REASON} AS reason, count(*) AS n FROM orders WHERE {_REASON} IS NOT NULL GROUP BY 1""")
def quarantine(spark, sf):
    _, bad = dump.split_valid(dump.read_dump(spark, write_dump(spark, sf)))
    path = scratch_path(spark, "quarantine")
    sinks.write_quarantine(bad, path)
    return spark.read.parquet(path).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
SELECT o_orderkey AS IDSubtitle, 'It''s ' || o_orderpriority AS MovieName, 'Its ' || o_orderpriority AS _MovieNameClean,
  CASE WHEN o_orderstatus = 'F' THEN 0 ELSE year(o_orderdate) END AS MovieYear, 'en' AS ISO639 FROM orders WHERE {_REASON} IS NULL""")
def metadata_refresh(spark, sf):
    """Dump to stored table: read, check, project, keep the last row per id, publish a snapshot, read it."""
    path = write_dump(spark, sf)
    good, _ = dump.split_valid(dump.read_dump(spark, path))
    stored = select_columns(ranking.dedupe_latest(good, ["IDSubtitle"], ["file", "row_id"]))
    root = scratch_path(spark, "meta")
    if sinks.snapshot_is_due(spark, root, datetime(2024, 1, 1)):
        sinks.publish_snapshot(stored, root, datetime(2024, 1, 1))
    return sinks.read_snapshot(spark, root).select("IDSubtitle", "MovieName", "_MovieNameClean", "MovieYear", "ISO639")


@query("""
SELECT p_partkey AS id, 'movie' AS "titleType", p_name AS "primaryTitle", CASE WHEN p_type = 'PROMO' THEN '' ELSE p_name END AS "originalTitle",
  CASE WHEN p_size > 25 THEN CAST(1900 + p_size AS BIGINT) ELSE 0 END AS "startYear", CAST(0 AS BIGINT) AS "endYear", p_brand AS genres
FROM part""")
def title_basics(spark, sf):
    path = scratch_path(spark, "basics")
    rows = table(spark, sf, "part").select(
        F.concat(F.lit("tt"), F.lpad(F.col("p_partkey").cast("string"), 7, "0")).alias("tconst"), F.lit("movie").alias("titleType"),
        F.col("p_name").alias("primaryTitle"), F.when(F.col("p_type") != "PROMO", F.col("p_name")).alias("originalTitle"),
        F.lit("0").alias("isAdult"), F.when(F.col("p_size") > 25, F.col("p_size") + 1900).cast("string").alias("startYear"),
        F.lit(None).cast("string").alias("endYear"), F.lit("90").alias("runtimeMinutes"), F.col("p_brand").alias("genres"),
    )
    rows.write.csv(path, sep="\t", header=True, nullValue="\\N", quote="", escape="", compression="gzip")
    return read_title_basics(spark, path).select(
        "id", "titleType", "primaryTitle", "originalTitle", "startYear", "endYear", "genres"
    )


@query("""
SELECT o_orderkey AS id, o_custkey AS parent, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(substr(o_orderpriority, 1, 1) AS BIGINT) END
  AS season, CAST(day(o_orderdate) AS BIGINT) AS episode FROM orders""")
def title_episodes(spark, sf):
    path = scratch_path(spark, "episodes")
    code = lambda c: F.concat(F.lit("tt"), F.lpad(F.col(c).cast("string"), 9, "0"))
    rows = table(spark, sf, "orders").select(
        code("o_orderkey").alias("tconst"), code("o_custkey").alias("parentTconst"),
        F.when(F.col("o_orderstatus") != "P", F.substring("o_orderpriority", 1, 1)).alias("seasonNumber"),
        F.dayofmonth("o_orderdate").cast("string").alias("episodeNumber"),
    )
    rows.write.csv(path, sep="\t", header=True, nullValue="\\N", quote="", escape="")
    return read_title_episodes(spark, path)


@query("""
SELECT o_orderkey // 1000 AS bucket, '[' || o_orderkey || ',' || CAST(epoch(o_orderdate) AS BIGINT) || ']' AS value FROM orders""")
def export_id_time(spark, sf):
    path = scratch_path(spark, "id-time")
    meta = table(spark, sf, "orders").select("o_orderkey", epoch_seconds(F.col("o_orderdate")).alias("epoch"))
    sinks.export_id_time(meta, "o_orderkey", "epoch", path, 1000)
    return spark.read.text(path).select(F.col("bucket").cast("long").alias("bucket"), "value")


@query("""
SELECT d.doc_id AS num, CASE lang WHEN 'en' THEN 'eng' WHEN 'de' THEN 'ger' WHEN 'fr' THEN 'und' ELSE 'spa' END AS lang
FROM documents d""")
def split_by_lang(spark, sf):
    path = scratch_path(spark, "langs")
    docs = files(spark, sf).withColumnRenamed("doc_id", "num")
    meta = docs.select("num", F.when(F.col("lang") == "fr", "").otherwise(F.col("lang")).alias("ISO639"))
    sinks.split_by_lang(docs.select("num", "text"), meta, path)
    return spark.read.parquet(path).select("num", F.col("lang").cast("string").alias("lang"))


@query("""
SELECT CASE lang WHEN 'fr' THEN 'x1' ELSE 'zzz' END AS "ISO639", count(*) AS ids FROM documents WHERE lang IN ('fr', 'es') GROUP BY 1""")
def invalid_languages(spark, sf):
    """Languages of the documents, two of them misspelt."""
    code = F.when(F.col("lang") == "fr", "x1").when(F.col("lang") == "es", "zzz").otherwise(F.col("lang"))
    return languages.invalid_languages(table(spark, sf, "documents").select(code.alias("ISO639")), "ISO639")


@query("SELECT doc_id AS num, text FROM documents WHERE lang = 'de'")
def split_one_lang(spark, sf):
    path = scratch_path(spark, "langs")
    docs = files(spark, sf).withColumnRenamed("doc_id", "num")
    sinks.split_by_lang(docs.select("num", "text"), docs.select("num", F.col("lang").alias("ISO639")), path)
    return sinks.read_language(spark, path, "ger").select("num", "text")


@query(_FLAGS + "SELECT num, 'not_found' AS state FROM not_found UNION ALL SELECT num, 'takedown' FROM takedown")
def id_lists(spark, sf):
    path = scratch_path(spark, "ids")
    sinks.write_id_lists(flags(spark, sf), path)
    lists = spark.read.text(path)
    return lists.select(F.col("value").cast("long").alias("num"), F.col("state").cast("string").alias("state"))


@query("SELECT o_orderkey AS num FROM orders")
def read_id_lists(spark, sf):
    """Ids as plain lines and as added lines of a diff."""
    path = scratch_path(spark, "id-list")
    mark = F.when(F.col("o_orderstatus") == "P", "+").otherwise("")
    rows = table(spark, sf, "orders").select(F.concat(mark, F.col("o_orderkey").cast("string")).alias("value"))
    rows.unionByName(table(spark, sf, "region").select(F.concat(F.lit("--- "), "r_name").alias("value"))).write.text(path)
    return read_id_list(spark, path)


@query(_FLAGS + """
SELECT DISTINCT l_orderkey AS num, l_orderkey // 10 AS shard_id, l_orderkey // 10000 AS release_id FROM lineitem
WHERE l_orderkey // 10 IN (SELECT shard FROM shards WHERE complete)""")
def write_shards(spark, sf):
    """Complete shards in two steps: those without deleted ids, then all that are not there yet. Releases of 10000 ids."""
    path = scratch_path(spark, "shards")
    blobs = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("num")).distinct()
    complete = recon.shard_status(flags(spark, sf), _SHARD).where("complete")
    early = complete.where((F.col("not_found") == 0) & (F.col("takedown") == 0))
    sinks.write_shards(blobs, early, path, None, _SHARD, _SHARD * 1000)
    existing = spark.read.parquet(path).select("shard_id").distinct()
    sinks.write_shards(blobs, complete, path, existing, _SHARD, _SHARD * 1000)
    done = spark.read.parquet(path)
    return done.select("num", F.col("shard_id").cast("long").alias("shard_id"), F.col("release_id").cast("long").alias("release_id"))


@query(_FLAGS + """
SELECT l_orderkey AS num, l_linenumber, l_orderkey // 50 AS release_id FROM lineitem
WHERE l_orderkey // 50 IN (SELECT release_id FROM releases WHERE complete)
AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def write_release(spark, sf):
    path = scratch_path(spark, "release")
    shards = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("num"), "l_linenumber", F.floor(F.col("l_orderkey") / 50).alias("release_id")
    )
    releases = recon.release_status(recon.shard_status(flags(spark, sf), _SHARD), _RELEASE).where("complete")
    listed = table(spark, sf, "orders").where(F.col("o_orderstatus") != "P").select(F.col("o_orderkey").alias("num"))
    sinks.write_release(shards, releases, listed, path)
    return spark.read.parquet(path).select("num", "l_linenumber", F.col("release_id").cast("long").alias("release_id"))


@query("SELECT DISTINCT l_orderkey AS num, l_orderkey // 1000 AS shard_id, l_orderkey // 5000 AS release_id FROM lineitem")
def union_shards(spark, sf):
    """All shards of all releases as one table."""
    from subtlake.sources.providers import open_providers

    path = scratch_path(spark, "archive")
    blobs = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("num")).distinct()
    shards = blobs.select(F.floor(F.col("num") / 1000).alias("shard")).distinct()
    sinks.write_shards(blobs, shards, path, None, 1000, 5000)
    every = open_providers(spark, path)
    return every.select("num", F.col("shard_id").cast("long").alias("shard_id"), F.col("release_id").cast("long").alias("release_id"))


@query("""
SELECT column_name AS name, CASE column_name WHEN 'o_orderkey' THEN 'bigint' WHEN 'o_totalprice' THEN 'double' ELSE 'string' END AS type,
  CASE column_name WHEN 'o_totalprice' THEN 'price' ELSE column_name END AS sql, rows FROM
  (SELECT unnest(['o_orderkey', 'o_totalprice', 'o_orderstatus']) AS column_name), (SELECT count(*) AS rows FROM orders)""")
def export_schema(spark, sf):
    """Schema sidecar beside a written table, read back with the table's row count."""
    path = scratch_path(spark, "schema")
    data = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    data.write.parquet(f"{path}/data")
    sidecar = sinks.export_schema(data, {"o_totalprice": "price"})
    rows = spark.read.parquet(f"{path}/data").agg(F.count(F.lit(1)).alias("rows"), F.max(F.lit(sidecar)).alias("s"))
    parsed = F.from_json("s", "array<struct<name:string,type:string,sql:string>>")
    return rows.select("rows", F.inline(parsed)).select("name", "type", "sql", "rows")

"""Projections and filters. Orders and parts stand for metadata rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from subtlake.functions import dates, registry, text
from subtlake.operators import grouping, languages, ranking
from subtlake.plans.registry import query, table
from subtlake.plans.titles import _META, part_meta
from subtlake.sources.tables import scan_blobs


@query("""
SELECT c_custkey, replace(c_mktsegment || '''s ' || c_name, '''', '') AS clean FROM customer""")
def clean_title(spark, sf):
    title = F.concat(F.col("c_mktsegment"), F.lit("'s "), F.col("c_name"))
    return table(spark, sf, "customer").select("c_custkey", text.clean_title(title).alias("clean"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'Plain.Name.0.BRip' ELSE o_orderpriority || '.' END AS title
FROM orders""")
def release_title(spark, sf):
    year = F.when(F.col("o_orderstatus") == "O", 0).otherwise(F.year("o_orderdate"))
    release = F.when(F.col("o_orderstatus") == "O", "Plain.Name.0.BRip").otherwise(
        F.concat("o_orderpriority", F.lit("."), year.cast("string"), F.lit(".720p."), year.cast("string"), F.lit(".x"))
    )
    return table(spark, sf, "orders").select("o_orderkey", text.release_title(release, year).alias("title"))


def order_meta(spark, sf):
    """Orders as metadata rows; status O has no catalogue id."""
    orders = table(spark, sf, "orders")
    return orders.select(
        F.col("o_orderkey").alias("IDSubtitle"), F.concat(F.col("o_orderpriority"), F.lit("'s")).alias("MovieName"),
        F.year("o_orderdate").cast("long").alias("MovieYear"), F.col("o_orderstatus").alias("ISO639"),
        dates.date_text(F.col("o_orderdate")).alias("SubAddDate"),
        F.when(F.col("o_orderstatus") == "O", F.lit(0)).otherwise(F.col("o_custkey")).alias("ImdbID"),
        F.lit(1).cast("long").alias("SubSumCD"),
        F.concat(F.lit("R."), F.year("o_orderdate").cast("string"), F.lit(".x")).alias("MovieReleaseName"),
        F.lit(0).cast("long").alias("SeriesSeason"), F.lit(0).cast("long").alias("SeriesEpisode"),
        F.lit(0).cast("long").alias("SeriesIMDBParent"),
        F.when(F.col("o_orderstatus") == "F", "tv").otherwise("movie").alias("MovieKind"),
    )


@query("""
SELECT o_orderkey AS IDSubtitle, o_orderpriority || '''s' AS MovieName, o_orderpriority || 's' AS _MovieNameClean,
  year(o_orderdate) AS MovieYear, o_orderstatus AS ISO639, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS SubAddDate,
  CASE WHEN o_orderstatus = 'O' THEN 0 ELSE o_custkey END AS ImdbID, CAST(1 AS BIGINT) AS SubSumCD, 'R.' AS MovieReleaseName,
  CAST(0 AS BIGINT) AS SeriesSeason, CAST(0 AS BIGINT) AS SeriesEpisode, CAST(0 AS BIGINT) AS SeriesIMDBParent,
  CASE WHEN o_orderstatus = 'F' THEN 'tv' ELSE 'movie' END AS MovieKind
FROM orders""")
def select_columns(spark, sf):
    return registry.select_columns(order_meta(spark, sf))


@query("""
SELECT o_orderkey AS IDSubtitle,
  CASE WHEN o_orderstatus = 'O' OR o_custkey = 0 THEN o_orderpriority || '''s' ELSE '' END AS MovieNameIfNoImdbId,
  CASE WHEN o_orderstatus = 'O' OR o_custkey = 0 THEN year(o_orderdate) ELSE 0 END AS MovieYearIfNoImdbId,
  CAST(epoch(o_orderdate) AS BIGINT) AS SubAddDateUnix, CAST(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS INTEGER) AS MovieKindIsMovie
FROM orders""")
def case_columns(spark, sf):
    return registry.select_columns(order_meta(spark, sf), ["IDSubtitle", *registry.EXPORTED])


@query("SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS added FROM events")
def epoch_column(spark, sf):
    added = dates.added_epoch(dates.date_text(F.col("ts")))
    return table(spark, sf, "events").select("event_id", added.alias("added"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey BETWEEN 5000 AND 6000000")
def scan_range(spark, sf):
    return scan_blobs(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 5000, 6_000_000, "o_orderkey")


@query("SELECT doc_id, lang FROM documents WHERE lang IN ('de', 'fr')")
def lang_in(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("ISO639"))
    return ranking.filter_meta(docs, lang=["de", "fr"]).select("doc_id", F.col("ISO639").alias("lang"))


@query(_META + "SELECT num, title FROM meta WHERE kind = 'movie' AND parts = 1 AND year = 1960")
def kind_year_single(spark, sf):
    rows = ranking.filter_meta(part_meta(spark, sf), kind="movie", year=1960, single_part=True)
    return rows.select(F.col("IDSubtitle").alias("num"), F.col("MovieName").alias("title"))


@query(_META + "SELECT num, title FROM meta WHERE kind = 'tv'")
def kind_any_year(spark, sf):
    rows = ranking.filter_meta(part_meta(spark, sf), kind="tv", year=None)
    return rows.select(F.col("IDSubtitle").alias("num"), F.col("MovieName").alias("title"))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey > 0 AND l_partkey <= 150")
def valid_catalogue_id(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return grouping.valid_catalogue_ids(rows, "l_partkey", 150)


@query("SELECT event_id, value FROM events WHERE event_id >= 100 AND CAST(floor(value / 10) AS BIGINT) > 0")
def min_id_nonzero(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value", F.floor(F.col("value") / 10).alias("size"))
    return grouping.files_to_pack(events, "event_id", "size", 100).select("event_id", "value")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'")
def undefined_language(spark, sf):
    coded = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "O", "").otherwise("en").alias("ISO639")
    )
    return languages.undefined_language(coded, "ISO639").select("o_orderkey")


@query("SELECT p_partkey, p_name FROM part WHERE p_name ILIKE 'RED %'")
def title_ilike(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    return ranking.title_like(part, "p_name", "RED %")


@query("SELECT c_custkey, c_name FROM customer WHERE contains(upper(c_name), '#0000')")
def title_ilike_literal(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", F.concat(F.lit("50%_"), "c_name").alias("title"))
    pattern = ranking.like_literal("50%_CUSTOMER#0000") + "%"
    return ranking.title_like(rows, "title", pattern).select("c_custkey", "c_name")

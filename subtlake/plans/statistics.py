"""Archive statistics. Orders stand for metadata rows, parts for titles, documents for files."""

from __future__ import annotations

from pyspark.sql import functions as F

from subtlake.functions.dates import date_text
from subtlake.functions.listing import captures
from subtlake.operators import stats
from subtlake.operators.sequences import bucket_bounds as bounds
from subtlake.plans.registry import query, table

_DATE = "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"


@query(f"SELECT substr({_DATE}, 1, 4) AS year, count(*) AS n FROM orders GROUP BY 1")
def count_by_year(spark, sf):
    return stats.count_by_date(table(spark, sf, "orders"), date_text(F.col("o_orderdate")), 4, "year")


@query(f"SELECT substr({_DATE}, 1, 7) AS month, count(*) AS n FROM orders GROUP BY 1")
def count_by_month(spark, sf):
    return stats.count_by_date(table(spark, sf, "orders"), date_text(F.col("o_orderdate")), 7, "month")


@query(f"SELECT substr({_DATE}, 1, 10) AS day, count(*) AS n FROM orders GROUP BY 1")
def count_by_day(spark, sf):
    return stats.count_by_date(table(spark, sf, "orders"), date_text(F.col("o_orderdate")), 10, "day")


@query(f"""
SELECT year, month, day, count(*) AS n FROM (
  SELECT substr({_DATE}, 1, 4) AS year, substr({_DATE}, 1, 7) AS month, substr({_DATE}, 1, 10) AS day FROM orders
) GROUP BY ROLLUP (year, month, day)""")
def rollup_date(spark, sf):
    return stats.rollup_date(table(spark, sf, "orders"), date_text(F.col("o_orderdate")))


@query(f"""
SELECT o_orderkey // 1000 AS bucket, min(o_orderkey) AS first_num, arg_min({_DATE}, o_orderkey) AS first_time,
       max(o_orderkey) AS last_num, arg_max({_DATE}, o_orderkey) AS last_time
FROM orders GROUP BY 1""")
def bucket_bounds(spark, sf):
    return bounds(table(spark, sf, "orders"), "o_orderkey", date_text(F.col("o_orderdate")), 1000)


@query("SELECT count(*) AS rows FROM lineitem")
def row_count(spark, sf):
    return stats.row_count(table(spark, sf, "lineitem"))


@query("SELECT count(DISTINCT p_name) AS titles FROM part WHERE p_type = 'ECONOMY'")
def distinct_titles(spark, sf):
    return stats.distinct_titles(table(spark, sf, "part"), "p_name", F.col("p_type") == "ECONOMY")


@query("SELECT count(*) AS rows FROM part WHERE p_type = 'ECONOMY'")
def count_kind(spark, sf):
    return stats.row_count(table(spark, sf, "part"), F.col("p_type") == "ECONOMY")


@query("""
SELECT count(*) AS groups FROM (SELECT DISTINCT p_name, p_size FROM part WHERE p_brand = 'Brand#2')""")
def distinct_groups(spark, sf):
    return stats.distinct_groups(table(spark, sf, "part"), "p_name", "p_size", F.col("p_brand") == "Brand#2")


@query("""
SELECT min(length(href)) AS min_c1, max(length(href)) AS max_c1, min(length(label)) AS min_c2,
       max(length(label)) AS max_c2
FROM (SELECT unnest(regexp_extract_all(html, '<a href="(/[^"]*)">([^<]*)</a>', 1)) AS href,
             unnest(regexp_extract_all(html, '<a href="(/[^"]*)">([^<]*)</a>', 2)) AS label FROM pages)""")
def capture_bounds(spark, sf):
    links = captures(F.col("html"), r'<a href="(/[^"]*)">([^<]*)</a>', 2)
    return stats.capture_bounds(table(spark, sf, "pages"), links, ["c1", "c2"])


_SIZES = "octet_length(encode(text))"


@query(f"""
SELECT files, bytes, round(bytes / files, 4) AS avg_bytes, round(files / 1000000 * 100, 4) AS progress_percent,
       CAST(floor(bytes / ((files / 1000000 * 100) / 100)) AS BIGINT) AS projected_bytes
FROM (SELECT count(*) AS files, CAST(sum({_SIZES}) AS BIGINT) AS bytes FROM documents)""")
def size_summary(spark, sf):
    return stats.size_summary(table(spark, sf, "documents"), F.octet_length("text"), 1_000_000)


@query("""
SELECT l_returnflag, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS stored_bytes,
       CAST(sum(CAST(round(l_extendedprice) AS BIGINT)) AS BIGINT) AS plain_bytes,
       CAST(round(sum(CAST(l_quantity AS BIGINT)) / sum(CAST(round(l_extendedprice) AS BIGINT)) * 100) AS BIGINT)
         AS percent
FROM lineitem GROUP BY 1""")
def group_size_ratio(spark, sf):
    whole = lambda c: F.round(c).cast("long")
    return stats.group_size_ratio(
        table(spark, sf, "lineitem"), ["l_returnflag"], whole(F.col("l_quantity")), whole(F.col("l_extendedprice"))
    )


@query(f"SELECT lang, count(*) AS files, CAST(sum({_SIZES}) AS BIGINT) AS bytes FROM documents GROUP BY lang")
def lang_histogram(spark, sf):
    return stats.lang_histogram(table(spark, sf, "documents"), F.col("lang"), F.octet_length("text"))


@query("""
SELECT round(avg(CAST(round(l_discount * 100) AS BIGINT)), 4) AS avg_saving, count(*) AS lines FROM lineitem""")
def average_saving(spark, sf):
    item = table(spark, sf, "lineitem")
    smaller = F.round(F.col("l_discount") * 100).cast("long").cast("string")
    line = F.concat(F.lit("tar "), F.col("l_orderkey").cast("string"), F.lit(".xz: xz 12K = "), smaller, F.lit("% smaller"))
    return stats.average_saving(item.select(line.alias("line")), "line")


@query("""
SELECT page_id AS num, CAST(length(html) AS BIGINT) AS downloads, 7 * (length(html) % 10) AS rating,
       CAST(length(url) AS BIGINT) AS votes, page_id AS uploader_id
FROM pages""")
def listing_extract(spark, sf):
    from subtlake.functions.listing import extract_listing

    pages = table(spark, sf, "pages")
    tenths = (F.length("html") % 10) * 7
    rating = F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))
    row = F.format_string(
        '<tr onclick="x" id="a"> <td id="name%s"><a href="/x">%s</a></td><td><a href="/y">%sx\n</a><br>'
        '<span title="%s votes">%s</span></td><td><a href="/en/profile/iduser-%s">u</a></td></tr>',
        F.col("page_id").cast("string"), F.col("url"), F.length("html").cast("string"),
        F.length("url").cast("string"), rating, F.col("page_id").cast("string"),
    )
    listed = pages.select(F.concat(F.col("html"), row).alias("html"))
    return listed.select(F.inline(extract_listing(F.col("html"))))

"""Title search and lookup. Parts stand for metadata rows: name as title, size as year, type as language."""

from __future__ import annotations

from pyspark.sql import functions as F

from subtlake.fixed_values import MARKED_LETTERS, PLAIN_LETTERS
from subtlake.functions.text import fts_tokens
from subtlake.operators import archive, postings, ranking, search, stats
from subtlake.plans.registry import files, query, table
from subtlake.session import scratch_path

# metadata columns of a part; kinds and seasons by size, languages by type
_META = """
WITH meta AS (
  SELECT p_partkey AS num, p_name AS title, 1950 + p_size AS year,
    CASE p_type WHEN 'ECONOMY' THEN 'en' WHEN 'STANDARD' THEN 'de' WHEN 'PROMO' THEN 'fr' WHEN 'LARGE' THEN 'es'
      WHEN 'SMALL' THEN 'cs' ELSE 'ja' END AS lang,
    CASE WHEN p_size <= 30 THEN 'movie' ELSE 'tv' END AS kind, CASE WHEN p_size > 30 THEN p_size - 30 ELSE 0 END AS season,
    CASE WHEN p_size > 30 THEN CAST(substr(p_brand, 7) AS BIGINT) ELSE 0 END AS episode,
    CASE WHEN p_size IN (7, 37) THEN 2 ELSE 1 END AS parts FROM part),
asked AS (
  SELECT 'm:' || title AS query_id, 'movie' AS type, title, NULL AS year, NULL AS season, NULL AS episode FROM
    (SELECT DISTINCT p_name AS title FROM part)
  UNION ALL
  SELECT DISTINCT 'y:' || p_name || p_size, 'movie', p_name, 1950 + p_size, NULL, NULL FROM part
  UNION ALL
  SELECT DISTINCT 'e:' || p_name || p_size || p_brand, 'episode', p_name, NULL, p_size - 30, CAST(substr(p_brand, 7) AS BIGINT)
  FROM part WHERE p_size > 30),
hits AS (
  SELECT a.query_id, m.num, m.lang FROM asked a JOIN meta m
    ON list_sort(string_split(a.title, ' ')) = list_sort(string_split(m.title, ' ')) AND m.parts = 1
    AND m.lang IN ('en', 'de', 'cs')
    AND ((a.type = 'movie' AND m.kind = 'movie' AND (a.year IS NULL OR a.year = m.year))
      OR (a.type = 'episode' AND m.kind = 'tv' AND a.season = m.season AND a.episode = m.episode))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY num) AS rn FROM hits)
"""


def part_meta(spark, sf):
    lang = F.lit("ja")
    for kind, code in (("ECONOMY", "en"), ("STANDARD", "de"), ("PROMO", "fr"), ("LARGE", "es"), ("SMALL", "cs")):
        lang = F.when(F.col("p_type") == kind, code).otherwise(lang)
    tv = F.col("p_size") > 30
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("IDSubtitle"), F.col("p_name").alias("MovieName"),
        (F.col("p_size") + 1950).cast("long").alias("MovieYear"), lang.alias("ISO639"),
        F.when(tv, "tv").otherwise("movie").alias("MovieKind"),
        F.when(tv, F.col("p_size") - 30).otherwise(0).cast("long").alias("SeriesSeason"),
        F.when(tv, F.substring("p_brand", 7, 9).cast("long")).otherwise(0).cast("long").alias("SeriesEpisode"),
        F.when(F.col("p_size").isin(7, 37), 2).otherwise(1).alias("SubSumCD"),
    )


def part_tokens(spark, sf):
    """The token table of the parts' names, written and read back."""
    path = scratch_path(spark, "tokens")
    search.write_token_table(search.token_table(part_meta(spark, sf), "IDSubtitle", ["MovieName"]), path)
    return search.read_tokens(spark, path, "MovieName", "IDSubtitle")


def part_queries(spark, sf):
    """Queries with their words in reverse order: by title, by title and year, by episode."""
    part = table(spark, sf, "part")
    swapped = F.upper(F.array_join(F.reverse(F.split("p_name", " ")), ", ")).alias("title")
    none = F.lit(None).cast("long")
    movie = part.select(F.concat(F.lit("m:"), "p_name").alias("query_id"), F.lit("movie").alias("type"), swapped,
                        none.alias("year"), none.alias("season"), none.alias("episode"))
    dated = part.select(F.concat(F.lit("y:"), "p_name", "p_size"), F.lit("movie"), swapped,
                        (F.col("p_size") + 1950).cast("long"), none, none)
    episode = part.where("p_size > 30").select(
        F.concat(F.lit("e:"), "p_name", "p_size", "p_brand"), F.lit("episode"), swapped, none,
        (F.col("p_size") - 30).cast("long"), F.substring("p_brand", 7, 9).cast("long"),
    )
    langs = F.array(F.lit("eng"), F.lit("ger"), F.lit("cz")).alias("langs")
    return movie.union(dated).union(episode).distinct().select("*", langs, F.col("query_id").alias("video_base"))


@query(_META + """
SELECT a.query_id, m.num FROM asked a JOIN meta m
ON list_sort(string_split(a.title, ' ')) = list_sort(string_split(m.title, ' ')) WHERE a.query_id LIKE 'm:%'""")
def fts_and(spark, sf):
    asked = part_queries(spark, sf).where(F.startswith("query_id", F.lit("m:"))).select("query_id", "title")
    hits = search.fts_and(part_meta(spark, sf), "IDSubtitle", "MovieName", asked, tokens=part_tokens(spark, sf))
    return hits.select("query_id", F.col("IDSubtitle").alias("num"))


_WORDS = f"""WITH w AS (SELECT conv_id * 1000 + turn AS num, regexp_extract_all(translate(lower(text), '{MARKED_LETTERS}', '{PLAIN_LETTERS}'),
    '([\\p{{L}}\\p{{N}}_]+)', 1) AS words FROM conversations)
"""


def conversation_postings(spark, sf):
    """Conversation texts under their numbers, and their posting lists, written and read back."""
    texts = files(spark, sf, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("num"), "text")
    path = scratch_path(spark, "postings")
    postings.write_postings(postings.posting_blocks(texts, "num", "text"), path, postings.token_cuts(texts, "text", 3))
    return texts, spark.read.parquet(path)


@query(_WORDS + """, t AS (SELECT num, i - 1 AS place, words[i:i + 2] AS phrase FROM (SELECT num, words, unnest(range(1, len(words) - 1)) AS i FROM w))
SELECT q.num AS query_id, t.num, count(*) AS hits, min(place) AS first
FROM (SELECT num, words[1:3] AS phrase FROM w WHERE len(words) >= 3) q JOIN t ON q.phrase = t.phrase GROUP BY 1, 2""")
def fts_phrase(spark, sf):
    """The first three words of every text, searched as a phrase in all texts."""
    texts, lists = conversation_postings(spark, sf)
    first = F.slice(fts_tokens(F.col("text")), 1, 3)
    asked = texts.select(F.col("num").alias("query_id"), F.when(F.size(first) == 3, F.concat(F.lit('"'), F.array_join(first, ", "), F.lit('"'))).alias("phrase"))
    return postings.phrase_hits(lists, asked, "phrase").withColumn("first", F.col("first").cast("long"))


@query(_WORDS + """, q AS (SELECT num AS query_id, unnest(list_distinct(words[-5:])) AS word, len(list_distinct(words[-5:])) AS n FROM w),
t AS (SELECT DISTINCT num, unnest(words) AS word FROM w)
SELECT query_id, num FROM q JOIN t ON q.word = t.word GROUP BY query_id, num HAVING count(*) = min(n)""")
def fts_words(spark, sf):
    """The last five words of every text, searched in any order in all texts."""
    texts, lists = conversation_postings(spark, sf)
    words = fts_tokens(F.col("text"))
    last = F.reverse(F.slice(F.reverse(words), 1, 5))
    asked = texts.select(F.col("num").alias("query_id"), F.array_join(last, " ").alias("wanted"))
    return postings.word_hits(lists, asked, "wanted")


@query(f"""
SELECT 'text' AS field, token, count(*) AS ids, min(doc_id) AS first_num FROM (
  SELECT DISTINCT doc_id, unnest(regexp_extract_all(translate(lower(text), '{MARKED_LETTERS}', '{PLAIN_LETTERS}'),
    '([\\p{{L}}\\p{{N}}_]+)', 1)) AS token FROM documents) GROUP BY token""")
def token_table(spark, sf):
    tokens = search.token_table(files(spark, sf), "doc_id", ["text"])
    return tokens.groupBy("field", "token").agg(F.count(F.lit(1)).alias("ids"), F.min("num").alias("first_num"))


@query(_META + "SELECT query_id, num FROM ranked WHERE rn <= 3")
def limit_per_query(spark, sf):
    hits = search.lookup_hits(part_meta(spark, sf), part_queries(spark, sf), 3, part_tokens(spark, sf))
    return hits.select("query_id", F.col("IDSubtitle").alias("num"))


@query(_META + "SELECT query_id, num, lang FROM ranked WHERE rn <= 500")
def lookup_batch(spark, sf):
    hits = search.lookup_hits(part_meta(spark, sf), part_queries(spark, sf), 500, part_tokens(spark, sf))
    return hits.select("query_id", F.col("IDSubtitle").alias("num"), F.col("ISO639").alias("lang"))


_PROVIDERS = [
    {"id": "off", "num_range_from": 1, "num_range_to": 100_000_000, "enabled": False},
    {"id": "german", "num_range_from": 1, "num_range_to": 900, "lang": "ger"},
    {"id": "low", "num_range_from": 1, "num_range_to": 400},
    {"id": "middle", "num_range_from": 350, "num_range_to": 1500},
    {"id": "high", "num_range_from": 1600, "num_range_to": 100_000_000},
]
_ROUTE = """CASE WHEN num BETWEEN 1 AND 900 AND lang = 'de' THEN 'german' WHEN num BETWEEN 1 AND 400 THEN 'low'
  WHEN num BETWEEN 350 AND 1500 THEN 'middle' WHEN num BETWEEN 1600 AND 100000000 THEN 'high' END"""


@query(_META + f"""
SELECT query_id, num, provider, query_id || '.' || lpad(CAST(num AS VARCHAR), 8, '0') || '.'
  || CASE lang WHEN 'en' THEN 'eng' WHEN 'de' THEN 'ger' ELSE 'cze' END || '.sub' AS path, body AS content
FROM (SELECT r.query_id, r.num, r.lang, {_ROUTE} AS provider, p_name || ' ' || p_brand AS body
      FROM ranked r JOIN part ON p_partkey = num WHERE rn <= 500) WHERE provider IS NOT NULL""")
def lookup(spark, sf):
    """Every part has an archive: a folder, an integrity text, the subtitle as .txt and a second file."""
    utf8 = lambda text: F.encode(text, "UTF-8")
    member = lambda path, content: F.struct(F.lit(path).alias("path"), utf8(content).alias("content"))
    members = F.array(
        member("dir/", F.lit("")), member("dir/x.nfo", F.lit("info")),
        member("dir/Title.txt", F.concat_ws(" ", "p_name", "p_brand")), member("dir/other.srt", F.lit("other")),
    )
    blobs = archive.pack_archives(files(spark, sf, "part"), "p_partkey", members)
    found = search.lookup(part_meta(spark, sf), blobs, part_queries(spark, sf), _PROVIDERS, limit=500, tokens=part_tokens(spark, sf))
    return found.withColumn("content", F.col("content").cast("string"))


@query("""
SELECT o_orderkey AS num, CASE WHEN o_orderkey BETWEEN 1 AND 900 AND o_orderstatus = 'P' THEN 'german'
  WHEN o_orderkey BETWEEN 1 AND 400 THEN 'low' WHEN o_orderkey BETWEEN 350 AND 1500 THEN 'middle'
  WHEN o_orderkey BETWEEN 1600 AND 100000000 THEN 'high' END AS provider FROM orders""")
def route_to_provider(spark, sf):
    lang = F.when(F.col("o_orderstatus") == "P", "ger").otherwise("eng")
    ids = table(spark, sf, "orders").select(F.col("o_orderkey").alias("num"), lang.alias("lang"))
    return search.route_to_provider(ids, _PROVIDERS, "num", "lang").select("num", "provider")


@query("""
SELECT p_partkey AS num, p_name AS title, l_orderkey, l_linenumber, l_quantity FROM part JOIN lineitem ON p_partkey = l_partkey
WHERE p_type = 'ECONOMY'""")
def title_to_subs(spark, sf):
    titles = table(spark, sf, "part").where(F.col("p_type") == "ECONOMY").select(
        F.col("p_partkey").alias("num"), F.col("p_name").alias("title")
    )
    meta = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("num"), "l_orderkey", "l_linenumber", "l_quantity")
    return stats.title_to_subs(titles, meta, "num")


@query("""
SELECT n_regionkey AS parent, r_name AS parent_title, n_nationkey AS season, n_nationkey + 1 AS episode, n_nationkey AS id,
       count(*) AS subs
FROM nation JOIN region ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2, 3, 4, 5""")
def episode_rollup(spark, sf):
    episodes = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_regionkey").alias("parent"), F.col("n_nationkey").alias("season"),
        (F.col("n_nationkey") + 1).alias("episode"),
    )
    titles = table(spark, sf, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("title"))
    meta = table(spark, sf, "customer").select(F.col("c_nationkey").alias("imdb_id"), F.col("c_custkey").alias("num"))
    return stats.episode_rollup(episodes, titles, meta)


@query("""
SELECT l_orderkey AS num, l_linenumber, o_totalprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderstatus = 'F'""")
def fetch_content(spark, sf):
    hits = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("num"), "o_totalprice"
    )
    blobs = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("num"), "l_linenumber")
    return search.fetch_content(hits, blobs).select("num", "l_linenumber", "o_totalprice")


@query("""
SELECT lang AS ISO639, code2 AS lang2, CASE code2 WHEN 'de' THEN 'ger' WHEN 'en' THEN 'eng' WHEN 'es' THEN 'spa'
  WHEN 'fr' THEN 'fre' WHEN 'cs' THEN 'cze' WHEN 'ja' THEN 'jpn' END AS lang3, n
FROM (SELECT CASE WHEN lang = 'es' THEN 'mx' WHEN lang = 'de' THEN 'ger' ELSE lang END AS lang, lang AS code2, count(*) AS n
      FROM documents GROUP BY 1, 2)""")
def lang_map(spark, sf):
    from subtlake.operators.languages import with_languages

    # a country code and a three-letter code among the two-letter ones
    code = F.when(F.col("lang") == "es", "mx").when(F.col("lang") == "de", "ger").otherwise(F.col("lang"))
    docs = files(spark, sf).select(code.alias("ISO639"))
    counted = docs.groupBy("ISO639").agg(F.count(F.lit(1)).alias("n"))
    return with_languages(counted, "ISO639")

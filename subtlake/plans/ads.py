"""Advertising text. Documents are files, their non-empty lines are cues."""

from __future__ import annotations

from pyspark.sql import functions as F

from subtlake.functions.text import removal_regex, split_lines
from subtlake.operators import ads, cues
from subtlake.plans.registry import files, query, table

_LINES = """
WITH l AS (SELECT doc_id, lang, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS lines FROM documents),
cues AS (SELECT doc_id, lang, unnest(lines) AS line, unnest(generate_series(0, len(lines) - 1)) AS ord, len(lines) AS n
         FROM l WHERE len(lines) > 0)"""
_EDGES = _LINES + """, edges AS (
  SELECT doc_id, lang, line, CAST(CASE WHEN n >= 40 AND ord < 30 THEN ord WHEN n >= 40 AND ord >= n - 10 THEN ord - n
    WHEN n < 40 AND ord < ceil(n / 2) THEN ord WHEN n < 40 THEN ord - n END AS INTEGER) AS pos FROM cues
  WHERE n < 40 OR ord < 30 OR ord >= n - 10)"""
_KEYWORDS = ["license", "apache", "@"]
_HIT = "(contains(lower(line), 'license') OR contains(lower(line), 'apache') OR contains(lower(line), '@'))"

# removal patterns of the query: literal lines, a two-line pattern before its prefix, and one with a class
_PATTERNS = [
    ("This work is licensed under the .*", "[A-Z][a-z]+ .*"),
    (r"Licensed under the Apache License, Version [0-9]\.0\.",),
    (r"The and attion to thanedble the, anea\. Eriner thanea\.",),
    (r"(?:Of|And ornd)\.",),
    ("onrein ",),
]


def document_lines(spark, sf):
    docs = files(spark, sf).select("doc_id", "lang", "text")
    return docs.select("doc_id", "lang", F.inline(cues.line_array(F.col("text"))))


@query(_LINES + """
SELECT lang, line AS text, count(DISTINCT doc_id) AS files, count(*) AS occurrences FROM cues
GROUP BY lang, line HAVING count(DISTINCT doc_id) > 4""")
def repeated_blocks(spark, sf):
    return ads.repeated_blocks(document_lines(spark, sf), "lang", "doc_id", more_than=4)


@query(_EDGES + "SELECT doc_id, pos, line AS text FROM edges")
def edge_cues(spark, sf):
    docs = files(spark, sf)
    return cues.edge_cues(docs, "doc_id", cues.line_array(F.col("text"))).select("doc_id", "pos", "text")


@query(_EDGES + """
SELECT lang, line AS text, count(DISTINCT doc_id) AS files, count(*) AS occurrences FROM edges
GROUP BY lang, line HAVING count(DISTINCT doc_id) > 1""")
def find_repeated_blocks(spark, sf):
    docs = files(spark, sf)
    edges = cues.edge_cues(docs, "doc_id", cues.line_array(F.col("text")), keep=["lang"])
    return ads.repeated_blocks(edges, "lang", "doc_id")


@query(_EDGES + """
SELECT line AS txt, count(*) AS occurrences, count(DISTINCT doc_id) AS files, min(length(line)) AS min_len,
       max(length(line)) AS max_len, round(count(*) FILTER (pos >= 0) / count(*), 6) AS share_start
FROM edges GROUP BY line""")
def ad_stats(spark, sf):
    docs = files(spark, sf)
    edges = cues.edge_cues(docs, "doc_id", cues.line_array(F.col("text")))
    samples = edges.select(
        F.col("text").alias("txt"), F.length("text").cast("long").alias("len"), "pos", F.col("doc_id").alias("sub")
    )
    return ads.ad_stats(samples)


@query(_LINES + """
SELECT line AS text, arg_min(doc_id, doc_id * 1000000 + ord) AS doc_id,
       CAST(arg_min(ord, doc_id * 1000000 + ord) AS INTEGER) AS ord FROM cues GROUP BY line""")
def first_seen_text(spark, sf):
    return ads.first_seen_text(document_lines(spark, sf), "doc_id")


@query(_LINES + """
SELECT doc_id, CAST(ord AS INTEGER) AS ord, line AS text, lag(line) OVER w AS prev_text, lead(line) OVER w AS next_text
FROM cues WINDOW w AS (PARTITION BY doc_id ORDER BY ord)""")
def with_context(spark, sf):
    docs = files(spark, sf)
    return cues.with_context(docs, "doc_id", cues.line_array(F.col("text"))).select(
        "doc_id", "ord", "text", "prev_text", "next_text"
    )


@query(_LINES + f"""
, seen AS (
  SELECT doc_id, ord, line, lag(line) OVER (PARTITION BY doc_id ORDER BY ord) AS prev_text,
         row_number() OVER (PARTITION BY line ORDER BY doc_id, ord) AS nth,
         CASE WHEN {_HIT} THEN 1 WHEN length(line) * 25 > 5000 THEN 2 ELSE 0 END AS class FROM cues),
first AS (SELECT *, lag(class) OVER (PARTITION BY doc_id ORDER BY ord) AS before FROM seen WHERE nth = 1)
SELECT doc_id, CAST(ord AS INTEGER) AS ord, line AS text, CAST(class AS INTEGER) AS class,
       CASE WHEN class = 1 THEN prev_text END AS context_before,
       CAST(CASE WHEN class = 0 AND before > 0 THEN before END AS INTEGER) AS context_after
FROM first""")
def ad_candidates(spark, sf):
    docs = files(spark, sf)
    near = cues.with_context(docs, "doc_id", cues.line_array(F.col("text")))
    # documents have no times: 25 ms per character stand for the time on screen
    return ads.ad_candidates(near, "doc_id", _KEYWORDS, F.length("text") * 25)


@query(_LINES + f"""
SELECT DISTINCT line AS text, array_to_string(list_transform(string_split_regex(line, '\\r\\n|\\n|\\r|\\\\N|\\|'),
  lambda x: regexp_replace(x, '([\\[\\](){{}}?*+.^$])', '\\\\\\1', 'g')), chr(10)) AS lines
FROM cues WHERE {_HIT}""")
def candidate_patterns(spark, sf):
    from subtlake.functions.text import keyword_hit

    hits = document_lines(spark, sf).where(keyword_hit(F.col("text"), _KEYWORDS))
    patterns = ads.candidates_to_patterns(hits.select("text"))
    return patterns.select("text", F.array_join("lines", "\n").alias("lines"))


_REGEX = removal_regex(_PATTERNS).removeprefix("(?d)")


@query(f"SELECT doc_id, regexp_replace(text, '{_REGEX}', '', 'g') AS text FROM documents")
def remove_ads(spark, sf):
    return ads.remove_ads(files(spark, sf).select("doc_id", "text"), "text", _PATTERNS)


@query(f"SELECT doc_id, regexp_replace(text, '{_REGEX}', '', 'g') AS text FROM documents")
def remove_ads_bytes(spark, sf):
    docs = files(spark, sf).select("doc_id", F.encode("text", "UTF-8").alias("content"))
    cleaned = ads.remove_ads_bytes(docs, "content", _PATTERNS)
    return cleaned.select("doc_id", F.col("content").cast("string").alias("text"))


@query(f"SELECT doc_id, line_no, hit FROM (SELECT doc_id, ord AS line_no, {_HIT} AS hit FROM ({_LINES} SELECT * FROM cues))")
def keyword_hits(spark, sf):
    from subtlake.functions.text import keyword_hit

    return document_lines(spark, sf).select(
        "doc_id", F.col("ord").cast("long").alias("line_no"), keyword_hit(F.col("text"), _KEYWORDS).alias("hit")
    )


@query("""
SELECT doc_id, array_to_string(string_split_regex(text, '\\r\\n|\\n|\\r|\\\\N|\\|'), '¦') AS lines FROM documents""")
def split_lines_query(spark, sf):
    return files(spark, sf).select("doc_id", F.array_join(split_lines(F.col("text")), "¦").alias("lines"))


@query(_LINES + "SELECT line AS txt, lang FROM cues UNION SELECT text, 'en' FROM conversations")
def distinct_ads(spark, sf):
    old = document_lines(spark, sf).select(F.col("text").alias("txt"), "lang")
    new = table(spark, sf, "conversations").select(F.col("text").alias("txt"), F.lit("en").alias("lang"))
    return ads.merge_samples(old, new)


@query("SELECT event_id AS idx, event_type AS txt FROM events WHERE event_id > (SELECT max(event_id) FROM events) - 1000")
def tail_candidates(spark, sf):
    samples = table(spark, sf, "events").select(F.col("event_id").alias("idx"), F.col("event_type").alias("txt"))
    return ads.tail_rows(samples, "idx", 1000)


@query(_LINES + "SELECT line AS txt, length(line) AS len, CAST(ord AS INTEGER) AS pos, doc_id AS sub, lang FROM cues")
def ad_samples(spark, sf):
    """Write samples in the pipe-separated form and read them back."""
    from subtlake.session import scratch_path
    from subtlake.sources.tables import read_ad_samples

    path = scratch_path(spark, "ad-samples")
    lines = document_lines(spark, sf)
    row = F.concat_ws("|", "text", F.length("text").cast("string"), F.col("ord").cast("string"),
                      F.col("doc_id").cast("string"), "lang")
    lines.select(row.alias("value")).write.text(path)
    samples = read_ad_samples(spark, path)
    return samples.withColumn("len", F.col("len").cast("long"))


@query(_LINES + "SELECT DISTINCT line AS txt, lang FROM cues")
def append_candidates(spark, sf):
    """Samples of two languages, then all of them, merged into one table."""
    from subtlake.session import scratch_path
    from subtlake.sinks.tables import append_candidates as append

    samples = document_lines(spark, sf).select(F.col("text").alias("txt"), "lang")
    old, out = scratch_path(spark, "samples"), scratch_path(spark, "samples")
    samples.where(F.col("lang").isin("en", "de")).distinct().write.parquet(old)
    append(samples, old, out)
    return spark.read.parquet(out)

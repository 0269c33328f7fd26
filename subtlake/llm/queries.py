"""The operators' named queries over whole tables, with production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subtlake.llm import decontaminate, divergence, language, manifest, mixing, quality, secrets, simhash, substrings, topk, urls, vectors, warc
from subtlake.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold at least 0.8 of a benchmark item, in any order."""
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "item_tokens", "covered", "coverage")


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of near copies of every document."""
    return simhash.near_copies(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back by the index."""
    index = warc.write_archives(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    records = warc.read_records(index)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op3_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex FROM p),
m AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (
           (CAST('0x' || substr(hex, 5 * (i // 4) + 1, 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM m
"""


@query
def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every vector whose id is divisible by 50."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


ORACLE["op4_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i])) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's address judged by rules, and by boosted trees where no rule fits."""
    return urls.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language; its declared language and its source (as host) are evidence beside the text."""
    found = language.identify(table(spark, sf_dir, "documents"), declared=F.col("lang"), host=F.col("source"))
    return found.select("doc_id", "declared", "language", "posterior", "accepted")


@query
def page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's language: visible text, markup language, address suffix and host."""
    pages = table(spark, sf_dir, "pages")
    html = F.col("html")
    text = F.regexp_replace(html, r"(?s)<(script|style)\b.*?</\1>|<[^>]*>", " ")
    pages = pages.select("page_id", text.alias("text"), F.regexp_extract(html, r"""<html[^>]*\blang=["']?([A-Za-z-]+)""", 1).alias("markup"), "url")
    found = language.identify(pages, key="page_id", declared=F.col("markup"), host=language.host_of(F.col("url")))
    return found.select("page_id", "declared", "language", "posterior", "accepted")


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's chances of belonging to each domain and its rate under the target mix."""
    found = mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    chances = [F.col("posterior")[i].alias(f"p_{name}") for i, name in enumerate(mixing.DOMAINS)]
    return found.select("doc_id", "tokens", *chances, "rate", "copies")


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and list of the secrets of every document."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < len(secrets.STRONG))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == secrets.KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(kind) for kind in secrets.STRONG],
                        F.sha2(secrets.span_text(base).cast("binary"), 256).alias("base_sha256"), secrets.span_text(F.col("spans")).alias("spans"))


ORACLE["op8_secret_scan"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT doc_id, 0 AS kind, 'assign' AS name,
         regexp_extract_all(t, '((?i:password|passwd|secret|token|api_?key))["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0) AS found,
         list_transform(regexp_extract_all(t, '((?i:password|passwd|secret|token|api_?key))["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2),
                        lambda v: length(v) >= 12) AS fits,
         string_split_regex(t, '((?i:password|passwd|secret|token|api_?key))["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)') AS gaps FROM d
  UNION ALL SELECT doc_id, 1, 'access', regexp_extract_all(t, 'AKIA[A-Z0-9]+', 0),
         list_transform(regexp_extract_all(t, 'AKIA[A-Z0-9]+', 0), lambda v: length(v) >= 18), string_split_regex(t, 'AKIA[A-Z0-9]+') FROM d
  UNION ALL SELECT doc_id, 2, 'hex', regexp_extract_all(t, '[0-9a-f]{16,}', 0),
         list_transform(regexp_extract_all(t, '[0-9a-f]{16,}', 0), lambda v: length(v) >= 16), string_split_regex(t, '[0-9a-f]{16,}') FROM d
  UNION ALL SELECT doc_id, 3, 'identifier',
         regexp_extract_all(t, '(?i:(?:access|client|account|user)[_-]?(?:id|key|name))["'']?\\x20*[:=]\\x20*["'']?[A-Za-z0-9._@-]{4,}', 0),
         list_transform(regexp_extract_all(t, '(?i:(?:access|client|account|user)[_-]?(?:id|key|name))["'']?\\x20*[:=]\\x20*["'']?[A-Za-z0-9._@-]{4,}', 0), lambda v: true),
         string_split_regex(t, '(?i:(?:access|client|account|user)[_-]?(?:id|key|name))["'']?\\x20*[:=]\\x20*["'']?[A-Za-z0-9._@-]{4,}') FROM d
  UNION ALL SELECT doc_id, 4, 'key_part', regexp_extract_all(t, '[A-Za-z0-9+/_-]{20,}={0,2}', 0),
         list_transform(regexp_extract_all(t, '[A-Za-z0-9+/_-]{20,}={0,2}', 0),
                        lambda v: regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]')),
         string_split_regex(t, '[A-Za-z0-9+/_-]{20,}={0,2}') FROM d
  UNION ALL SELECT doc_id, 5, 'endpoint', regexp_extract_all(t, '[a-z][a-z0-9+.-]{1,15}://[^\\x20\\x09-\\x0D"''<>]+', 0),
         list_transform(regexp_extract_all(t, '[a-z][a-z0-9+.-]{1,15}://[^\\x20\\x09-\\x0D"''<>]+', 0), lambda v: true),
         string_split_regex(t, '[a-z][a-z0-9+.-]{1,15}://[^\\x20\\x09-\\x0D"''<>]+') FROM d
),
u AS (SELECT doc_id, kind, name, unnest(range(1, len(found) + 1)) AS i, found, fits, gaps FROM m WHERE len(found) > 0),
s AS (
  SELECT doc_id, kind, name, found[i] AS word, fits[i] AS fits, length(found[i]) AS size,
         sum(length(gaps[i]) + length(found[i])) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop
  FROM u
),
p AS (SELECT doc_id, kind, name, CAST(stop - size AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM s WHERE fits),
w AS (
  SELECT a.doc_id, a.kind, a.name, a.start, a.stop,
         bool_or(b.kind < 3 AND b.start < a.stop AND b.stop > a.start) AS covered,
         bool_or(b.kind IN (1, 3) AND NOT (b.start < a.stop AND b.stop > a.start)) AS id,
         bool_or(b.kind IN (0, 2, 4) AND NOT (b.start < a.stop AND b.stop > a.start)) AS secret
  FROM p a JOIN p b ON a.doc_id = b.doc_id AND a.kind >= 3 AND b.start < a.stop + 200 AND b.stop > a.start - 200
  GROUP BY ALL
),
o AS (
  SELECT * FROM p WHERE kind < 3
  UNION ALL SELECT doc_id, kind, name, start, stop FROM w
  WHERE NOT covered AND CASE kind WHEN 3 THEN secret WHEN 4 THEN id ELSE id AND secret END
)
SELECT d.doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
       count(*) FILTER (WHERE kind = 2) AS n_hex,
       sha256(coalesce(string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (WHERE kind < 3), '')) AS base_sha256,
       coalesce(string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind), '') AS spans
FROM d LEFT JOIN o ON d.doc_id = o.doc_id GROUP BY d.doc_id
"""


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality by its text, by its page, and by both."""
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows of 35 words that start elsewhere, too."""
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLE["op10_substring_dedup"] = """
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
),
s AS (
  SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, w FROM d WHERE len(w) >= 35
),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM s),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY h) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, list(DISTINCT j) AS gone FROM (SELECT doc_id, unnest(range(i, i + 35)) AS j FROM r) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ')
                   ELSE array_to_string(list_transform(list_sort(list_filter(range(1, len(w) + 1), lambda k: NOT list_contains(gone, k))), lambda k: w[k]), ' ') END) AS kept_sha256
FROM d LEFT JOIN c ON d.doc_id = c.doc_id
"""


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document; a third of the texts is lower-cased to see that this is noticed."""
    docs = table(spark, sf_dir, "documents")
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = manifest.manifest(docs, tampered={"text": F.when(chosen, F.translate("text", capitals, capitals.lower()))})
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


ORACLE["op11_merkle_manifest"] = """
WITH RECURSIVE d AS (
  SELECT doc_id, lang, source, n_chars, text,
         (4294967295 - list_reduce(list_concat([4294967295],
           list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))),
           lambda c, b: list_reduce(list_concat([xor(CAST(c AS BIGINT), CAST(b AS BIGINT))], range(8)),
             lambda v, u: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))) % 3 = 0 AS chosen
  FROM documents
), f AS (
  SELECT doc_id, lang, chosen, text AS was, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS changed,
         coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
         || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head
  FROM d
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM (SELECT doc_id, lang, sha256(head || coalesce(octet_length(encode(was)) || ':' || was, '-')) AS leaf,
               sha256(head || coalesce(octet_length(encode(CASE WHEN chosen THEN changed ELSE was END)) || ':' || CASE WHEN chosen THEN changed ELSE was END, '-')) AS now
        FROM f)
), lev AS (
  SELECT lang, 0 AS l, pos, leaf AS h, n FROM leaves
  UNION ALL
  SELECT lang, l + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM lev WHERE n > 1 GROUP BY lang, l, pos // 8, n
), sub AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM lev WHERE n = 1
), top AS (
  SELECT 0 AS l, pos, h, n FROM sub
  UNION ALL
  SELECT l + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM top WHERE n > 1 GROUP BY l, pos // 8, n
), seg AS (
  SELECT lang, l, pos, coalesce(string_agg(h, '') OVER (PARTITION BY lang, l, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
         coalesce(string_agg(h, '') OVER (PARTITION BY lang, l, pos // 8 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b
  FROM lev WHERE n > 1
), topseg AS (
  SELECT l, pos, coalesce(string_agg(h, '') OVER (PARTITION BY l, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
         coalesce(string_agg(h, '') OVER (PARTITION BY l, pos // 8 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b
  FROM top WHERE n > 1
), fold AS (
  SELECT lang, pos AS place, 0 AS l, pos, n, now AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT f.lang, f.place, f.l + 1, f.pos // 8, (f.n + 7) // 8, sha256(s.a || f.h || s.b), f.proof || s.a || s.b
  FROM fold f JOIN seg s ON s.lang IS NOT DISTINCT FROM f.lang AND s.l = f.l AND s.pos = f.pos WHERE f.n > 1
), topfold AS (
  SELECT f.lang, f.place, 0 AS l, s.pos, s.n, f.h, f.proof FROM fold f JOIN sub s ON s.lang IS NOT DISTINCT FROM f.lang WHERE f.n = 1
  UNION ALL
  SELECT f.lang, f.place, f.l + 1, f.pos // 8, (f.n + 7) // 8, sha256(s.a || f.h || s.b), f.proof || s.a || s.b
  FROM topfold f JOIN topseg s ON s.l = f.l AND s.pos = f.pos WHERE f.n > 1
)
SELECT x.doc_id, x.leaf, s.h AS subroot, r.h AS root, sha256(t.proof) AS proof_sha256, t.h AS folded_root, t.h = r.h AS verified
FROM leaves x JOIN sub s ON s.lang IS NOT DISTINCT FROM x.lang JOIN (SELECT h FROM top WHERE n = 1) r ON true
JOIN topfold t ON t.n = 1 AND t.lang IS NOT DISTINCT FROM x.lang AND t.place = x.pos
"""


@query
def op12_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all vectors of a label with a cosine of 0.93 or more."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source against the other sources of its language, and the terms it has more of than the language."""
    return divergence.divergences(table(spark, sf_dir, "documents"))


ORACLE["op13_divergence"] = """
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT row, lang, source, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{80}-\\x{10FFFF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT *, row_number() OVER () AS row FROM d)
),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
t AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
p AS (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
         1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2)) // (CAST(t.total AS HUGEINT) + 2 * v.v) AS p
  FROM t JOIN k ON k.lang = t.lang JOIN v ON v.lang = t.lang LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term
),
q AS (
  SELECT x.lang, x.term, 1 + (CAST(1000000000 AS HUGEINT) * (x.n + 2)) // (CAST(y.n AS HUGEINT) + 2 * v.v) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL) x JOIN (SELECT lang, sum(n) AS n FROM c GROUP BY ALL) y ON y.lang = x.lang JOIN v ON v.lang = x.lang
),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, ((p.p - q.q) * (p.p - q.q)) // (p.p + q.q) FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q
),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM o WHERE part = 'pair' OR rank <= 10
"""

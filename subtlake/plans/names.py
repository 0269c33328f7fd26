"""Names and scalars, on names built from the tables the same way on both sides."""

from __future__ import annotations

from pyspark.sql import functions as F

from subtlake.fixed_values import MARKED_LETTERS, PLAIN_LETTERS
from subtlake.functions import content, ids, names, text
from subtlake.operators import stats
from subtlake.plans.registry import files, query, table

_DOTTED = "replace(p_name, ' ', '.')"
# one family of archive names per part type
_ZIP_NAME = f"""CASE p_type
  WHEN 'ECONOMY' THEN {_DOTTED} || '.(' || (1950 + p_size) || ').slv.' || (1 + p_size % 3) || 'cd.(' || p_partkey || ').zip'
  WHEN 'STANDARD' THEN {_DOTTED} || '.(' || (1950 + p_size) || ').1cd.(' || p_partkey || ').zip'
  WHEN 'PROMO' THEN {_DOTTED} || '.(' || (1950 + p_size) || ').().ita.1cd.(' || p_partkey || ').zip'
  WHEN 'LARGE' THEN {_DOTTED} || '.().pob.0cd.(' || p_partkey || ').zip'
  WHEN 'SMALL' THEN '.(' || (600 + p_size) || ').pol.1dvd.(' || p_partkey || ').zip'
  ELSE 'readme.' || p_name || '.txt' END"""


def zip_names(spark, sf):
    part = table(spark, sf, "part")
    dotted = F.replace("p_name", F.lit(" "), F.lit("."))
    name = (
        F.when(F.col("p_type") == "ECONOMY", F.format_string(
            "%s.(%d).slv.%dcd.(%d).zip", dotted, F.col("p_size") + 1950, F.col("p_size") % 3 + 1, "p_partkey"))
        .when(F.col("p_type") == "STANDARD", F.format_string("%s.(%d).1cd.(%d).zip", dotted, F.col("p_size") + 1950, "p_partkey"))
        .when(F.col("p_type") == "PROMO", F.format_string("%s.(%d).().ita.1cd.(%d).zip", dotted, F.col("p_size") + 1950, "p_partkey"))
        .when(F.col("p_type") == "LARGE", F.format_string("%s.().pob.0cd.(%d).zip", dotted, "p_partkey"))
        .when(F.col("p_type") == "SMALL", F.format_string(".(%d).pol.1dvd.(%d).zip", F.col("p_size") + 600, "p_partkey"))
        .otherwise(F.format_string("readme.%s.txt", "p_name"))
    )
    return part.select("p_partkey", "p_type", "p_size", "p_name", name.alias("name"))


_PARSED = """
SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'STANDARD', 'PROMO', 'LARGE') THEN p_name WHEN p_type = 'SMALL' THEN '' END
    AS title,
  CASE WHEN p_type IN ('ECONOMY', 'STANDARD', 'PROMO') THEN CAST(1950 + p_size AS VARCHAR)
    WHEN p_type = 'LARGE' THEN '' WHEN p_type = 'SMALL' THEN CAST(600 + p_size AS VARCHAR) END AS year,
  CASE p_type WHEN 'ECONOMY' THEN 'slv' WHEN 'STANDARD' THEN 'eng' WHEN 'PROMO' THEN 'ita' WHEN 'LARGE' THEN 'pob'
    WHEN 'SMALL' THEN 'pol' END AS lang,
  CASE p_type WHEN 'ECONOMY' THEN CAST(1 + p_size % 3 AS VARCHAR) WHEN 'STANDARD' THEN '1' WHEN 'PROMO' THEN '1'
    WHEN 'LARGE' THEN '0' WHEN 'SMALL' THEN '1dvd' END AS parts,
  CASE WHEN p_type <> 'MEDIUM' THEN p_partkey END AS num,
  CASE p_type WHEN 'ECONOMY' THEN '' WHEN 'STANDARD' THEN 'missing sub_lang' WHEN 'PROMO' THEN 'extra empty parens after year'
    WHEN 'LARGE' THEN 'empty year' WHEN 'SMALL' THEN 'invalid year, empty movie name, no ''cd'' prefix in sub_numparts' END
    AS errors
FROM part"""


@query(_PARSED)
def parse_zip_name(spark, sf):
    parsed = zip_names(spark, sf).select("p_partkey", names.parse_zip_name(F.col("name")).alias("p"))
    rows = parsed.select("p_partkey", "p.*")
    return rows.withColumn("errors", F.array_join("errors", ", "))


@query(f"""
SELECT error, count(*) AS n FROM (SELECT unnest(string_split(errors, ', ')) AS error FROM ({_PARSED}) WHERE errors <> '')
GROUP BY error""")
def error_histogram(spark, sf):
    parsed = zip_names(spark, sf).select(names.parse_zip_name(F.col("name")).alias("p"))
    return stats.error_histogram(parsed, F.col("p.errors"))


@query(f"""
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'title.(1999).eng.1cd' WHEN 'F' THEN 'title.(1999).eng.1cd'
  ELSE 'x.(' || o_custkey || ').zip' END AS name FROM orders""")
def strip_disposition(spark, sf):
    orders = table(spark, sf, "orders")
    name = (
        F.when(F.col("o_orderstatus") == "P", F.format_string('attachment; filename="title.(1999).eng.1cd.(%d).zip"', "o_orderkey"))
        .when(F.col("o_orderstatus") == "F", F.format_string("title.(1999).eng.1cd.(%d).zip", "o_orderkey"))
        # the id in the name is that of another file, so it stays; unless both happen to be equal
        .otherwise(F.format_string("x.(%d).zip", "o_custkey"))
    )
    other = F.when((F.col("o_orderstatus") == "O") & (F.col("o_custkey") == F.col("o_orderkey")), F.lit(-1)).otherwise(F.col("o_orderkey"))
    return orders.select("o_orderkey", names.strip_disposition(name, other).alias("name"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_orderkey || '.alien.(1992).eng.2cd.zip' END AS modern,
  CASE o_orderstatus WHEN 'P' THEN o_orderkey WHEN 'F' THEN o_custkey END AS num FROM orders""")
def modernise_name(spark, sf):
    name = (
        F.when(F.col("o_orderstatus") == "P", F.format_string("%d.alien.(1992).eng.2cd.(%d).zip", "o_orderkey", "o_orderkey"))
        .when(F.col("o_orderstatus") == "F", F.format_string("snow.s01.e05.(2017).pol.1cd.(%d).zip", "o_custkey"))
        .otherwise(F.format_string("%d.html", "o_orderkey"))
    )
    named = table(spark, sf, "orders").select("o_orderkey", name.alias("name"))
    return named.select(
        "o_orderkey", names.modernise_name(F.col("name")).alias("modern"), names.legacy_num(F.col("name")).alias("num")
    )


@query("""
SELECT doc_id, 'attachment' AS type, CASE lang WHEN 'en' THEN replace(replace(text, '/', '_'), '\\', '_')
  WHEN 'fr' THEN replace(replace(text, '/', '_'), '\\', '_') ELSE source || '.part2.srt' END AS filename FROM documents""")
def disposition_filename(spark, sf):
    docs = files(spark, sf)
    coded = F.replace(F.url_encode("text"), F.lit("+"), F.lit("%20"))
    quoted = F.regexp_replace("text", r'(["\\])', r"\\$1")
    header = (
        F.when(F.col("lang") == "en", F.concat(F.lit('Attachment; filename="'), quoted, F.lit('"')))
        .when(F.col("lang") == "fr", F.concat(F.lit("attachment; filename=x; filename*=UTF-8'fr'"), coded))
        .otherwise(F.concat(F.lit('attachment; filename*1=".srt"; filename*0="'), F.col("source"), F.lit('.part2"')))
    )
    parsed = docs.select("doc_id", names.disposition_filename(header).alias("d"))
    return parsed.select("doc_id", "d.*")


@query("""
SELECT o_orderkey, (o_orderkey // 1000) AS shard, (o_orderkey // 1000) || 'xxx' AS name,
  CASE WHEN o_custkey >= 100 THEN left(CAST(o_custkey AS VARCHAR), length(CAST(o_custkey AS VARCHAR)) - 2) || 'xxxxx'
    ELSE '0xxxxx' END AS dir,
  substr(lpad(CAST(o_custkey AS VARCHAR), 6, '0'), 1, 2) || '/' || substr(lpad(CAST(o_custkey AS VARCHAR), 6, '0'), 3, 2)
    || '/' || substr(lpad(CAST(o_custkey AS VARCHAR), 6, '0'), 5, 2) || 'xxx.db' AS path,
  CASE WHEN length(CAST(o_orderkey AS VARCHAR)) < 4 THEN lpad(CAST(o_orderkey AS VARCHAR), 4, '0')
    ELSE CAST(o_orderkey AS VARCHAR) END AS padded
FROM orders""")
def shard_path(spark, sf):
    shard = F.col("o_custkey")
    return table(spark, sf, "orders").select(
        "o_orderkey", ids.shard_of(F.col("o_orderkey")).alias("shard"),
        ids.shard_name(ids.shard_of(F.col("o_orderkey"))).alias("name"), ids.shard_dir(shard).alias("dir"),
        ids.shard_path(shard).alias("path"), ids.pad_num(F.col("o_orderkey"), 4).alias("padded"),
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderkey END AS release_id,
  CASE WHEN o_orderstatus <> 'F' THEN o_orderkey * 100000 END AS num_from,
  CASE WHEN o_orderstatus <> 'F' THEN o_orderkey * 100000 + 99999 END AS num_to,
  CASE WHEN o_orderstatus = 'P' THEN 20240000 + o_custkey END AS version FROM orders""")
def release_range(spark, sf):
    key = F.col("o_orderkey")
    name = (
        F.when(F.col("o_orderstatus") == "P", F.format_string(
            "site.dump.%d.to.%d.v%d", key * 100_000, key * 100_000 + 99_999, F.col("o_custkey") + 20_240_000))
        .when(F.col("o_orderstatus") == "O", F.format_string("site.dump.%dxxxxx", key))
        .otherwise(F.format_string("site.dump.%d.to.%d", key * 100_000, key * 100_000 + 99_998))
    )
    parsed = table(spark, sf, "orders").select("o_orderkey", ids.release_range(name).alias("r"))
    return parsed.select("o_orderkey", "r.*")


@query("SELECT doc_id, replace(replace(text, chr(10), ' '), '|', '\"') AS text FROM documents")
def normalise_quotes(spark, sf):
    # typographic quotes and no-break spaces put in, then folded
    odd = F.translate("text", "'|\n", "’„ ")
    return files(spark, sf).select(
        "doc_id", F.replace(names.normalise_quotes(odd), F.lit("\n"), F.lit(" ")).alias("text")
    )


_NAME = "regexp_replace(regexp_replace(text, '[^\\x20-\\x7E]', '', 'g'), '/', '', 'g') || '.srt'"


@query(f"""
SELECT doc_id, CASE WHEN length(name) > 255 THEN substr(name, 1, 126) || '...' || right(name, 126) ELSE name END AS name
FROM (SELECT doc_id, {_NAME} AS name FROM documents)""")
def fit_filename(spark, sf):
    name = F.concat(F.regexp_replace("text", r"[^\x20-\x7E]|/", ""), F.lit(".srt"))
    return files(spark, sf).select("doc_id", names.fit_filename(name).alias("name"))


@query("""
SELECT doc_id, CASE WHEN lang = 'en' THEN source || '.sub' WHEN lang = 'de' THEN source || '.srt'
    WHEN lang = 'fr' THEN 'empty_filename.srt' ELSE source || '.ass' END AS lookup_name,
  CASE WHEN lang = 'en' THEN source || '.srt' WHEN lang = 'de' THEN source || '.dlsubc.srt'
    WHEN lang = 'fr' THEN 'empty_filename.srt' ELSE source || '.ass' END AS repaired FROM documents""")
def fix_extension(spark, sf):
    lang = F.col("lang")
    name = (
        F.when(lang == "en", F.concat("source", F.lit(".txt"))).when(lang == "de", F.concat("source", F.lit(".dlsubc")))
        .when(lang == "fr", F.lit("")).otherwise(F.concat("source", F.lit(".ass")))
    )
    fmt = F.when(lang == "es", "ssa").otherwise("srt")
    return files(spark, sf).select(
        "doc_id", names.fix_download_extension(name).alias("lookup_name"),
        names.fix_extension(name, fmt, content.is_microdvd(F.col("text"))).alias("repaired"),
    )


@query("""
SELECT p_partkey, replace(p_name, ' ', '.') || '.' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') || '.eng.srt $other $' AS path
FROM part""")
def render_path(spark, sf):
    values = {
        "video_base": F.replace("p_name", F.lit(" "), F.lit(".")), "num0": ids.pad_num(F.col("p_partkey")),
        "lang": F.lit("eng"), "ext": F.lit("srt"),
    }
    path = names.render_path("${video_base}.$num0.${lang}.$ext $other $$", values)
    return table(spark, sf, "part").select("p_partkey", path.alias("path"))


@query("""
SELECT doc_id, lang = 'en' AS framed, CASE lang WHEN 'en' THEN 'sub' WHEN 'de' THEN 'srt' WHEN 'fr' THEN 'ass' ELSE 'txt' END
  AS format FROM documents""")
def detect_format(spark, sf):
    lines = F.split("text", "\n", -1)
    framed = F.array_join(F.transform(lines, lambda x: F.concat(F.lit("{1}{25}"), x)), "\n")
    timed = F.concat(F.lit("1\n00:00:01,000 --> 00:00:02,000\n"), F.col("text"))
    styled = F.concat(F.lit("[Script Info]\n[V4+ Styles]\n"), F.col("text"))
    made = (
        F.when(F.col("lang") == "en", framed).when(F.col("lang") == "de", timed).when(F.col("lang") == "fr", styled)
        .otherwise(F.col("text"))
    )
    docs = files(spark, sf).select("doc_id", made.alias("made"))
    return docs.select(
        "doc_id", content.is_microdvd(F.col("made")).alias("framed"),
        content.detect_format(F.col("made"), F.lit("txt")).alias("format"),
    )


@query("""
SELECT doc_id, regexp_replace(text, '([\\[\\](){}?*+.^$])', '\\\\\\1', 'g') AS escaped FROM documents""")
def regex_escape(spark, sf):
    return files(spark, sf).select("doc_id", text.regex_escape(F.col("text")).alias("escaped"))


@query("""
SELECT doc_id, md5(text) AS md5, sha1(text) AS sha1, octet_length(encode(text)) AS size FROM documents""")
def checksums(spark, sf):
    sums = content.checksums(F.encode("text", "UTF-8"))
    docs = files(spark, sf).select("doc_id", sums.alias("c")).select("doc_id", "c.*")
    return docs.withColumn("size", F.col("size").cast("long"))


def _crc16_sql() -> str:
    """One byte after the other: the remainder moves up a byte, and the byte that leaves it comes back through the polynomial."""
    left = "xor(c >> 8, b)"
    folded = f"xor({left}, {left} >> 4)"
    step = f"xor(xor((c << 8) & 65535, ({folded} << 12) & 65535), xor(({folded} << 5) & 65535, {folded}))"
    return f"""
WITH d AS (SELECT doc_id, hex(encode(text)) AS h FROM documents)
SELECT doc_id, list_reduce(list_concat([CAST(0 AS BIGINT)], list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
                           lambda c, b: {step}) AS crc16 FROM d"""


@query(_crc16_sql())
def crc16(spark, sf):
    from subtlake.functions.codecs import crc16 as crc

    return files(spark, sf).select("doc_id", crc(F.encode("text", "UTF-8")).alias("crc16"))


@query("""
SELECT doc_id, text FROM documents UNION ALL SELECT -1 - doc_id, text FROM documents""")
def fix_mojibake(spark, sf):
    """Texts misread as latin1 and, as a second set, as cp437, made whole again."""
    from subtlake.functions.codecs import fix_mojibake as fix
    from subtlake.plans.archives import misread_cp437

    docs = files(spark, sf)
    latin = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    rows = docs.select("doc_id", latin.alias("odd")).unionByName(
        docs.select((-1 - F.col("doc_id")).alias("doc_id"), misread_cp437(F.encode("text", "UTF-8")).alias("odd"))
    )
    return rows.select("doc_id", fix(F.col("odd")).alias("text"))


@query("SELECT doc_id, text FROM documents")
def to_utf8(spark, sf):
    """Latin1 bytes for French, UTF-16 with a mark for German, UTF-8 otherwise."""
    from subtlake.functions.codecs import to_utf8 as recode

    data = (
        F.when(F.col("lang") == "fr", F.encode("text", "ISO-8859-1"))
        .when(F.col("lang") == "de", F.encode("text", "UTF-16")).otherwise(F.encode("text", "UTF-8"))
    )
    return files(spark, sf).select("doc_id", recode(data, "iso-8859-1").alias("text"))


@query(f"""
SELECT doc_id, len(words) AS words, len(list_distinct(words)) AS different, md5(array_to_string(words, ' ')) AS joined FROM (
  SELECT doc_id, regexp_extract_all(translate(lower(text), '{MARKED_LETTERS}', '{PLAIN_LETTERS}'),
    '([\\p{{L}}\\p{{N}}_]+)', 1) AS words FROM documents)""")
def fts_tokens(spark, sf):
    words = files(spark, sf).select("doc_id", text.fts_tokens(F.col("text")).alias("w"))
    return words.select(
        "doc_id", F.size("w").cast("long").alias("words"), F.size(F.array_distinct("w")).cast("long").alias("different"),
        F.md5(F.array_join("w", " ")).alias("joined"),
    )

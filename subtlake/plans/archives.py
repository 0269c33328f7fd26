"""Archives packed from the documents and taken apart again."""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtlake.functions.content import parse_integrity
from subtlake.operators import archive, cues
from subtlake.plans.registry import files, query, table

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@F.pandas_udf(T.StringType())
def misread_cp437(data: pd.Series) -> pd.Series:
    return data.map(lambda b: bytes(b).decode("cp437"), na_action="ignore")


def _srt(text):
    """One cue per non-empty line, two seconds each."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.trim(line) != "")
    clock = lambda s: F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("long"), F.floor(s / 60).cast("long") % 60, s % 60)
    cue = lambda line, i: F.concat(
        (i + 1).cast("string"), F.lit("\n"), clock(i.cast("long") * 3), F.lit(",250 --> "), clock(i.cast("long") * 3 + 2),
        F.lit(",750\n"), line, F.lit("\n"),
    )
    return F.array_join(F.transform(lines, cue), "\n")


_LINES = """
SELECT doc_id, ord, line FROM (
  SELECT doc_id, unnest(lines) AS line, unnest(generate_series(0, len(lines) - 1)) AS ord FROM (
    SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS lines FROM documents)
  WHERE len(lines) > 0)"""


@query(f"""
SELECT doc_id, CAST(ord AS INTEGER) AS ord, ord * 3000 + 250 AS start_ms, ord * 3000 + 2750 AS end_ms, line AS text FROM ({_LINES})""")
def explode_cues(spark, sf):
    docs = files(spark, sf).select("doc_id", _srt(F.col("text")).alias("srt"))
    return cues.explode_cues(docs, "doc_id", "srt")


@query(f"""
SELECT doc_id, CAST(ord AS INTEGER) AS ord, ord * 1000 AS start_ms, ord * 1000 + 500 AS end_ms, replace(line, '|', chr(10)) AS text FROM ({_LINES})""")
def explode_frames(spark, sf):
    """Frame-based form of the same cues at 24 frames a second."""
    lines = F.filter(F.split("text", "\n", -1), lambda line: F.trim(line) != "")
    framed = F.array_join(
        F.transform(lines, lambda line, i: F.concat(F.lit("{"), (i * 24).cast("string"), F.lit("}{"), (i * 24 + 12).cast("string"), F.lit("}"), line)), "\n"
    )
    return cues.explode_cues(files(spark, sf).select("doc_id", framed.alias("sub")), "doc_id", "sub")


def _document_archives(spark, sf):
    """One archive per document: a folder, the text and its integrity text."""
    docs = files(spark, sf)
    line = lambda label, value: F.concat(F.lit(f"Û  {label:<15}: "), value, F.lit(" Û\n"))
    nfo = F.concat(
        line("Filename", F.concat("source", F.lit(".srt"))), line("Size", F.concat(F.octet_length("text").cast("string"), F.lit(" bytes"))),
        line("MD5", F.md5(F.encode("text", "UTF-8"))), line("Format", F.lit("SRT")),
    )
    member = lambda path, data: F.struct(path.alias("path"), data.alias("content"))
    members = F.array(
        member(F.lit("dir/"), F.encode(F.lit(""), "UTF-8")),
        member(F.concat("source", F.lit(".srt")), F.encode("text", "UTF-8")),
        member(F.format_string("x.(%d).nfo", "doc_id"), F.encode(nfo, "ISO-8859-1")),
    )
    return archive.pack_archives(docs, "doc_id", members)


@query("""
SELECT doc_id AS num, 1 AS ord, source || '.srt' AS path, octet_length(encode(text)) AS size, text, false AS broken FROM documents
UNION ALL SELECT doc_id AS num, NULL, NULL, NULL, NULL, true FROM documents WHERE lang = 'es'""")
def unpack_archives(spark, sf):
    """The texts of all archives; those of Spanish documents come once more cut short, thus broken."""
    blobs = _document_archives(spark, sf)
    spanish = files(spark, sf).where(F.col("lang") == "es").select(F.col("doc_id").alias("num"))
    cut = blobs.join(spanish, "num", "left_semi").select("num", F.substring("content", 1, 40).alias("content"))
    members = archive.unpack_archives(blobs.unionByName(cut))
    texts = members.where(F.col("broken") | F.endswith("path", F.lit(".srt")))
    return texts.select("num", "ord", "path", "size", F.col("content").cast("string").alias("text"), "broken")


@query("""
SELECT doc_id AS num, 'srt' AS format, source || '.srt' AS name57, octet_length(encode(text)) AS size, md5(text) AS md5,
  true AS content_ok, true AS name_ok FROM documents""")
def archive_integrity(spark, sf):
    """Integrity records of the archives and the members they verify."""
    members = archive.unpack_archives(_document_archives(spark, sf))
    declared = archive.declared_records(members)
    texts = members.where(F.endswith("path", F.lit(".srt"))).select("num", "path", F.col("size").cast("long").alias("size"), "content")
    checked = archive.verify_members(texts, declared).select("num", "content_ok", "name_ok")
    return declared.join(checked, "num").select("num", "format", "name57", "size", "md5", "content_ok", "name_ok")


@query("""
SELECT doc_id AS num, new_path, CASE WHEN lang = 'fr' THEN 'latin ' ELSE '' END || text AS text, format FROM (
  SELECT doc_id, doc_id || '.It''s "' || source || CASE WHEN lang = 'en' THEN '".srt' ELSE '".smi' END AS new_path, text, lang,
    CASE WHEN lang = 'en' THEN 'srt' ELSE 'smi' END AS format FROM (
      SELECT doc_id, lang, source, CASE WHEN lang = 'en' THEN '1' || chr(10) || '00:00:01,000 --> 00:00:02,000' || chr(10) || text
        ELSE text END AS text FROM documents)
  UNION ALL
  SELECT doc_id, doc_id || '.It''s "' || source || '".2.smi', 'second ' || text, '', 'smi' FROM documents WHERE lang = 'de')""")
def repair_members(spark, sf):
    """Archives with typographic quotes, an equal copy, a second text of the same name for German documents, latin1
    bytes for French ones and a wrong extension, repaired; metadata says smi."""
    docs = files(spark, sf)
    lang = F.col("lang")
    timed = F.concat(F.lit("1\n00:00:01,000 --> 00:00:02,000\n"), F.col("text"))
    body = (
        F.when(lang == "en", F.encode(timed, "UTF-8"))
        .when(lang == "fr", F.encode(F.concat(F.lit("latin "), "text"), "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    )
    path = F.concat(F.lit("It’s “"), "source", F.when(lang == "en", "”.srt").otherwise("”"))
    member = lambda data: F.struct(path.alias("path"), data.alias("content"))
    second = F.when(lang == "de", F.array(member(F.encode(F.concat(F.lit("second "), "text"), "UTF-8")))).otherwise(
        F.array().cast("array<struct<path:string,content:binary>>")
    )
    blobs = archive.pack_archives(docs, "doc_id", F.concat(F.array(member(body), member(body)), second))
    meta = docs.select(F.col("doc_id").alias("num"), F.lit("smi").alias("SubFormat"))
    repaired = archive.repair_members(archive.unpack_archives(blobs), meta, fallback="iso-8859-1")
    return repaired.select("num", "new_path", "text", "format")

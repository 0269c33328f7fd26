"""Verification joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from subtlake.operators import archive
from subtlake.plans.registry import files, query, table


@query("""
SELECT doc_id AS num, source || '.srt' AS path, octet_length(encode(body)) AS size, md5(body) AS md5,
       body = text AS content_ok, body = text AND lang <> 'fr' AS name_ok
FROM (SELECT *, CASE WHEN lang = 'de' AND doc_id % 2 = 0 THEN replace(text, 'e', 'o') || '.' ELSE text END AS body FROM documents)""")
def verify_members(spark, sf):
    """Declared records were made before half of the German texts were changed, French ones under another name."""
    docs = files(spark, sf)
    changed = (F.col("lang") == "de") & (F.col("doc_id") % 2 == 0)
    now = F.when(changed, F.concat(F.replace("text", F.lit("e"), F.lit("o")), F.lit("."))).otherwise(F.col("text"))
    members = docs.select(
        F.col("doc_id").alias("num"), F.concat("source", F.lit(".srt")).alias("path"),
        F.octet_length(now).cast("long").alias("size"), F.encode(now, "UTF-8").alias("content"),
    )
    before = F.col("text")
    name = F.when(F.col("lang") == "fr", F.lit("Other name")).otherwise(F.col("source"))
    declared = docs.select(
        F.col("doc_id").alias("num"), F.octet_length(before).cast("long").alias("size"), F.md5(before).alias("md5"),
        name.alias("name57"),
    )
    checked = archive.verify_members(members, declared)
    return checked.select("num", "path", "size", "md5", "content_ok", "name_ok")


@query("""
SELECT doc_id AS num, CASE lang WHEN 'en' THEN 'srt' WHEN 'fr' THEN 'txt' ELSE 'ssa' END AS declared_format,
       CASE WHEN source < 'src5' THEN 'sub' ELSE 'srt' END AS meta_format
FROM documents
WHERE (CASE lang WHEN 'en' THEN 'srt' WHEN 'fr' THEN 'sub' ELSE 'ssa' END)
   <> (CASE WHEN source < 'src5' THEN 'sub' ELSE 'srt' END)""")
def format_mismatch(spark, sf):
    docs = files(spark, sf)
    declared = docs.select(
        F.col("doc_id").alias("num"),
        F.when(F.col("lang") == "en", "srt").when(F.col("lang") == "fr", "txt").otherwise("ssa").alias("format"),
    )
    meta = docs.select(
        F.col("doc_id").alias("num"), F.when(F.col("source") < "src5", "sub").otherwise("srt").alias("SubFormat")
    )
    return archive.format_mismatch(declared, meta)

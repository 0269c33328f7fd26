"""Secrets in texts: strong patterns, and weak parts of a credential that count only next to their complements.

Built of DataFrame functions alone. Positions are code points, from the lengths of a text's pieces between matches and of the
matches, summed along each text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subtlake.llm.common import free_names, stored

#: Strong kinds, in the order in which equal starts are listed. Matches too short are dropped after matching.
STRONG = ("assign", "access", "hex")
#: Weak parts: reported only in reach of their complements.
WEAK = ("identifier", "key_part", "endpoint")
KINDS = (*STRONG, *WEAK)

PATTERNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{14,}",
    "hex": r"[0-9a-f]{16,}",
    "identifier": r"""(?i:(?:access|client|account|user)[_-]?(?:id|key|name))["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{4,}""",
    "key_part": r"[A-Za-z0-9+/_-]{20,}={0,2}",
    "endpoint": r"""[a-z][a-z0-9+.-]{1,15}://[^\x20\x09-\x0D"'<>]+""",
}
#: A match of a kind needs this in the text: a cheap test before the pattern.
HINTS = {"access": "AKIA", "endpoint": "://"}


def _matches(text: Column, kind: str) -> Column:
    """(kind, i, gap, size, fits): code points before the i-th match since the last, its length, and whether it counts."""
    pattern = F.lit(PATTERNS[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    if kind == "assign":
        fits = F.transform(F.regexp_extract_all(text, pattern, F.lit(1)), lambda value: F.char_length(value) >= 12)
    elif kind == "key_part":
        fits = F.transform(found, lambda x: x.rlike("[0-9]") & x.rlike("[A-Z]") & x.rlike("[a-z]"))
    else:
        fits = F.transform(found, lambda x: F.lit(True))
    gaps = F.transform(F.split(text, PATTERNS[kind], -1), lambda x: F.char_length(x))
    rows = F.transform(
        F.arrays_zip(F.transform(found, lambda x: F.char_length(x)).alias("size"), fits.alias("fits")),
        lambda x, i: F.struct(F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"), F.element_at(gaps, i + 1).alias("gap"),
                              x["size"].alias("size"), x["fits"].alias("fits")))
    there = F.size(found) > 0
    if kind in HINTS:
        there = F.contains(text, F.lit(HINTS[kind])) & there
    return F.when(there, rows).otherwise(F.array().cast("array<struct<kind:int,i:int,gap:int,size:int,fits:boolean>>"))


def _rows(docs: DataFrame, text: str, key: str) -> DataFrame:
    """One row per match (one without a match for texts that have none): row, id, text_hash, kind, start, end."""
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = docs.select("row", "id", F.xxhash64("text").alias("text_hash"),
                        F.explode_outer(F.concat(*[_matches(F.col("text"), kind) for kind in KINDS])).alias("m"))
    before = Window.partitionBy("row", "m.kind").orderBy("m.i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = found.withColumn("end", F.sum(F.col("m.gap") + F.col("m.size")).over(before))
    return found.select("row", "id", "text_hash", F.col("m.kind").alias("kind"), (F.col("end") - F.col("m.size")).alias("start"), "end",
                        F.col("m.fits").alias("fits"))


def _bins(start: Column, end: Column, width: int) -> Column:
    return F.explode(F.sequence(F.floor(start / width), F.floor((end - 1) / width)))


def linked_parts(parts: DataFrame, reach: int) -> DataFrame:
    """Weak parts that have their complements within ``reach`` code points in their text: an identifier needs a secret, a key part an
    identifier, an endpoint both. A part that overlaps a strong match is no part of its own.

    An interval join: parts meet in bins of ``reach`` code points of their row, so a long text is spread over many tasks.
    """
    kind = F.col("kind")
    weak = parts.where(kind >= len(STRONG))
    near = parts.select("row", kind.alias("other"), F.col("start").alias("from"), F.col("end").alias("to"),
                        _bins(F.col("start"), F.col("end"), reach).alias("bin"))
    around = weak.select("row", "kind", "start", "end",
                         _bins(F.greatest(F.col("start") - reach, F.lit(0)), F.col("end") + reach, reach).alias("bin"))
    met = around.join(near, ["row", "bin"]).where(
        (F.col("from") < F.col("end") + reach) & (F.col("to") > F.col("start") - reach)
        & ~((F.col("other") == kind) & (F.col("from") == F.col("start"))))
    inside = (F.col("from") < F.col("end")) & (F.col("to") > F.col("start"))
    is_id = F.col("other").isin(KINDS.index("access"), KINDS.index("identifier"))
    is_secret = F.col("other").isin(KINDS.index("assign"), KINDS.index("hex"), KINDS.index("key_part"))
    flags = met.groupBy("row", "kind", "start", "end").agg(
        F.bool_or(inside & (F.col("other") < len(STRONG))).alias("covered"),
        F.bool_or(is_id & ~inside).alias("id"), F.bool_or(is_secret & ~inside).alias("secret"))
    complete = (
        F.when(kind == KINDS.index("identifier"), F.col("secret")).when(kind == KINDS.index("key_part"), F.col("id"))
        .otherwise(F.col("id") & F.col("secret")))
    return flags.where(~F.col("covered") & complete).select("row", "kind", "start", "end")


def find_secrets(docs: DataFrame, text: str = "text", key: str = "doc_id", reach: int = 200) -> DataFrame:
    """``key``, ``text_hash``, ``spans``: one row per input row, its spans as sorted (start, kind, end), ``kind`` a place in ``KINDS``.

    Strong kinds are found leftmost and without overlap, each for itself; weak parts are added where their complements lie within
    ``reach`` code points. A null text is an empty one; empty texts have an empty list. Equal rows each get a row.
    """
    # written once: the patterns run once, and a row keeps its number
    rows = stored(_rows(docs, text, key), "matches")
    shared = rows.where(F.col("fits") & F.col("kind").isNotNull())
    linked = linked_parts(shared.select("row", "kind", "start", "end"), reach)
    strong = rows.select("row", "id", "text_hash", F.when(F.col("fits") & (F.col("kind") < len(STRONG)), F.struct(
        "start", "kind", "end")).alias("span"))
    added = linked.select("row", F.lit(None).cast(rows.schema["id"].dataType).alias("id"), F.lit(None).cast("long").alias("text_hash"),
                          F.struct("start", "kind", "end").alias("span"))
    out = strong.unionAll(added).groupBy("row").agg(F.max("id").alias(key), F.max("text_hash").alias("text_hash"),
                                                    F.array_sort(F.collect_list("span")).alias("spans"))
    return out.select(key, "text_hash", "spans")


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def redact_secrets(docs: DataFrame, text: str = "text", key: str = "doc_id", reach: int = 200, mark: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs`` with each found span replaced by ``mark`` (spans that overlap: by one); all columns and rows stay.

    ``n_chars``, if there, is counted anew for changed texts. Null texts stay null.
    """
    found = find_secrets(docs, text, key, reach).where(F.size("spans") > 0)
    id_, hash_, own, spans = free_names(docs, "_id", "_hash", "_key", "_spans")
    found = found.select(F.col(key).alias(id_), F.col("text_hash").alias(hash_), F.col("spans").alias(spans)).dropDuplicates([id_, hash_])
    hashed = docs.withColumn(own, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    joined = hashed.join(found, F.col(key).eqNullSafe(F.col(id_)) & (F.col(own) == F.col(hash_)), "left")
    t = F.col(text)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    cut = F.aggregate(
        spans, start,
        lambda a, s: F.when(s["end"] <= a["at"], a).when(
            s["start"] < a["at"], F.struct(s["end"].alias("at"), a["out"].alias("out"))
        ).otherwise(F.struct(s["end"].alias("at"), F.concat(
            a["out"], F.substring(t, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit(mark)).alias("out"))),
        lambda a: F.concat(a["out"], F.substring(t, (a["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    out = joined.withColumn(text, F.when(F.col(spans).isNull(), t).otherwise(cut))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(
            F.char_length(text).cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)

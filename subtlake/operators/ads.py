"""Advertising text: find it by repetition and by keyword, turn it into patterns, remove it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from subtlake.fixed_values import AD_KEYWORDS, LONG_CUE_MS
from subtlake.functions.text import keyword_hit, regex_escape, grouped_removal_regex, split_lines


def repeated_blocks(cues: DataFrame, lang: str, sub: str, text: str = "text", more_than: int = 1) -> DataFrame:
    """(lang, text, files, occurrences) of texts found in more than ``more_than`` files of a language.

    Files are counted after a first aggregate on (language, text, file), so a line that occurs in a third
    of all files is spread over all tasks before its count comes together.
    """
    per_file = cues.groupBy(lang, text, sub).agg(F.count(F.lit(1)).alias("_n"))
    return (
        per_file.groupBy(lang, text).agg(F.count(F.lit(1)).alias("files"), F.sum("_n").alias("occurrences"))
        .where(F.col("files") > more_than)
    )


def ad_stats(samples: DataFrame) -> DataFrame:
    """Per ad text: occurrences, files, shortest and longest duration, share at the start of files."""
    per_file = samples.groupBy("txt", "sub").agg(
        F.count(F.lit(1)).alias("n"), F.min("len").alias("lo"), F.max("len").alias("hi"),
        F.count_if(F.col("pos") >= 0).alias("head"),
    )
    return per_file.groupBy("txt").agg(
        F.sum("n").alias("occurrences"), F.count(F.lit(1)).alias("files"), F.min("lo").alias("min_len"),
        F.max("hi").alias("max_len"), F.round(F.sum("head") / F.sum("n"), 6).alias("share_start"),
    )


def first_seen_text(cues: DataFrame, file_ord: str, cue_ord: str = "ord", text: str = "text") -> DataFrame:
    """First occurrence of each non-empty text over all files: (text, file_ord, cue_ord)."""
    first = F.min(F.struct(F.col(file_ord), F.col(cue_ord))).alias("_at")
    return cues.where(F.col(text) != "").groupBy(text).agg(first).select(text, "_at.*")


def ad_candidates(cues: DataFrame, file_ord: str, words: list[str] = AD_KEYWORDS,
                  duration: Column | None = None, long_ms: int = LONG_CUE_MS) -> DataFrame:
    """First occurrence of each text with its class: 1 keyword, 2 long on screen, 0 neither.

    Input is ``with_context`` output. ``context_before`` is filled for class 1; ``context_after`` names the
    class of the first-seen cue before it in the file, when this cue itself is of class 0.
    """
    long = F.coalesce(duration > long_ms, F.lit(False)) if duration is not None else F.lit(False)
    kind = F.when(keyword_hit(F.col("text"), words), 1).when(long, 2).otherwise(0)
    at = F.struct(F.col(file_ord), F.col("ord"))
    first = (
        cues.where(F.col("text") != "").withColumn("class", kind).groupBy("text")
        .agg(F.min_by(F.struct(file_ord, "ord", "class", "prev_text"), at).alias("c")).select("text", "c.*")
    )
    # the class of the first-seen cue before this one in the same file; a file's cues came from one row
    before = F.lag("class").over(W.partitionBy(file_ord).orderBy("ord"))
    return first.withColumn("_before", before).select(
        file_ord, "ord", "text", "class",
        F.when(F.col("class") == 1, F.nullif(F.col("prev_text"), F.lit(""))).alias("context_before"),
        F.when((F.col("class") == 0) & (F.col("_before") > 0), F.col("_before")).alias("context_after"),
    )


def candidates_to_patterns(candidates: DataFrame, text: str = "text") -> DataFrame:
    """Distinct candidate texts as arrays of escaped line patterns."""
    lines = F.transform(split_lines(F.col(text)), regex_escape)
    return candidates.select(text).distinct().withColumn("lines", lines)


def remove_ads(df: DataFrame, content: str, patterns: list[tuple[str, ...]], out: str | None = None) -> DataFrame:
    """Delete every match of the ordered patterns, with the closing separator, from a text column."""
    return df.withColumn(out or content, F.regexp_replace(F.col(content), F.lit(grouped_removal_regex(patterns)), F.lit("")))


def remove_ads_bytes(df: DataFrame, content: str, patterns: list[tuple[str | bytes, ...]],
                     out: str | None = None) -> DataFrame:
    """The same on raw bytes of unknown or mixed encoding: bytes are matched one to one as latin1.

    Text lines of a pattern stand for their UTF-8 bytes.
    """
    as_latin = lambda line: (line.encode("utf8") if isinstance(line, str) else line).decode("latin1")
    regex = grouped_removal_regex([tuple(map(as_latin, lines)) for lines in patterns])
    cleaned = F.regexp_replace(F.decode(F.col(content), "ISO-8859-1"), F.lit(regex), F.lit(""))
    return df.withColumn(out or content, F.encode(cleaned, "ISO-8859-1"))


def merge_samples(old: DataFrame, new: DataFrame) -> DataFrame:
    """Ad samples of both tables, each once."""
    return old.unionByName(new).distinct()


def tail_rows(samples: DataFrame, idx: str = "idx", n: int = 1000) -> DataFrame:
    """The last ``n`` inserted rows of a table with a running index."""
    highest = samples.agg(F.max(idx)).first()[0]
    return samples.where(F.col(idx) > F.lit((highest if highest is not None else 0) - n))

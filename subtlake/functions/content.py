"""Tests and extracts on the text of a subtitle file."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def checksums(content: Column) -> Column:
    return F.struct(
        F.md5(content).alias("md5"), F.sha1(content).alias("sha1"), F.octet_length(content).alias("size")
    )


def is_microdvd(text: Column) -> Column:
    """Frame-based text: every line is ``{n}{n}…`` or blank."""
    return F.forall(F.split(text, "\n", -1), lambda line: line.rlike(r"(?d)^(?:\{\d+\}\{\d+\}.*|\s*)\z"))


def detect_format(text: Column, declared: Column) -> Column:
    """Format by content, the declared one when the text shows none."""
    return (
        F.when(text.rlike(r"(?m)^\s*\d{1,2}:\d{2}:\d{2}[,.]\d{1,3}\s*-->\s*\d{1,2}:\d{2}:\d{2}[,.]\d{1,3}")
               & ~text.rlike(r"^﻿?WEBVTT"), "srt")
        .when(text.rlike(r"^﻿?WEBVTT"), "vtt")
        .when(text.rlike(r"(?m)^\{\d+\}\{\d+\}"), "sub")
        .when(text.rlike(r"(?im)^\[V4\+ Styles\]"), "ass")
        .when(text.rlike(r"(?im)^\[V4 Styles\]"), "ssa")
        .when(text.rlike(r"(?i)<SAMI>"), "smi")
        .when(text.rlike(r"(?m)^\[\d+\]\[\d+\]"), "mpl")
        .when(text.rlike(r"(?m)^\d{1,2}:\d{2}:\d{2}[:=]"), "tmp")
        .otherwise(declared)
    )


def parse_integrity(nfo: Column) -> Column:
    """Integrity text -> struct(members array<name57,size,md5>, format).

    A record is what stands up to its MD5 line, so a line that it lacks is null and not the next record's; the first Format line
    counts.
    """
    field = lambda record, label: F.nullif(
        F.rtrim(F.regexp_extract(record, rf"(?m)^Û  {label} *: (.*).{{2}}$", 1)), F.lit(""))
    close = r"(?m)^Û  MD5 *: .*$"
    records = F.arrays_zip(
        F.slice(F.split(nfo, close, -1), F.lit(1), F.size(F.regexp_extract_all(nfo, F.lit(close), F.lit(0)))).alias("above"),
        F.regexp_extract_all(nfo, F.lit(close), F.lit(0)).alias("last"))
    members = F.transform(
        records,
        lambda r: F.struct(
            F.regexp_replace(field(r["above"], "Filename"), "\\x00+$", "").alias("name57"),
            F.regexp_extract(field(r["above"], "Size"), r"^(\d+) bytes$", 1).try_cast("long").alias("size"),
            F.lower(field(r["last"], "MD5")).alias("md5"),
        ),
    )
    return F.struct(members.alias("members"), F.lower(field(nfo, "Format")).alias("format"))


def same_format(left: Column, right: Column) -> Column:
    """Declared formats agree; ``txt`` and ``sub`` are one."""
    one = lambda fmt: F.when(F.lower(fmt) == "txt", F.lit("sub")).otherwise(F.lower(fmt))
    return one(left) == one(right)


def timeless_text(text: Column) -> Column:
    """Cue text without counters, timings, markup and line layout, to compare files that differ in offset."""
    frame = (
        r"(?m)﻿|^(?:\d+[ \t]*\r?\n)?[ \t]*\d{1,2}:\d{2}:\d{2}[,.]\d{1,3}\s*-->.*$|^\{\d+\}\{\d+\}"
        r"|<[^<>]*>|\{\\[^{}]*\}"
    )
    return F.trim(F.regexp_replace(F.regexp_replace(text, frame, ""), r"\s+", " "))

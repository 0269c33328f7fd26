"""Cues of a file. They stay an array in the file's row until they are filtered, so nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtlake.fixed_values import PSEUDO_FPS
from subtlake.functions.names import bind

# Cue shapes of time-based and frame-based files.
_CLOCK = r"\d{1,3}:\d{1,2}:\d{1,2}[,.]\d{1,3}"
_TIMING = rf"{_CLOCK}\s*-->\s*{_CLOCK}"
_TIMED_TEXT = rf"(?s){_TIMING}[^\n]*\n?(.*)"
_FRAMES = r"(?s)^\{(\d+)\}\{(\d+)\}(.*)"


def cue_array(text: Column, fps: float = PSEUDO_FPS) -> Column:
    """Subtitle text -> array of struct(ord, start_ms, end_ms, text); blocks without a timing are left out."""

    def milliseconds(parts: Column, first: int) -> Column:
        number = lambda i: F.get(parts, F.lit(first + i)).cast("long")
        fraction = F.rpad(F.get(parts, F.lit(first + 3)), 3, "0").cast("long")
        return ((number(0) * 60 + number(1)) * 60 + number(2)) * 1000 + fraction

    def timed(block: Column) -> Column:
        parts = F.split(F.regexp_extract(block, _TIMING, 0), "[^0-9]+", -1)
        body = F.regexp_replace(F.regexp_extract(block, _TIMED_TEXT, 1), r"\n+\z", "")
        return bind(
            parts,
            lambda p: F.struct(
                milliseconds(p, 0).alias("start_ms"), milliseconds(p, 4).alias("end_ms"), body.alias("text")
            ),
        )

    def framed(line: Column) -> Column:
        at = lambda group: F.round(F.regexp_extract(line, _FRAMES, group).cast("double") * 1000 / fps).cast("long")
        body = F.replace(F.regexp_extract(line, _FRAMES, 3), F.lit("|"), F.lit("\n"))
        return F.struct(at(1).alias("start_ms"), at(2).alias("end_ms"), body.alias("text"))

    unix = F.regexp_replace(text, r"\r\n?", "\n")
    blocks = F.split(unix, r"\n[ \t]*(?:\n[ \t]*)+", -1)
    by_time = F.transform(F.filter(blocks, lambda b: b.rlike(_TIMING)), timed)
    by_frame = F.transform(F.filter(F.split(unix, "\n", -1), lambda line: line.rlike(_FRAMES)), framed)
    cues = F.when(text.rlike(r"(?m)^\{\d+\}\{\d+\}"), by_frame).otherwise(by_time)
    return F.transform(
        cues, lambda c, i: F.struct(i.alias("ord"), c["start_ms"], c["end_ms"], c["text"].alias("text"))
    )


def explode_cues(files: DataFrame, sub: str, text: str) -> DataFrame:
    """(sub, ord, start_ms, end_ms, text)"""
    return files.select(sub, F.inline(cue_array(F.col(text))))


def line_array(text: Column) -> Column:
    """Non-empty lines of a plain text as cues without times: struct(ord, text)."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.trim(line) != "")
    return F.transform(lines, lambda line, i: F.struct(i.alias("ord"), line.alias("text")))


def edge_index(count: Column, first: int = 30, last: int = 10) -> Column:
    """Indices of the edge cues: ``0..first-1`` and ``-last..-1``; all cues, halved, when there are fewer."""
    half = F.ceil(count / F.lit(2)).cast("int")
    head = F.when(count < first + last, half).otherwise(F.lit(first))
    tail = F.when(count < first + last, count - half).otherwise(F.lit(last))
    span = lambda start, stop: F.when(stop > start, F.sequence(start, stop - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.concat(span(F.lit(0), head), span(-tail, F.lit(0)))


def edge_cues(files: DataFrame, sub: str, cues: Column, first: int = 30, last: int = 10,
              keep: list[str] | None = None) -> DataFrame:
    """(sub, keep…, pos, cue fields…); negative ``pos`` counts from the end."""
    rows = files.select(sub, *(keep or []), cues.alias("_cues"))
    picked = F.transform(
        edge_index(F.size("_cues"), first, last),
        lambda i: F.struct(
            i.alias("pos"), F.element_at("_cues", F.when(i < 0, i).otherwise(i + 1)).alias("cue")
        ),
    )
    return rows.select(sub, *(keep or []), F.inline(picked)).select(sub, *(keep or []), "pos", "cue.*")


def with_context(files: DataFrame, sub: str, cues: Column, keep: list[str] | None = None) -> DataFrame:
    """(sub, keep…, cue fields…, prev_text, next_text); cues without text do not count as neighbours."""
    rows = files.select(sub, *(keep or []), F.filter(cues, lambda c: c["text"] != "").alias("_cues"))
    near = F.transform(
        F.col("_cues"),
        lambda c, i: F.struct(
            c.alias("cue"), F.when(i > 0, F.get("_cues", i - 1)["text"]).alias("prev_text"),
            F.get("_cues", i + 1)["text"].alias("next_text"),
        ),
    )
    return rows.select(sub, *(keep or []), F.inline(near)).select(
        sub, *(keep or []), "cue.*", "prev_text", "next_text"
    )

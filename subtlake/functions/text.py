"""Titles, tokens and cue lines."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from subtlake.fixed_values import AD_KEYWORDS, LINE_SEPARATOR, MARKED_LETTERS, PLAIN_LETTERS


def clean_title(title: Column) -> Column:
    """Title without apostrophes: Don't -> Dont."""
    return F.replace(title, F.lit("'"), F.lit(""))


def release_title(release: Column, year: Column) -> Column:
    """Release name up to the first occurrence of its year; whole when the year is unknown (0)."""
    position = F.position(year.cast("string"), release)
    return F.when((year > 0) & (position > 0), F.substring(release, F.lit(1), position - F.lit(1))).otherwise(release)


def fold_letters(text: Column) -> Column:
    """Lower case without Latin diacritics."""
    return F.translate(F.lower(text), MARKED_LETTERS, PLAIN_LETTERS)


def fts_tokens(text: Column) -> Column:
    """Words of a title in order: runs of letters, digits and underscore, folded."""
    return F.regexp_extract_all(fold_letters(text), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))


def phrase_text(text: Column) -> Column:
    """Phrase form of a query: its double quotes become spaces."""
    return F.replace(text, F.lit('"'), F.lit(" "))


def regex_escape(text: Column) -> Column:
    """Backslash before each of ``[](){}?*+.^$``, nothing else."""
    return F.regexp_replace(text, r"([\[\](){}?*+.^$])", r"\\$1")


def split_lines(text: Column) -> Column:
    r"""Lines of a cue; separators are ``\n``, ``\r\n``, ``\r``, a literal ``\N`` and ``|``."""
    return F.split(text, r"\r\n|\n|\r|\\N|\|", -1)


def keyword_hit(text: Column, words: list[str] = AD_KEYWORDS) -> Column:
    """True when any keyword occurs in the lower-cased text."""
    return F.lower(text).rlike("|".join(java_literal(word.lower()) for word in words))


def removal_regex(patterns: list[tuple[str, ...]]) -> str:
    """One alternation over patterns in their order; each also takes its closing line separator."""
    return "(?d)" + "|".join(map(_removal_body, patterns))


def grouped_removal_regex(patterns: list[tuple[str, ...]]) -> str:
    """The same alternation for long lists: neighbours that start with a plain character are tried only where
    that character stands. Patterns of different first characters exclude each other, so their order is free;
    the order within one character, and against patterns that start otherwise, stays."""
    out: list[str] = []
    run: dict[str, list[str]] = {}

    def close() -> None:
        if run:
            starts = "".join(map(java_literal, run))
            out.append(f"(?=[{starts}])(?:" + "|".join(f"(?={java_literal(c)})(?:{'|'.join(b)})" for c, b in run.items()) + ")")
            run.clear()

    for lines in patterns:
        first = lines[0]
        plain = re.match(r"[A-Za-z0-9](?![?*+{])", first) and not any(re.search(r"(?<!\\)\|", line) for line in lines)
        if plain:
            run.setdefault(first[0], []).append(_removal_body(lines))
        else:
            close()
            out.append(_removal_body(lines))
    close()
    return "(?d)" + "|".join(out)


def _removal_body(lines: tuple[str, ...]) -> str:
    return "(?:" + LINE_SEPARATOR.join(lines) + LINE_SEPARATOR[:-1] + r"|\z))"


def java_literal(text: str) -> str:
    return re.sub(r"([\\\[\](){}?*+.^$|&#~-])", r"\\\1", text)

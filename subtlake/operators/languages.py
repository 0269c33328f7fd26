"""Language codes."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtlake.fixed_values import COUNTRY_LANGUAGE, LANGUAGE_CODES


def _mapped(code: Column, table: dict[str, str]) -> Column:
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.coalesce(F.try_element_at(pairs, code), code)


def country_language(code: Column) -> Column:
    """Main language of a country code; other codes stay."""
    return _mapped(code, COUNTRY_LANGUAGE)


def three_letter(code: Column) -> Column:
    """Bibliographic three-letter code of a two-letter one; unknown codes stay."""
    return _mapped(code, LANGUAGE_CODES)


def two_letter(code: Column) -> Column:
    """Two-letter code of a country or a three-letter code; unknown codes stay."""
    return _mapped(country_language(code), {long: short for short, long in LANGUAGE_CODES.items()})


def with_languages(df: DataFrame, code: str) -> DataFrame:
    """Adds ``lang2`` and ``lang3``; an empty code is undefined (``und``) in ``lang3``."""
    lang2 = two_letter(F.col(code))
    lang3 = F.when(F.coalesce(F.col(code), F.lit("")) == "", F.lit("und")).otherwise(three_letter(lang2))
    return df.withColumn("lang2", lang2).withColumn("lang3", lang3)


def undefined_language(df: DataFrame, code: str) -> DataFrame:
    """Rows without a language code."""
    return df.where(F.coalesce(F.col(code), F.lit("")) == "")


def invalid_languages(df: DataFrame, code: str) -> DataFrame:
    """(code, ids): codes that lead to no known three-letter code, with their number of rows."""
    coded = with_languages(df.select(code), code).where(~F.col("lang3").isin(*LANGUAGE_CODES.values(), "und"))
    return coded.groupBy(code).agg(F.count(F.lit(1)).alias("ids"))

"""The metadata dump: a tab-separated text whose logical rows may span lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtlake.fixed_values import (
    DETAIL_PAGE, DUMP_COLUMNS, DUMP_PATTERNS, FREE_COLUMN, INTEGER_COLUMNS, ROWS_WITH_SURPLUS_FIELD,
)

DUMP_SCHEMA = T.StructType(
    [
        T.StructField(n, T.LongType() if n in INTEGER_COLUMNS else T.DoubleType() if n == "MovieFPS" else T.StringType())
        for n in DUMP_COLUMNS
    ]
)
_FIELDS = len(DUMP_COLUMNS)
_FREE = DUMP_COLUMNS.index(FREE_COLUMN)
_STRETCH = 50_000
_STRETCHES = 4
_PART = 16 << 20  # bytes of lines in a task
_HEADER = "\t".join(DUMP_COLUMNS)
_TIME = DUMP_COLUMNS.index("SubAddDate")
# a field more or less before the time column still makes a start: the row is judged later
_START = rf"^(?:[^\t]*\t){{{_TIME - 1},{_TIME + 1}}}{DUMP_PATTERNS['SubAddDate']}\t"
_END = rf"\t{DETAIL_PAGE}\d+/[^\t]*\z"


def read_dump_rows(spark: SparkSession, path: str) -> DataFrame:
    """Logical rows: (file, row_id, row), in ascending ``row_id`` per file; headers are left out.

    A row starts at a line that carries the time column in its place, and ends at the line whose last field is a
    detail-page address. A line opens a new row if it is a start or follows an end, so a row that has lost its
    end does not reach into the next one. Starts and ends are counted first per stretch of lines, then inside
    each stretch; so neither a large file nor an unsplittable gzip file is ordered as a whole. A row with
    start and end is put together however long it is. What lacks one of them comes out in pieces of at most four
    stretches, lines that belong to no row one by one, all to be rejected. The first line of every file must be the header.
    Lines and rows are dealt out by the bytes of the lines, as the shuffled bytes, with a file's path in each row, are packed to a tenth or less.
    """
    source = spark.read.option("lineSep", "\n").text(path)
    size = source.agg(F.sum(F.octet_length("value"))).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, size // _PART + 1)
    lines = source.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        # old line ends: \r\n loses its \r, a lone \r is a line break of its own
        F.posexplode(F.split(F.regexp_replace("value", "\r\\z", ""), "\r")).alias("sub", "line"),
    )
    marked = lines.select(
        "*", F.col("line").rlike(_START).cast("int").alias("is_start"), F.col("line").rlike(_END).cast("int").alias("is_end"),
        F.floor(F.col("pos").bitwiseAND(F.lit((1 << 33) - 1)) / F.lit(_STRETCH)).alias("stretch"),
    )
    place = ["file", "block", "stretch"]
    earlier = W.partitionBy("file").orderBy("block", "stretch").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        marked.groupBy(*place).agg(F.sum(F.col("is_start") + F.col("is_end")).alias("marks"))
        .select(*place, F.coalesce(F.sum("marks").over(earlier), F.lit(0)).alias("offset"),
                (F.count(F.lit(1)).over(earlier) == 0).alias("opens_file"))
    )
    inside = W.partitionBy(*place).orderBy("pos", "sub")
    ends = F.coalesce(F.sum("is_end").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = F.sum("is_start").over(inside.rowsBetween(W.unboundedPreceding, 0))
    numbered = (
        marked.repartition(parts, *place).withColumn("inside", ends + starts).withColumn("nth", F.row_number().over(inside)).join(offsets, place)
        .withColumn("row_id", F.col("offset") + F.col("inside"))
    )
    wrong = F.raise_error(F.concat(F.lit("unexpected first line of "), "file")).cast("boolean")
    is_header = F.when(F.col("line") == _HEADER, True).otherwise(wrong)
    body = numbered.where(F.when(F.col("opens_file") & (F.col("nth") == 1), ~is_header).otherwise(True))
    pieces = body.groupBy("file", "row_id", "block", "stretch").agg(
        F.sort_array(F.collect_list(F.struct("pos", "sub", "line"))).alias("l"),
        F.max("is_start").alias("is_start"), F.max("is_end").alias("is_end"),
    ).repartition(parts, "file", "row_id")
    row = W.partitionBy("file", "row_id")
    starts_well, ends_well = F.max("is_start").over(row) == 1, F.max("is_end").over(row) == 1
    single = F.transform("l", lambda x: x["line"])
    texts = F.when(starts_well | ends_well, F.array(F.array_join(single, "\n"))).otherwise(single)
    # of a row that lacks its start or end, a few stretches at a time; of lines that belong to no row, each one
    some = F.floor((F.row_number().over(row.orderBy("block", "stretch")) - 1) / _STRETCHES)
    texts = pieces.select(
        "file", "row_id", F.struct("block", "stretch").alias("place"), texts.alias("texts"),
        (starts_well & ends_well).alias("complete"), (starts_well | ends_well).alias("marked"), some.alias("some"),
    ).select("*", F.posexplode("texts").alias("nth", "text"))
    loose = F.when(~F.col("complete"), F.struct(F.when(F.col("marked"), F.col("some")).alias("some"),
                                                F.when(~F.col("marked"), F.struct("place", "nth")).alias("line")))
    return (
        texts.groupBy("file", "row_id", loose.alias("loose"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "text"))).alias("t"))
        .select("file", "row_id", F.array_join(F.transform("t", lambda x: x["text"]), "\n").alias("row"))
    )


def check_header(spark: SparkSession, path: str) -> None:
    """An early look at one file: its first line must be the column names. The plan checks every file."""
    first = spark.read.text(path).first()
    found = first[0].rstrip("\r") if first else None
    if found != _HEADER:
        raise ValueError(f"unexpected first line of {path}: {found!r}")


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """(file, row_id, fields): fields of each logical row, the headers left out. A wrong header ends the read."""
    check_header(spark, path)
    return split_fields(read_dump_rows(spark, path))


def split_fields(rows: DataFrame) -> DataFrame:
    """Logical rows to fields; a known row with a surplus empty field 1 loses it."""
    fields = F.split(F.regexp_replace("row", r"(?U)^\s+|\s+\z", ""), "\t", -1)
    surplus = F.get("fields", F.lit(0)).isin(*ROWS_WITH_SURPLUS_FIELD) & (F.get("fields", F.lit(1)) == "")
    fixed = F.concat(F.slice("fields", 1, 1), F.slice("fields", F.lit(3), F.size("fields")))
    return rows.withColumn("fields", fields).withColumn("fields", F.when(surplus, fixed).otherwise(F.col("fields")))


def _parsed(name: str, raw: Column) -> Column:
    if name in INTEGER_COLUMNS:
        return F.when(raw == "", F.lit(0)).otherwise(raw.try_cast("long"))
    return raw.try_cast("double") if name == "MovieFPS" else raw


def validate_columns(df: DataFrame) -> DataFrame:
    """Typed columns plus ``reason``: null for a good row, else the first column that does not fit.

    Surplus fields belong to the free-text column. Rows with too few fields have reason ``fields``. A row of several
    lines whose address names another id than the row has reason ``URL``.
    """
    size = F.size("fields")
    extra = size - _FIELDS
    raw = {}
    for index, name in enumerate(DUMP_COLUMNS):
        if index < _FREE:
            raw[name] = F.get("fields", F.lit(index))
        elif index > _FREE:
            raw[name] = F.get("fields", F.lit(index) + extra)
        else:
            joined = F.array_join(F.slice("fields", F.lit(index + 1), F.greatest(extra, F.lit(0)) + 1), "\t")
            raw[name] = F.regexp_replace(joined, r"(?U)^\s+|\s+\z", "")
    reason = F.when(extra < 0, F.lit("fields"))
    for name, pattern in DUMP_PATTERNS.items():
        fits = raw[name].rlike(rf"(?d)^(?:{pattern})\z")
        if name in INTEGER_COLUMNS:  # digits that no long holds
            fits = fits & ((raw[name] == "") | raw[name].try_cast("long").isNotNull())
        reason = reason.when(~fits, F.lit(name))
    # lines of two rows run together, when the first lost its end and the second its start
    address_id = F.regexp_extract(raw["URL"], rf"^{DETAIL_PAGE}(\d+)/", 1).try_cast("long")
    joined_rows = F.contains(raw[FREE_COLUMN], F.lit("\n")) & ~address_id.eqNullSafe(raw["IDSubtitle"].try_cast("long"))
    reason = reason.when(joined_rows, F.lit("URL"))
    kept = [c for c in df.columns if c not in ("fields",)]
    return df.select(*kept, "fields", *[_parsed(n, raw[n]).alias(n) for n in DUMP_COLUMNS], reason.alias("reason"))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows as the typed table, rejected rows as (reason, row)."""
    checked = validate_columns(df)
    good = checked.where(F.col("reason").isNull()).select("file", "row_id", *DUMP_COLUMNS)
    bad = checked.where(F.col("reason").isNotNull()).select("reason", F.array_join("fields", "\t").alias("row"))
    return good, bad

"""Archives: unpack, verify and repair members, find equal files."""

from __future__ import annotations

import io
import re
import sys
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from subtlake.functions.codecs import fix_mojibake, to_utf8
from subtlake.functions.content import detect_format, is_microdvd, parse_integrity, same_format, timeless_text
from subtlake.functions.names import extension, fit_filename, fix_extension, normalise_quotes
from subtlake.operators.numbering import number_rows
from subtlake.operators.skew import salted_join
from subtlake.session import bounded_batches, checkpointed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MEMBER_SCHEMA = "num long, ord int, path string, size long, content binary, broken boolean"
_BATCH_BYTES = 8 << 20  # a batch ends with the member that reaches them


def _members(num: int, content: bytes) -> Iterator[tuple]:
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            for order, info in enumerate(archive.infolist()):
                if not info.filename.endswith("/"):
                    yield num, order, info.filename, info.file_size, archive.read(info), False
    except Exception:  # any damage inside one archive marks that archive, not the job
        yield num, None, None, None, None, True


def _unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [part.split()[0] for part in MEMBER_SCHEMA.split(", ")]
    rows, held = [], 0

    def frame() -> pd.DataFrame:
        made = pd.DataFrame(rows, columns=columns)
        return made.astype({"ord": "Int32", "size": "Int64"})

    for batch in frames:
        for num, content in zip(batch["num"], batch["content"]):
            for row in _members(num, content):
                rows.append(row)
                held += row[3] or 0
                if held > _BATCH_BYTES:
                    yield frame()
                    rows, held = [], 0
    if rows:
        yield frame()


def unpack_archives(blobs: DataFrame, num: str = "num", content: str = "content") -> DataFrame:
    """One row per archive member, folders skipped; an archive that cannot be read gives a ``broken`` row.

    A member found before the damage stays in the result beside the ``broken`` row.
    """
    bounded_batches(blobs.sparkSession)
    return blobs.select(F.col(num).cast("long").alias("num"), F.col(content).alias("content")).mapInPandas(
        _unpack, MEMBER_SCHEMA
    )


def _ending(name: str) -> str:
    """As ``extension``: a leading dot or a dot in a folder name starts none."""
    found = re.search(r"[^/.][^/]*?(\.[^./]*)\Z", name, re.S)
    return found.group(1) if found else ""


def _choose(frames: Iterator[pd.DataFrame], skipped: tuple[str, ...]) -> Iterator[pd.DataFrame]:
    for batch in frames:
        rows, held = [], 0
        for num, content in zip(batch["num"], batch["content"]):
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    # the directory at the end tells all names and sizes; nothing is inflated for it
                    files = [info for info in archive.infolist() if not info.filename.endswith("/")]
                    wanted = next((info for info in files if _ending(info.filename) not in skipped), None)
                    if wanted is not None:
                        rows.append((num, wanted.filename, archive.read(wanted), sum(info.file_size for info in files)))
                        held += wanted.file_size
            except Exception:  # damage to the directory or the chosen member: no answer from that archive
                continue
            if held > _BATCH_BYTES:
                yield pd.DataFrame(rows, columns=["num", "path", "content", "total"])
                rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=["num", "path", "content", "total"])


def first_members(blobs: DataFrame, skipped: tuple[str, ...] = (".nfo",), num: str = "num", content: str = "content") -> DataFrame:
    """(num, path, content, total) of each archive's first member without a ``skipped`` ending, folders left out.

    Only that member is inflated; ``total`` is what all members would take. An archive without such a member, with a damaged
    directory or a damaged chosen member gives no row.
    """
    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _choose(frames, skipped)

    bounded_batches(blobs.sparkSession)
    rows = blobs.select(F.col(num).cast("long").alias("num"), F.col(content).alias("content"))
    return rows.mapInPandas(choose, "num long, path string, content binary, total long")


def _pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in frames:
        out = []
        for members in batch["members"]:
            data = io.BytesIO()
            with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
                for member in members:
                    archive.writestr(zipfile.ZipInfo(member["path"]), bytes(member["content"]))
            out.append(data.getvalue())
        yield pd.DataFrame({"num": batch["num"], "content": out})


def pack_archives(files: DataFrame, num: str, members: Column) -> DataFrame:
    """Inverse of ``unpack_archives``: an array of struct(path, content) per id -> archive bytes."""
    bounded_batches(files.sparkSession)
    return files.select(F.col(num).cast("long").alias("num"), members.alias("members")).mapInPandas(
        _pack, "num long, content binary"
    )


def verify_members(members: DataFrame, declared: DataFrame) -> DataFrame:
    """Members against declared records (num, name57, size, md5): ``content_ok`` and ``name_ok``.

    The content decides; a name only has to start with the declared, byte-cut name. A member that matches
    several records of one archive keeps one row: the one whose name fits, if any.
    """
    records = declared.select("num", "size", "md5", "name57").groupBy("num", "size", "md5").agg(
        F.collect_set("name57").alias("names")
    )
    actual = members.withColumn("md5", F.md5("content"))
    joined = actual.join(records, ["num", "size", "md5"], "left")
    fits = F.exists("names", lambda n: F.startswith(F.col("path"), n))
    return joined.select(
        "num", "path", "size", "md5", F.col("names").isNotNull().alias("content_ok"),
        F.coalesce(fits, F.lit(False)).alias("name_ok"),
    )


def declared_records(members: DataFrame) -> DataFrame:
    """Integrity records of the ``.nfo`` members: (num, format, name57, size, md5)."""
    nfo = members.where(extension(F.col("path")) == ".nfo").select(
        "num", parse_integrity(to_utf8(F.col("content"), "iso-8859-1")).alias("i")
    )
    return nfo.select("num", F.col("i.format").alias("format"), F.inline("i.members"))


def format_mismatch(declared: DataFrame, meta: DataFrame, num: str = "num", declared_format: str = "format",
                    meta_format: str = "SubFormat") -> DataFrame:
    """Archives whose declared format differs from the metadata's (``txt`` counts as ``sub``)."""
    one = declared.select(num, F.col(declared_format).alias("declared_format"))
    both = one.join(meta.select(num, F.col(meta_format).alias("meta_format")), num)
    return both.where(~same_format(F.col("declared_format"), F.col("meta_format")))


def number_duplicates(members: DataFrame, num: str = "num", path: str = "path", order: str = "ord",
                      bounded: bool = True, **options) -> DataFrame:
    """Second and later members of one name in an archive get ``.2``, ``.3`` … before their extension.

    A group lies inside one archive, which came from one row; pass ``bounded=False`` where ``num`` is no archive.
    """
    numbered = number_rows(members, [num, path], [F.col(order)], "_nth", bounded=bounded, **options)
    ext = extension(F.col(path))
    base = F.substring(F.col(path), F.lit(1), F.length(path) - F.length(ext))
    renamed = F.concat(base, F.lit("."), F.col("_nth").cast("string"), ext)
    return numbered.withColumn("new_path", F.when(F.col("_nth") > 1, renamed).otherwise(F.col(path))).drop("_nth")


def drop_equal_content(members: DataFrame, num: str = "num", path: str = "path", order: str = "ord",
                       content: str = "content", bounded: bool = True) -> DataFrame:
    """Of same-named members of an archive with equal content (size and SHA-1) the first stays.

    The members of one archive came from one row, so a window per archive is small and needs the members only
    once. With ``bounded=False`` (``num`` is no archive) the first place per content is an aggregate over small
    columns, and the rows follow by a semi-join on (num, place).
    """
    if bounded:
        equal = W.partitionBy(num, path, F.octet_length(content), F.sha1(content)).orderBy(order)
        return members.withColumn("_first", F.row_number().over(equal)).where("_first = 1").drop("_first")
    marked = members.select(num, path, order, F.octet_length(content).alias("_size"), F.sha1(content).alias("_sha1"))
    kept = marked.groupBy(num, path, "_size", "_sha1").agg(F.min(order).alias(order)).select(num, order)
    return members.join(kept, [num, order], "left_semi")


def repair_members(members: DataFrame, meta: DataFrame, num: str = "num", fallback: str = "cp1252") -> DataFrame:
    """Members with repaired names and UTF-8 text: (num, ord, path, new_path, text, format, name_len).

    Names: encoding, quotes, extension by content, id prefix, duplicates, byte limit. ``.nfo`` members and
    broken archives are left out. ``meta`` is (num, SubFormat).
    """
    files = members.where(~F.col("broken") & (extension(F.col("path")) != ".nfo"))
    # one column per step: a step used several times by the next is then computed once
    steps = {
        "text": to_utf8(F.col("content"), fallback),
        "name": normalise_quotes(fix_mojibake(F.col("path"))),
        "format": detect_format(F.col("text"), F.col("SubFormat")),
        "microdvd": is_microdvd(F.col("text")),
        "extended": fix_extension(F.col("name"), F.col("format"), F.col("microdvd")),
        "prefixed": F.concat_ws(".", F.col(num).cast("string"), F.col("extended")),
        "fitted": fit_filename(F.col("prefixed")),
        "bytes": F.encode("text", "UTF-8"),
    }
    named = files.join(meta.select(num, "SubFormat"), num, "left")
    for step, column in steps.items():
        named = named.withColumn(step, column)
    # one shuffle by archive serves both windows
    unique = drop_equal_content(named.repartition(num), num, "fitted", "ord", "bytes")
    numbered = number_duplicates(unique, num, "fitted", "ord")
    return numbered.select(num, "ord", "path", "new_path", "text", "format")


def same_text(files: DataFrame, num: str, text: Column) -> DataFrame:
    """Files with equal text apart from timing: each id with the lowest id and the size of its group.

    The text is compared by its SHA-256; groups are joined back by that hash, one row per hash. The table of
    hashes is kept by a checkpoint, so texts are read and cleaned once.
    """
    hashed = checkpointed(files.select(num, F.sha2(timeless_text(text), 256).alias("text_hash")))
    groups = hashed.groupBy("text_hash").agg(F.min(num).alias("first_num"), F.count(F.lit(1)).alias("copies"))
    copies = salted_join(
        hashed, groups.where("copies > 1"), "text_hash", counts=groups.select("text_hash", F.col("copies").alias("n"))
    )
    return copies.select(num, "first_num", "copies", "text_hash")

"""Folder listings as tables and as streams.

Spark's file sources skip files of size zero, and most marks in an inbox are empty files, so folders are listed
by tasks, one per given folder.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LISTING_SCHEMA = "path string, size long, modified_ms long"


def opened(folder: str):
    """(file system, path in it) of a folder's address."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))


def _entries(folder: str) -> Iterator[tuple[str, int, int]]:
    """Files below a folder, one folder's names at a time."""
    from pyarrow import fs

    system, path = opened(folder)
    left = [path]
    while left:
        for info in system.get_file_info(fs.FileSelector(left.pop(), allow_not_found=True)):
            if info.type == fs.FileType.Directory:
                left.append(info.path)
            elif info.type == fs.FileType.File:
                yield info.path, info.size, int((info.mtime_ns or 0) // 1_000_000)


def _listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [part.split()[0] for part in LISTING_SCHEMA.split(", ")]
    for frame in frames:
        for folder in frame["folder"]:
            entries = _entries(folder)
            while rows := list(islice(entries, 10_000)):
                yield pd.DataFrame(rows, columns=columns).astype({"size": "int64", "modified_ms": "int64"})


def list_files(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(path, size, modified_ms) of all files below the folders, empty files included."""
    named = spark.createDataFrame([(f,) for f in folders], "folder string").repartition(len(folders))
    return named.mapInPandas(_listed, LISTING_SCHEMA)


class _Slice(InputPartition):
    def __init__(self, folder: str, until: int):
        self.folder, self.until = folder, until


class _Reader(DataSourceReader):
    def __init__(self, folders: list[str]):
        self.folders = folders

    def partitions(self):
        return [_Slice(f, 1 << 62) for f in self.folders]

    def read(self, partition):
        yield from _entries(partition.folder)


class _StreamReader(DataSourceStreamReader):
    """Each batch is a whole listing; ``stream_files`` keeps what it has seen as state. Offsets only count the clock on."""

    def __init__(self, folders: list[str], settle_ms: int):
        self.folders, self.settle_ms = folders, settle_ms

    def initialOffset(self):
        return {"ms": -1}

    def latestOffset(self):
        return {"ms": int(time.time() * 1000)}

    def partitions(self, start, end):
        return [_Slice(f, end["ms"] - self.settle_ms) for f in self.folders]

    def read(self, partition):
        # files changed right now may still be written to; a later listing has them
        for path, size, modified in _entries(partition.folder):
            if modified <= partition.until:
                yield path, size, modified


class FolderListing(DataSource):
    """Data source ``folder_listing``; option ``folders`` (separated by newlines), ``settleMs``."""

    @classmethod
    def name(cls):
        return "folder_listing"

    def schema(self):
        return LISTING_SCHEMA

    def _folders(self):
        return self.options["folders"].split("\n")

    def reader(self, schema):
        return _Reader(self._folders())

    def streamReader(self, schema):
        return _StreamReader(self._folders(), int(self.options.get("settlems", "1000")))


def stream_files(spark: SparkSession, folders: list[str], settle_ms: int = 1000) -> DataFrame:
    """New and changed files of the folders as a stream, empty files included.

    Names, sizes and times seen are kept as state, so a file counts whatever its time says: one moved in with an old
    time, or written under a clock that runs behind, is as new as any other.
    """
    spark.dataSource.register(FolderListing)
    listing = (
        spark.readStream.format("folder_listing").option("folders", "\n".join(folders))
        .option("settleMs", str(settle_ms)).load()
    )
    return listing.dropDuplicates(["path", "size", "modified_ms"])

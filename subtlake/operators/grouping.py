"""Groups of archives: by catalogue id, by title, by count and by size."""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtlake.fixed_values import MAX_CATALOGUE_ID
from subtlake.functions.ids import bucket_of
from subtlake.operators.numbering import id_lists, number_by_id
from subtlake.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def valid_catalogue_ids(meta: DataFrame, catalogue_id: str, highest: int = MAX_CATALOGUE_ID) -> DataFrame:
    """Rows whose id is above 0 and not above ``highest``; others are no catalogue ids."""
    return meta.where((F.col(catalogue_id) > 0) & (F.col(catalogue_id) <= highest))


def group_by_catalogue_id(meta: DataFrame, catalogue_id: str, num: str = "num", bucket: int = 100_000,
                          highest: int = MAX_CATALOGUE_ID) -> DataFrame:
    """(catalogue_id, part, members, group_len, group_name) of the valid catalogue ids."""
    valid = valid_catalogue_ids(meta, catalogue_id, highest)
    return id_lists(valid, [catalogue_id], num, bucket=bucket).withColumn(
        "group_name", F.format_string("imdb-%d-len-%d", catalogue_id, "group_len")
    )


def group_by_title(meta: DataFrame, title: str, year: str, lang: str, num: str = "num",
                   bucket: int = 100_000) -> DataFrame:
    """(title, year, lang, part, members, group_len, group_name); pass one kind of rows."""
    named = F.concat_ws(".", F.replace(F.col(title), F.lit(" "), F.lit(".")), F.col(year).cast("string"), F.col(lang))
    return id_lists(meta, [title, year, lang], num, bucket=bucket).withColumn("group_name", named)


def group_index(rows: DataFrame, lang: str, title: str, year: str, num: str, entry: Column,
                bucket: int = 100_000) -> DataFrame:
    """(lang, name, part, entries, group_len): entries of each "title (year)" as a JSON list in id order."""
    named = rows.withColumn("name", F.concat(F.col(title), F.lit(" ("), F.col(year).cast("string"), F.lit(")")))
    lists = id_lists(named, [lang, "name"], num, entry, bucket)
    return lists.withColumn("entries", F.to_json("members")).drop("members")


def title_buckets(titles: DataFrame, title: str) -> DataFrame:
    """Rows and distinct titles in each of 2^16 buckets of the title's MD5."""
    bucket = F.conv(F.substring(F.md5(F.col(title)), 1, 4), 16, 10).cast("long")
    return titles.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(title).alias("titles")
    )


def chunk_by_count(meta: DataFrame, lang: str, num: str = "num", size: int = 1000,
                   bucket: int = 100_000) -> DataFrame:
    """Each id with its chunk: ``size`` ids of a language in ascending order, named ``first-last``."""
    numbered = number_by_id(meta.select(lang, num), [lang], num, "_rn", bucket)
    chunked = numbered.withColumn("chunk", bucket_of(F.col("_rn") - 1, size))
    return (
        chunked.groupBy(lang, "chunk")
        .agg(F.min(num).alias("first_num"), F.max(num).alias("last_num"), F.count(F.lit(1)).alias("ids"))
        .withColumn("chunk_name", F.concat_ws("-", "first_num", "last_num"))
    )


def files_to_pack(files: DataFrame, num: str, size: str, first: int | None = None) -> DataFrame:
    """Files that are not empty, from the id ``first`` on, where an earlier run ended."""
    kept = files.where(F.col(size) > 0)
    return kept if first is None else kept.where(F.col(num) >= first)


# Sequential packing is a chain: where a pack ends depends on where it began. The state between two rows is one number, the
# threshold: the pack ends before the first row whose running size reaches it. What a stretch of rows does to the threshold is
# a step function, so stretches are turned into functions at the same time, the functions are composed in a tree, and the
# thresholds come back down the tree to every stretch.

def _steps(sizes: np.ndarray, limit: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """A stretch as a function: its total, and (breaks, after, packs).

    A threshold in (breaks[i - 1], breaks[i]], counted from the start of the stretch, lets ``packs[i]`` packs begin in it and
    leaves the threshold ``after[i]``; one beyond the total passes through. No threshold exceeds ``limit`` at the start, so only
    the rows up to there have an entry.
    """
    running = np.cumsum(sizes)
    before = running - sizes
    following = np.maximum(np.searchsorted(running, before + limit, side="left"), np.arange(len(sizes)) + 1)
    after, packs = before + limit, np.ones(len(sizes), np.int64)
    # pointers are doubled until each row's chain has left the stretch
    last = following >= len(sizes)
    to = np.where(last, np.arange(len(sizes)), following)
    packs[last] = 0
    while True:
        further = to[to]
        if (further == to).all():
            break
        packs, to = packs + packs[to], further
    entry = before < limit
    return int(running[-1]), running[entry], after[to][entry], packs[entry] + 1


def _through(function: tuple, threshold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(threshold behind the stretch, packs begun in it) for thresholds at its start."""
    total, breaks, after, packs = function
    at = np.minimum(np.searchsorted(breaks, threshold, side="left"), len(breaks) - 1)
    passes = threshold > total
    return np.where(passes, threshold, after[at]) - total, np.where(passes, 0, packs[at])


def _compose(parts: list[tuple], limit: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring stretches as one."""
    starts = np.concatenate([[0], np.cumsum([p[0] for p in parts])])
    breaks = np.concatenate([p[1] + s for p, s in zip(parts, starts)])
    breaks = breaks[np.concatenate([[True], breaks[:-1] < limit])]
    threshold, packs = breaks.copy(), np.zeros(len(breaks), np.int64)
    for part in parts:
        threshold, more = _through(part, threshold)
        packs = packs + more
    after = threshold + starts[-1]
    # neighbouring entries that leave alike are one
    differ = np.concatenate([(after[1:] != after[:-1]) | (packs[1:] != packs[:-1]), [True]])
    return int(starts[-1]), breaks[differ], after[differ], packs[differ]


def _functions(table: pa.Table) -> list[tuple]:
    rows = table.select(["total", "breaks", "after", "packs"]).to_pylist()
    return [(r["total"], *(np.array(r[c], np.int64) for c in ("breaks", "after", "packs"))) for r in rows]


def _enter(parts: pa.Table, keys: list[str], threshold: int, packs: int) -> pa.Table:
    """The state at the start of each of neighbouring stretches, from the state at the first."""
    parts = parts.sort_by("b")
    at, begun = [], []
    for part in _functions(parts):
        at.append(threshold)
        begun.append(packs)
        after, more = _through(part, np.array([threshold]))
        threshold, packs = int(after[0]), packs + int(more[0])
    return parts.select([*keys, "b"]).append_column("threshold", pa.array(at, pa.int64())).append_column("packs", pa.array(begun, pa.int64()))


def pack_by_size(files: DataFrame, keys: list[str], num: str, size: str, max_size: int, tolerance: float = 0.02,
                 first: int | None = None, bucket: int = 100_000, fan: int = 16) -> DataFrame:
    """Sequential fill of packs below ``max_size * (1 - tolerance)``, in id order through all ids of each key.

    Columns: keys, ``num``, ``size``, ``pack`` (from 0, per key). Empty files, null ids and those below the id ``first``, where an
    earlier run ended, are left out; a file over the limit is a pack of its own; equal ids go by size. A task holds the ids and
    sizes of one bucket of ``bucket`` ids, or the functions of ``fan`` neighbouring buckets (see above), whose entries are the
    rows of one pack's length; the tree has ``log(buckets, fan)`` levels.
    """
    limit = math.ceil(max_size * (1 - tolerance))
    g = [f"g{i}" for i in range(len(keys))]
    group = [F.col(k).alias(x) for k, x in zip(keys, g)]
    rows = files_to_pack(files, num, size, first).where(F.col(num).isNotNull())
    rows = rows.select(*group, bucket_of(F.col(num), bucket).alias("b"), F.col(num).alias("id"), F.col(size).cast("long").alias("size"))
    kind = "".join(f"{x} {rows.schema[x].dataType.simpleString()}, " for x in g)
    function = kind + "b long, total long, breaks array<long>, after array<long>, packs array<long>"
    state = kind + "b long, threshold long, packs long"

    def step_rows(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending"), ("size", "ascending")])
        return row(key, _steps(table.column("size").to_numpy(), limit))

    def compose_rows(key: tuple, table: pa.Table) -> pa.Table:
        return row(key, _compose(_functions(table.sort_by("b")), limit))

    def row(key: tuple, found: tuple) -> pa.Table:
        lists = [pa.array([x], pa.list_(pa.int64())) for x in found[1:]]
        return pa.table([*[pa.array([x.as_py()], x.type) for x in key], pa.array([found[0]], pa.int64()), *lists],
                        [*g, "b", "total", "breaks", "after", "packs"])

    def descend(key: tuple, parts: pa.Table, parent: pa.Table) -> pa.Table:
        return _enter(parts, g, parent.column("threshold")[0].as_py(), parent.column("packs")[0].as_py())

    def assign(key: tuple, table: pa.Table, entered: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending"), ("size", "ascending")])
        sizes = table.column("size").to_numpy()
        running = np.cumsum(sizes)
        begins = np.zeros(len(sizes), np.int64)
        threshold = entered.column("threshold")[0].as_py()
        while (at := int(np.searchsorted(running, threshold, side="left"))) < len(sizes):
            begins[at] = 1
            threshold = max(int(running[at] - sizes[at]) + limit, int(running[at]) + 1)
        pack = entered.column("packs")[0].as_py() + np.cumsum(begins) - 1
        return table.select([*g, "id", "size"]).append_column("pack", pa.array(pack, pa.int64()))

    folder = scratch_path(files.sparkSession, "packs")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")

    levels = [kept(rows.groupBy(*g, "b").applyInArrow(step_rows, function), "0")]
    ends = levels[0].agg(F.min("b").alias("low"), F.max("b").alias("high")).first()
    low, high = ends["low"], ends["high"]
    while low != high:
        parent = levels[-1].withColumn("parent", F.floor(F.col("b") / fan).cast("long"))
        levels.append(kept(parent.groupBy(*g, "parent").applyInArrow(compose_rows, function), str(len(levels))))
        low, high = low // fan, high // fan
        if (low, high) == (-1, 0):
            break  # the two sides of id 0: both are below the root
    # before the first row any threshold up to its size will do; below an id of 0 lies a second tree
    states = levels[-1].groupBy(*g).applyInArrow(lambda roots: _enter(roots, g, 1, 0), state)
    for level in reversed(levels[:-1]):
        parts = level.withColumn("parent", F.floor(F.col("b") / fan).cast("long"))
        above = states.withColumnRenamed("b", "parent")
        states = parts.groupBy(*g, "parent").cogroup(above.groupBy(*g, "parent")).applyInArrow(descend, state)
    entered = kept(states, "states")
    packed = rows.groupBy(*g, "b").cogroup(entered.groupBy(*g, "b")).applyInArrow(assign, kind + "id long, size long, pack long")
    return packed.select(*[F.col(x).alias(k) for k, x in zip(keys, g)], F.col("id").alias(num), F.col("size").alias(size), "pack")

"""Near copies by SimHash: fingerprints of 64 bits that differ in few bits.

Candidates come from deletion variants. ``differing`` bits spread over ``differing // 2 + 1`` segments leave one segment in which at
most one bit differs, so every segment is indexed once per bit position with that bit left out: two segments that differ by at most
one bit have a variant in common. Fingerprints meet in an equality join on the variant and are verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtlake.llm.common import components, first_rows, stored, text_digest
from subtlake.llm.tokens import bounded_batches, scan, slices
from subtlake.session import checkpointed, shuffle_partitions

BITS = 64
CELLS = 1 << 16  # for finding hot variants


def _fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if set in over half of the hashes."""
    ones = np.zeros(BITS, np.int64)
    for begin in range(0, len(hashes), 1 << 16):
        part = hashes[begin:begin + (1 << 16)]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """The columns of ``docs`` but the text, and ``fp`` (long): words are runs of anything but blank and U+0009 to U+000D, A-Z in lower case.

    Shingles of ``shingle`` words joined by one blank, repeats included, are hashed by XXH64; fewer words make one shingle, none
    (empty or null text) the fingerprint zero.
    """
    bounded_batches(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name != text]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "fp long"])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            for part in slices(batch, text):
                words = scan(part.column(text), lower=True)
                plain, first = words.plain, words.first
                inner = np.diff(first) >= shingle
                start = words.start[:max(0, len(words.start) - shingle + 1)].tolist()
                end = words.end[shingle - 1:].tolist()
                hashes = np.fromiter((digest(plain[a:b], seed) for a, b in zip(start, end)), np.uint64, len(end))
                out = np.zeros(len(part), np.uint64)
                for i in np.flatnonzero(inner).tolist():
                    out[i] = _fingerprint(hashes[first[i]:first[i + 1] - shingle + 1])
                for i in np.flatnonzero(~inner & (np.diff(first) > 0)).tolist():
                    out[i] = digest(plain[words.start[first[i]]:words.end[first[i + 1] - 1]], seed)
                yield pa.RecordBatch.from_arrays([*[part.column(f.name) for f in kept], pa.array(out.view(np.int64))],
                                                 [*[f.name for f in kept], "fp"])

    return docs.mapInArrow(sign, schema)


def segments(differing: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the segments: as few as leave one with at most one differing bit."""
    n = differing // 2 + 1
    edges = [round(i * BITS / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _variants(fp: Column, differing: int) -> Column:
    """One key for each segment and left-out bit: the number of that bit on top, the other bits of the segment below."""
    keys = []
    for low, width in segments(differing):
        part = F.shiftrightunsigned(fp, low).bitwiseAND((1 << width) - 1)
        for bit in range(width):
            keys.append(part.bitwiseAND(((1 << width) - 1) ^ (1 << bit)).bitwiseOR(F.lit((low + bit) << 32)))
    return F.array(*keys)


def _first_key(x: np.ndarray, differing: int) -> np.ndarray:
    """For each difference of two fingerprints, the left-out bit under which the pair counts: it has others, too."""
    out = np.full(len(x), -1)
    for low, width in reversed(segments(differing)):
        part = (x >> np.uint64(low)) & np.uint64((1 << width) - 1)
        one = np.bitwise_count(part) <= 1
        bit = np.zeros(len(x), np.int64)
        lit = one & (part > 0)
        bit[lit] = np.log2(part[lit].astype(np.float64)).astype(np.int64)
        out[one] = low + bit[one]
    return out


def _forest(values: np.ndarray, differing: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what chains of near fingerprints connect, one less than members of a chain at most."""
    left, a, b = np.arange(len(values)), [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(values[left] ^ values[at]) <= differing
            if near.any():
                found = left[near]
                a.append(np.full(len(found), values[at]))
                b.append(values[found])
                queue.extend(found.tolist())
                left = left[~near]
    return (np.concatenate(a), np.concatenate(b)) if a else (values[:0], values[:0])


def links(distinct: DataFrame, differing: int = 4, most: int = 1 << 16) -> DataFrame:
    """``a``, ``b``: links between the different fingerprints ``fp`` that connect all chains of at most ``differing`` bits a step.

    Buckets of a variant are worked on in sorted order. Small buckets give each near pair, under one of its variants; a larger one
    gives a spanning forest of its near pairs, so no group emits all its pairs. A variant with more than ``most`` members is dealt
    out: its members are hashed into parts, and each two parts meet in a task of their own.
    """
    # a fingerprint is few bytes and many variants, so the number of tasks is set and not left to their size; dealt by a
    # hash, since a partitioning by fp itself is there already and would be kept with its merged tasks
    distinct = distinct.select("fp").repartition(shuffle_partitions(distinct), F.xxhash64("fp"))
    keyed = distinct.select("fp", F.explode(_variants(F.col("fp"), differing)).alias("key"))
    # hot variants: by cells of a fixed number first, then by key inside the full cells
    cell = F.pmod(F.xxhash64("key"), F.lit(CELLS)).cast("int")
    full = keyed.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("cell")
    hot = (
        keyed.withColumn("cell", cell).join(F.broadcast(full), "cell", "left_semi")
        .groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
        .select("key", F.ceil(F.col("n") * 2 / most).cast("int").alias("parts"))
    )
    hot = checkpointed(hot)
    if hot.isEmpty():
        dealt = keyed.select("key", "fp", F.lit(0).alias("deal"))
    else:
        own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
        dealt = (
            keyed.join(hot, "key", "left").select("key", "fp", F.coalesce("parts", F.lit(1)).alias("parts"))
            .select("key", "fp", "parts", F.coalesce(own, F.lit(0)).alias("own"))
            .select("key", "fp", "parts", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
            .select("key", "fp", (F.least("own", "other") * F.col("parts") + F.greatest("own", "other")).alias("deal"))
        )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, deals, fps = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column("key").to_numpy()])
            deals = np.concatenate([deals, batch.column("deal").to_numpy()])
            fps = np.concatenate([fps, batch.column("fp").to_numpy().view(np.uint64)])
            if not len(keys):
                continue
            # the last bucket may go on in the next batch
            tail = len(keys) - 1
            while tail and keys[tail - 1] == keys[-1] and deals[tail - 1] == deals[-1]:
                tail -= 1
            if tail:
                yield from linked(keys[:tail], deals[:tail], fps[:tail])
                keys, deals, fps = keys[tail:], deals[tail:], fps[tail:]
        if len(keys):
            yield from linked(keys, deals, fps)

    def linked(keys: np.ndarray, deals: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (deals[1:] != deals[:-1])
        opens = np.flatnonzero(new)
        sizes = np.diff(np.append(opens, len(keys)))
        left, right = [], []
        bucket = np.cumsum(new)
        few = sizes[bucket - 1] <= 16
        for step in range(1, 16):
            i = np.flatnonzero((bucket[step:] == bucket[:-step]) & few[step:])
            if not len(i):
                break
            x = fps[i] ^ fps[i + step]
            near = np.bitwise_count(x) <= differing
            i, x = i[near], x[near]
            i = i[_first_key(x, differing) == keys[i] >> 32]
            left.append(fps[i])
            right.append(fps[i + step])
        for o, n in zip(opens[sizes > 16].tolist(), sizes[sizes > 16].tolist()):
            a, b = _forest(fps[o:o + n], differing)
            left.append(a)
            right.append(b)
        if left and sum(map(len, left)):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (left, right)], ["a", "b"])

    return dealt.repartition("key", "deal").sortWithinPartitions("key", "deal").mapInArrow(join, "a long, b long")


def near_copies(docs: DataFrame, text: str = "text", key: str = "doc_id", differing: int = 4, shingle: int = 4) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits), ``component`` (a fingerprint that names the group), ``component_id`` (smallest ``key``
    of the group): one row per input row.

    Rows link if their fingerprints differ in at most ``differing`` bits; groups are what chains of links reach. Empty and null
    texts share the fingerprint zero and link like any other. Null keys are passed over when the smallest is taken (null if the
    group has no other). Other columns of ``docs`` are not read.
    """
    out = _grouped(docs, text, key, differing, shingle)
    return out.select(F.col("id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component",
                      F.col("low").alias("component_id"))


def _grouped(docs: DataFrame, text: str, key: str, differing: int = 4, shingle: int = 4) -> DataFrame:
    """``id``, ``text_hash``, ``fp``, ``component``, ``low``: one row per input row."""
    signed = checkpointed(fingerprints(docs.select(F.col(key).alias("id"), text_digest(text).alias("text_hash"), F.col(text).alias("text")), "text", shingle))
    own = signed.groupBy("fp").agg(F.min("id").alias("low"))
    groups = components(links(own.select("fp"), differing), "a", "b")
    named = own.join(groups, own["fp"] == groups["node"], "left").select("fp", "low", F.coalesce("component", "fp").alias("component"))
    lowest = stored(named.groupBy("component").agg(F.min("low").alias("low")), "groups")
    named = named.select("fp", "component").join(lowest, "component")
    return signed.join(named, "fp")


def drop_near_copies(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The row of ``docs`` with the smallest key (null last, then the smallest hash of the text) of each group; all columns stay.

    Rows that repeat a key and a text stay once.
    """
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("first")
    rows = _grouped(docs, text, key, **options)
    kept = rows.groupBy("component").agg(first).select(F.col("first.id").alias("_id"), F.col("first.text_hash").alias("_hash"))
    return first_rows(docs, text, key, kept, rows.select("id", F.col("text_hash").alias("hash")))

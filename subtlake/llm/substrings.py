"""Repeated word spans across a corpus, over a compacted De Bruijn graph.

Edges of the graph are windows of ``k`` words, nodes the ``k - 1`` words that two neighbouring windows share. Edges are never
written one by one: all windows of a text that have the same smallest short gram (their *anchor*) form one piece of a path,
identified by anchor and a digest of its words at its source coordinates. Equal windows always have equal anchors, so counting per
anchor decides what can repeat at all:

* an anchor met once: nothing repeats there;
* all its pieces are equal (no branch): they are repeated as a whole, and pieces that follow each other join to one path;
* its pieces differ (a branch): those met more than once are repeated as a whole, the others are opened into their edges, and
  joined edge by edge.

Paths are then brought back to the source coordinates, where the spans are cut out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtlake.llm.common import bit_filter, passes, stored
from subtlake.llm.tokens import bounded_batches, gram_hashes, grams_inside, scan, slices, word_hashes, Words


def path_pieces(words: Words, k: int, anchor: int):
    """Pieces of paths: first window (by its first word), number of windows, anchor hash, digest; and the window hashes."""
    inside = np.flatnonzero(grams_inside(words, k))
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    hashes = word_hashes(words)
    short = gram_hashes(hashes, anchor)
    # leftmost smallest short gram of each window, by doubling
    width, best, size = k - anchor + 1, np.arange(len(short)), 1
    while size * 2 <= width:
        best = _smaller(short, best[:len(best) - size], best[size:])
        size *= 2
    many = len(short) - width + 1
    best = _smaller(short, best[:many], best[width - size:width - size + many])
    at = best[inside]
    new = np.ones(len(inside), bool)
    new[1:] = (at[1:] != at[:-1]) | (inside[1:] != inside[:-1] + 1)
    opens = np.flatnonzero(new)
    first, count = inside[opens], np.diff(np.append(opens, len(inside)))
    begin, stop = words.start[first].tolist(), words.end[first + count + k - 2].tolist()
    plain, digest = words.plain, xxhash.xxh3_64_intdigest
    digests = np.fromiter((digest(plain[b:e]) for b, e in zip(begin, stop)), np.uint64, len(begin))
    return first, count, short[at[opens]], digests, gram_hashes(hashes, k)


def _smaller(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.where(values[a] <= values[b], a, b)


def repeated_spans(docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",), k: int = 35, anchor: int = 8,
                   filter_bits: int = 26) -> DataFrame:
    """All windows of ``k`` words that start in more than one place: ``keys``, ``text_hash``, ``spans``.

    ``spans`` is a list of (first word, windows, mask): windows in sequence from that word on, of which those repeat whose bit is
    set in ``mask`` (null: all). One row per document that has any; documents with equal keys and equal text share a row. A null
    text, an empty one and one of fewer than ``k`` words have no window. ``filter_bits`` sets the size of two filters that only
    save work.
    """
    anchor = min(max(anchor, k - 63), k)  # a piece has up to k - anchor + 1 windows, and its mask 64 bits
    bounded_batches(docs.sparkSession)
    docs = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)], F.col(text).alias("text"),
                       F.xxhash64(text).alias("h"))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                _, _, anchored, digests, _ = path_pieces(scan(part.column("text")), k, anchor)
                yield pa.RecordBatch.from_arrays([pa.array(anchored.view(np.int64)), pa.array(digests.view(np.int64))],
                                                 ["anchor", "digest"])

    met = docs.select("text").mapInArrow(anchors, "anchor long, digest long").groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"))
    met = stored(met.where("n > 1"), "anchors")
    shared, branching = bit_filter(met, "anchor", filter_bits), bit_filter(met.where("low <> high"), "anchor", filter_bits)
    fields = [f for f in docs.schema.fields if f.name not in ("text", "h")]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in fields]
                       + ["h long, first int, windows int, anchor long, digest long, edges array<long>"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = scan(part.column("text"))
                first, count, anchored, digests, edges = path_pieces(words, k, anchor)
                may = passes(shared.value, anchored)
                first, count, anchored, digests = first[may], count[may], anchored[may], digests[may]
                if not len(first):
                    continue
                row = np.searchsorted(words.first, first, "right") - 1
                opened = passes(branching.value, anchored)
                sizes = np.where(opened, count, 0)
                ends = np.cumsum(sizes)
                which = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes) + np.repeat(first, sizes)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(edges[which].view(np.int64)),
                                                 mask=pa.array(~opened))
                # ids only: a long text has thousands of pieces and must not be repeated for each
                taken = part.select([*[f.name for f in fields], "h"]).take(pa.array(row))
                columns = taken.columns
                columns += [pa.array((first - words.first[row]).astype(np.int32)), pa.array(count.astype(np.int32)),
                            pa.array(anchored.view(np.int64)), pa.array(digests.view(np.int64)), lists]
                yield pa.RecordBatch.from_arrays(columns, [*[f.name for f in fields], "h", "first", "windows", "anchor", "digest", "edges"])

    found = stored(docs.mapInArrow(pieces, schema), "pieces")
    ids = [*[f.name for f in fields], "h"]
    place = [*ids, "first", "windows"]
    # without a branch: equal pieces, repeated if the anchor was met twice
    straight = found.where("edges is null").select(*place, "anchor")
    whole = straight.join(met.select("anchor"), "anchor").select(*place, F.lit(None).cast("long").alias("mask"))
    # branches: pieces met more than once, and the edges of the others
    branched = found.where("edges is not null")
    counts = branched.groupBy("anchor", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor", "digest", F.lit(True).alias("twice"))
    branched = branched.join(stored(counts, "branches"), ["anchor", "digest"], "left")
    again = branched.where("twice").select(*place, F.lit(None).cast("long").alias("mask"))
    edge_counts = (
        found.where("edges is not null").select("anchor", F.explode("edges").alias("edge"))
        .groupBy("anchor", "edge").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("anchor", "edge")
    )
    single = branched.where("twice is null").select(*place, "anchor", F.posexplode("edges").alias("bit", "edge"))
    opened = (
        single.join(stored(edge_counts, "edges"), ["anchor", "edge"]).groupBy(*place)
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))
    )
    spans = whole.unionAll(again).unionAll(opened.select(*place, "mask"))
    spans = spans.groupBy(*ids).agg(F.collect_set(F.struct("first", "windows", "mask")).alias("spans"))
    return spans.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keys)], F.col("h").alias("text_hash"), "spans")


def cover(spans: list[dict], n_words: int, k: int) -> np.ndarray:
    """Which words a repeated window covers; neighbouring spans join to one path."""
    steps = np.zeros(n_words + 1, np.int64)
    for s in spans:
        first, windows, mask = s["first"], s["windows"], s["mask"]
        if mask is None:
            steps[first] += 1
            steps[first + windows + k - 1] -= 1
            continue
        bits = [i for i in range(windows) if mask >> i & 1]
        for i in bits:
            steps[first + i] += 1
            steps[first + i + k] -= 1
    return np.cumsum(steps[:-1]) > 0


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = 35, **options) -> DataFrame:
    """Documents without the words of repeated windows: ``key``, ``kept_text``, ``n_words``, ``n_removed``.

    Words are runs of anything but blank and U+0009 to U+000D, kept unchanged and joined by one blank. One row per input row; a null
    or empty text gives an empty one.
    """
    spans = repeated_spans(docs, text, (key,), k, **options)
    docs = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.xxhash64(text).alias("h"))
    spans = spans.select(F.col(key).alias("other"), F.col("text_hash"), "spans")
    joined = docs.join(spans, F.col("id").eqNullSafe(F.col("other")) & (F.col("h") == F.col("text_hash")), "left")
    key_type = docs.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = scan(part.column("text"))
                kept, total, removed = [], [], []
                for i, spans in enumerate(part.column("spans").to_pylist()):
                    low, high = int(words.first[i]), int(words.first[i + 1])
                    total.append(high - low)
                    if not spans:
                        kept.append(words.plain[words.start[low]:words.end[high - 1]] if high > low else b"")
                        removed.append(0)
                        continue
                    gone = cover(spans, high - low, k)
                    left = np.flatnonzero(~gone) + low
                    kept.append(b" ".join([words.plain[a:b] for a, b in zip(words.start[left].tolist(), words.end[left].tolist())]))
                    removed.append(int(gone.sum()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([x.decode() for x in kept], pa.string()), pa.array(total, pa.int64()),
                     pa.array(removed, pa.int64())], ["id", "kept_text", "n_words", "n_removed"])

    out = joined.select("id", "text", "spans").mapInArrow(cut, f"id {key_type}, kept_text string, n_words long, n_removed long")
    return out.withColumnRenamed("id", key)

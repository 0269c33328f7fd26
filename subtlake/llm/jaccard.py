"""Near copies by Jaccard similarity of word shingles, found without loss by prefixes.

The shingles of every text are put into one order for all texts, seldom ones first. Two texts of the asked similarity share a shingle
among the first few of both, so only texts that meet there are compared. In rounds, each bucket of a shingle is compared with one of
its members, the one that meets most texts (of a group of near copies, the text they were made from), and connected texts count as one;
after that, pairs that are still not connected are compared, so a large group of near copies never makes all its pairs. The order
comes from counts in cells of a fixed number; it decides how much work there is, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtlake.llm.common import bit_filter, components, first_rows, passes, stored, text_digest
from subtlake.llm.tokens import bounded_batches, scan, slices

CELLS = 1 << 20
BLOCK = 1 << 10  # cells that are added up together


def _shingles(texts: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """The different shingle hashes of each text, as in ``simhash.fingerprints``; a text without words has the hash of nothing."""
    digest = xxhash.xxh64_intdigest
    words = scan(texts, lower=True)
    plain, first, start, end = words.plain, words.first.tolist(), words.start.tolist(), words.end.tolist()
    for a, b in zip(first, first[1:]):
        n = max(1, b - a - shingle + 1)
        if a == b:
            yield np.array([digest(b"", 42)], np.uint64)
        else:
            ends = end[a + shingle - 1:b] if b - a > shingle else [end[b - 1]]
            yield np.unique(np.fromiter((digest(plain[x:y], 42) for x, y in zip(start[a:a + n], ends)), np.uint64, n))


def _different(rows: DataFrame, shingle: int, keep=None):
    """A function from batches of (node, text) to node and shingle hashes; a task reads equal texts once."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        seen = set()
        for batch in batches:
            for part in slices(batch):
                nodes = part.column("node").to_pylist()
                new = [i for i, x in enumerate(nodes) if x not in seen and not seen.add(x)]
                if keep is not None and new:
                    new = np.array(new)[passes(keep.value, part.column("node").to_numpy().view(np.uint64)[new])].tolist()
                texts = part.column("text").take(pa.array(new, pa.int64()))
                yield from zip((nodes[i] for i in new), _shingles(texts, shingle))

    return read


def _tally(rows: DataFrame, shingle: int):
    """Broadcast counts of shingles by cell."""
    read = _different(rows, shingle)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for _, found in read(batches):
            np.add.at(total, (found & np.uint64(CELLS - 1)).astype(np.int64), 1)
        yield from out(dict(enumerate(total.reshape(-1, BLOCK))))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for batch in batches:
            for i, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                total[i] = total.get(i, 0) + np.frombuffer(counts, np.int64)
        yield from out(total)

    def out(total: dict) -> Iterator[pa.RecordBatch]:
        total = {i: x.tobytes() for i, x in total.items() if x.any()}
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.binary())], ["block", "counts"])

    schema = "block int, counts binary"
    found = rows.mapInArrow(count, schema).repartition("block").mapInArrow(add, schema).toArrow()  # CELLS numbers
    table = np.zeros((CELLS // BLOCK, BLOCK), np.int64)
    for i, counts in zip(found["block"].to_pylist(), found["counts"].to_pylist()):
        table[i] = np.frombuffer(counts, np.int64)
    return rows.sparkSession.sparkContext.broadcast(table.ravel())


def _prefixes(rows: DataFrame, shingle: int, similarity: float, tally, repeated=None) -> DataFrame:
    """``shingle``, ``node``, ``at`` (place in the order), ``n`` (shingles of the text): the shingles of which two similar texts share one."""
    read = _different(rows, shingle)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, found in read(batches):
            n = len(found)
            order = found[np.lexsort((found, tally.value[found & np.uint64(CELLS - 1)]))][:n - _least(similarity * n) + 1]
            at = np.arange(len(order), dtype=np.int32)
            if repeated is not None:
                fits = passes(repeated.value, order)
                order, at = order[fits], at[fits]
            if len(order):
                yield pa.RecordBatch.from_arrays([pa.array(order.view(np.int64)), pa.array(np.full(len(order), node, np.int64)), pa.array(at),
                                                  pa.array(np.full(len(order), n, np.int32))], ["shingle", "node", "at", "n"])

    return rows.mapInArrow(emit, "shingle long, node long, at int, n int")


def _least(x: float) -> int:
    """The smallest whole number that reaches ``x``, with room for rounding."""
    return int(np.ceil(x - 1e-9))


def _possible(a: str, b: str, similarity: float) -> Column:
    """Whether two texts may be similar if this is the first shingle they share."""
    n, m, at, to = F.col(f"{a}.n"), F.col(f"{b}.n"), F.col(f"{a}.at"), F.col(f"{b}.at")
    return F.least(n - at, m - to) >= F.ceil(similarity / (1 + similarity) * (n + m) - 1e-9)


def _sets(rows: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """``node``, ``own`` (its shingles) of the ``nodes``."""
    read = _different(rows, shingle, bit_filter(nodes, "node", 24))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, found in read(batches):
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([found.view(np.int64)], pa.list_(pa.int64()))], ["node", "own"])

    sets = rows.mapInArrow(emit, "node long, own array<long>").join(nodes, "node", "left_semi").dropDuplicates(["node"])
    return stored(sets, "shingles")


def _similar(pairs: DataFrame, rows: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The ``pairs`` (a, b) whose sets of shingles have the similarity; only texts of a pair are made into sets."""
    pairs = stored(pairs.distinct(), "pairs")
    if pairs.isEmpty():
        return pairs
    sets = _sets(rows, pairs.select("a").unionAll(pairs.select("b")).toDF("node").distinct(), shingle)
    both = pairs.join(sets.toDF("b", "right"), "b").join(sets.toDF("a", "left"), "a")
    shared = F.size(F.array_intersect("left", "right"))
    return stored(both.where(shared / (F.size("left") + F.size("right") - shared) >= similarity).select("a", "b"), "links")


def _apart(meets: DataFrame, links: DataFrame) -> DataFrame:
    """``meets`` with each text's group by ``links``, in buckets of several groups."""
    groups = components(links, "a", "b").withColumnRenamed("node", "_node")
    meets = meets.drop("component").join(groups, meets["node"] == groups["_node"], "left").withColumn("component", F.coalesce("component", "node")).drop("_node")
    several = meets.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("shingle")
    return stored(meets.join(several, "shingle", "left_semi"), "apart")


def similar_texts(docs: DataFrame, text: str = "text", shingle: int = 5, similarity: float = 0.8, rounds: int = 8) -> DataFrame:
    """``node``, ``component``: groups of texts, by their ``xxhash64``, that chains of similar texts reach; texts without any are left out.

    Two texts are similar if the Jaccard similarity of their sets of shingles (runs of ``shingle`` words as in ``simhash``, taken by
    their XXH64) is ``similarity`` or more. Fewer words make one shingle; empty and null texts are similar to each other.
    """
    bounded_batches(docs.sparkSession)
    filled = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.xxhash64(filled).alias("node"), filled.alias("text"))
    tally = _tally(rows, shingle)
    met = _prefixes(rows, shingle, similarity, tally).groupBy("shingle").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    met = stored(met.where("low <> high").select("shingle"), "shared")
    again = _prefixes(rows, shingle, similarity, tally, bit_filter(met, "shingle", 26))
    meets = stored(again.join(met, "shingle", "left_semi").distinct(), "meets")
    sizes = meets.groupBy("shingle").agg(F.count(F.lit(1)).alias("size"))
    weights = meets.join(sizes, "shingle").groupBy("node").agg(F.sum("size").alias("weight"))
    meets = meets.join(weights, "node").withColumn("component", F.col("node"))
    links = None
    for _ in range(rounds):
        meets = stored(meets, "meets")
        # a leader is compared with all others of its bucket, and then done there
        heads = stored(meets.groupBy("shingle").agg(F.max(F.struct("weight", "node", "at", "n", "component")).alias("h")), "heads")
        pairs = meets.select("shingle", F.struct("node", "at", "n", "component").alias("m")).join(heads, "shingle")
        pairs = pairs.where("m.component <> h.component").where(_possible("h", "m", similarity))
        new = _similar(pairs.select(F.least("h.node", "m.node").alias("a"), F.greatest("h.node", "m.node").alias("b")), rows, shingle, similarity)
        links = new if links is None else links.unionAll(new)
        led = heads.select("shingle", F.col("h.node").alias("node"))
        meets = _apart(meets.join(led, ["shingle", "node"], "left_anti"), links)
        # another round, unless few pairs of different groups are left for their members, or leaders connect nothing more
        n, own = F.sum("n"), F.sum(F.col("n") * F.col("n"))
        left = meets.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("shingle").agg(n.alias("n"), (n * n - own).alias("pairs"))
        left = left.agg(F.sum("pairs").alias("pairs"), F.sum("n").alias("members")).first()
        if (left["pairs"] or 0) <= 64 * (left["members"] or 0) or new.isEmpty():
            break
    # what is left: pairs that no leader connected
    one, two = (meets.select("shingle", F.struct("node", "at", "n", "component").alias(x)) for x in "hm")
    pairs = one.join(two, "shingle").where("h.node < m.node and h.component <> m.component").where(_possible("h", "m", similarity))
    more = _similar(pairs.select(F.col("h.node").alias("a"), F.col("m.node").alias("b")), rows, shingle, similarity)
    return components(links.unionAll(more), "a", "b")


def drop_similar(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """The row of ``docs`` with the smallest key (null last, then the smallest hash of the text) of each group; all columns stay.

    Rows that repeat a key and a text stay once, and so do equal texts.
    """
    digest = text_digest(text)
    groups = similar_texts(docs, text, shingle, similarity)
    own = docs.select(digest.alias("_node"), F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), digest.alias("hash")).alias("first"))
    own = own.groupBy("_node").agg(F.min("first").alias("first")).join(groups, F.col("_node") == groups["node"], "left")
    kept = own.groupBy(F.coalesce("component", "_node")).agg(F.min("first").alias("first")).select(F.col("first.id").alias("_id"), F.col("first.hash").alias("_hash"))
    return first_rows(docs, text, key, kept, docs.select(F.col(key).alias("id"), digest.alias("hash")))

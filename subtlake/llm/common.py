"""Connected components and output helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtlake.operators.bits import bit_filter, passes  # noqa: F401
from subtlake.session import bounded_batches, checkpointed, stored  # noqa: F401


FEW_EDGES = 1 << 20  # 16 MB: what one task connects


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for all nodes of the undirected ``edges``.

    Rounds of hooking every node to its smallest neighbour and halving the way to the smallest node; each round is
    aggregates and joins, cut by a reliable checkpoint. A node with very many neighbours is aggregated map-side.
    Up to ``FEW_EDGES`` edges are connected by one task, since a round over them would be thousands of tasks with next to nothing in each.
    """
    edges = stored(edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u <> v").distinct(), "edges")
    if edges.count() <= FEW_EDGES:
        return stored(_connected(edges), "components")
    while True:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        # every larger neighbour is tied to the smallest one, and so is every node to it
        large = both.where("v > u").join(low, "u").select(F.col("low").alias("u"), "v").where("u <> v").distinct()
        small = large.groupBy("v").agg(F.min("u").alias("low"))
        hooked = large.join(small, "v")
        after = checkpointed(
            hooked.select(F.col("low").alias("u"), F.col("v")).unionAll(hooked.select(F.col("low").alias("u"), F.col("u").alias("v")))
            .where("u <> v").distinct()
        )
        same = edges.count() == after.count() and edges.exceptAll(after).isEmpty()
        edges = after
        if same:
            break
    stars = edges.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return stars.unionAll(edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())


def _connected(edges: DataFrame) -> DataFrame:
    """``components`` of bounded many ``edges`` (u, v) in one task."""
    kind = edges.schema["u"].dataType.simpleString()

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [x for x in batches if len(x)]
        if not batches:
            return
        ends = [np.concatenate([x.column(c).to_numpy() for x in batches]) for c in ("u", "v")]
        nodes, at = np.unique(np.concatenate(ends), return_inverse=True)
        i, j = at[:len(ends[0])], at[len(ends[0]):]
        root = np.arange(len(nodes))
        while len(i):
            # the larger root of an edge is tied to the smaller one, then all ways are made flat
            np.minimum.at(root, np.maximum(root[i], root[j]), np.minimum(root[i], root[j]))
            while ((up := root[root]) != root).any():
                root = up
            apart = root[i] != root[j]
            i, j = i[apart], j[apart]
        for first in range(0, len(nodes), 1 << 16):
            part = slice(first, first + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[part]), pa.array(nodes[root[part]])], ["node", "component"])

    return edges.coalesce(1).mapInArrow(connect, f"node {kind}, component {kind}")


def first_rows(docs: DataFrame, text: str, key: str, kept: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key and text are ``kept`` (_id, _hash), each key and text once; all columns stay.

    ``pairs`` (id, hash) are the keys and ``text_digest`` of all rows. What must go or comes more than once is put into a filter of fixed
    size: rows that it does not hold stay where they are, and only the others are dealt out and met with ``kept``.
    """
    bounded_batches(docs.sparkSession)
    kept = stored(kept, "kept")
    pairs = pairs.groupBy("id", "hash").agg(F.count(F.lit(1)).alias("n"))
    doubtful = pairs.join(kept, pairs["id"].eqNullSafe(kept["_id"]) & (pairs["hash"] == kept["_hash"]), "left").where("n > 1 or _hash is null")
    held = bit_filter(doubtful.select(F.xxhash64("id", "hash").alias("pair")), "pair", 26)
    digest, pair = free_names(docs, "_text", "_pair")
    rows = docs.withColumn(digest, text_digest(text)).withColumn(pair, F.xxhash64(key, digest))

    def part(doubt: bool) -> DataFrame:
        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(passes(held.value, batch.column(pair).to_numpy().view(np.uint64)) == doubt))

        return rows.mapInArrow(read, rows.schema)

    met = part(True)
    met = met.join(kept, met[key].eqNullSafe(kept["_id"]) & (met[digest] == kept["_hash"]), "left_semi").dropDuplicates([key, digest])
    return part(False).unionAll(met).select(*docs.columns)


def text_digest(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """``names``, with underscores before those that ``docs`` has a column of."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)

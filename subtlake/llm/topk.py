"""Exact top-k by inner product with the three-phase uniform threshold.

A vector's score is the sum of its scores in ``lists`` slices of its components, so each slice is a list of local scores. For a block
of queries and a chunk of candidates: (1) the best k of each local list are gathered, and their full scores give a cutoff that the
k-th best of all can not be below; (2) with that cutoff divided by the number of lists as a uniform threshold, every list gives all
entries at or above it, and entries whose upper bound is below the cutoff fall away; (3) the scores of what remains are resolved
exactly. The cutoff is safe over all chunks: a first pass gathers it from every chunk, and it is sent along with the queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subtlake.llm.tokens import bounded_batches
from subtlake.session import checkpointed, shuffle_partitions

_EXACT = float(1 << 53)


def whole_components(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, x as double; null if the vector or a component is null, NaN or infinite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    return F.when(vector.isNotNull() & ~F.coalesce(odd, F.lit(True)), whole)


def _matrix(data: bytes, dimension: int) -> np.ndarray:
    flat = np.frombuffer(data, np.int64)
    return flat.reshape(-1, dimension) if dimension else np.zeros((0, 0), np.int64)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products, exact as long as they fit 64 bits: in floating point only where that is exact."""
    if a.shape[1] == 0:
        return np.zeros((len(a), len(b)), np.int64)
    bound = np.abs(a.astype(np.float64)).max(initial=0) * np.abs(b.astype(np.float64)).max(initial=0) * a.shape[1]
    if bound < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def top_k(vectors: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256,
          lists: int = 4, chunk: int = 4096, block: int = 1024) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``key``, ``score``: for each row of ``vectors`` where ``queries`` holds, the k best other rows.

    Components count as floor(scale * x). Ties go to the smaller key. Rows whose vector is null or holds a null or non-finite component
    take no part; null keys do neither. Vectors meet those of their own length only. Rows that repeat a key are rows of their own: each
    is a candidate for the other, and each gives a query of its own. A score must fit a long.
    """
    k_ = k
    bounded_batches(vectors.sparkSession)
    rows = vectors.select(F.col(key).cast("long").alias("id"), whole_components(F.col(vector), scale).alias("x"), queries.alias("asks"))
    rows = rows.where("id is not null and x is not null")
    rows = checkpointed(rows.withColumn("row", F.monotonically_increasing_id()))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one length, packed: chunk of at most ``chunk`` candidates, or block of at most ``block`` queries."""
        held: dict[tuple[int, bool], list] = {}

        def emit(length: int, ask: bool, some: list) -> pa.RecordBatch:
            number = some[0][1] * 2 + ask
            return pa.RecordBatch.from_arrays(
                [pa.array([length], pa.int32()), pa.array([ask]), pa.array([number], pa.int64()),
                 pa.array([np.array([r[0] for r in some], np.int64).tobytes()], pa.binary()),
                 pa.array([np.array([r[1] for r in some], np.int64).tobytes()], pa.binary()),
                 pa.array([np.concatenate([r[2] for r in some]).astype(np.int64).tobytes()], pa.binary())],
                ["length", "ask", "number", "ids", "rows", "data"])

        for batch in batches:
            x = batch.column("x")
            for i, (id_, row, asks) in enumerate(zip(batch.column("id").to_pylist(), batch.column("row").to_pylist(),
                                                     batch.column("asks").to_pylist())):
                values = x[i].values.to_numpy()
                for ask in ((False, True) if asks else (False,)):
                    some = held.setdefault((len(values), ask), [])
                    some.append((id_, row, values))
                    if len(some) == (block if ask else chunk):
                        yield emit(len(values), ask, some)
                        some.clear()
        for (length, ask), some in held.items():
            if some:
                yield emit(length, ask, some)

    packed = checkpointed(rows.mapInArrow(pack, "length int, ask boolean, number long, ids binary, rows binary, data binary"))
    asked = packed.where("ask").select("length", F.col("number").alias("block"), F.col("ids").alias("query_ids"),
                                       F.col("rows").alias("query_rows"), F.col("data").alias("query_data"))
    held = packed.where("not ask").select("length", "ids", "rows", "data", "number")
    # chunks are dealt out by a salt, so that vectors of one length do not meet in one task; every salt gets all blocks
    salts = shuffle_partitions(vectors)
    held = held.withColumn("salt", F.pmod(F.xxhash64("number"), F.lit(salts)).cast("int"))

    def met(blocks: DataFrame) -> DataFrame:
        return held.join(blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), ["length", "salt"])

    def meet(batches: Iterator[pa.RecordBatch], work) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                n = pair["length"]
                ids, own = np.frombuffer(pair["ids"], np.int64), np.frombuffer(pair["rows"], np.int64)
                q_ids, q_rows = np.frombuffer(pair["query_ids"], np.int64), np.frombuffer(pair["query_rows"], np.int64)
                x = _matrix(pair["data"], n) if n else np.zeros((len(ids), 0), np.int64)
                q = _matrix(pair["query_data"], n) if n else np.zeros((len(q_ids), 0), np.int64)
                cuts = [round(i * n / lists) for i in range(lists + 1)]
                local = [_scores(q[:, a:b], x[:, a:b]) for a, b in zip(cuts, cuts[1:])]
                yield from work(pair, ids, own, q_ids, q_rows, local)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Phase 1: candidates that lead a local list, with their full scores; the k best of them for each query."""

        def work(pair, ids, own, q_ids, q_rows, local):
            out_q, out_s = [], []
            for i, row in enumerate(q_rows):
                others = np.flatnonzero(own != row)
                if not len(others):
                    continue
                lead = [others[np.argpartition(-part[i][others], min(k_, len(others)) - 1)[:k_]] for part in local]
                lead = np.unique(np.concatenate(lead))
                full = np.sort(sum(part[i][lead] for part in local))[::-1][:k_]
                out_q.append(np.full(len(full), row))
                out_s.append(full)
            if out_q:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_q)), pa.array(np.concatenate(out_s))], ["query", "score"])

        yield from meet(batches, work)

    best = met(asked).mapInArrow(gather, "query long, score long")
    # the k-th best of what was gathered: the k-th best of all is no lower; fewer than k leave no cutoff
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    cutoff = checkpointed(best.withColumn("place", place).where(F.col("place") == k).select("query", "score"))
    # the cutoffs of a block travel with its queries
    whose = rows.where("asks").select(F.col("row").alias("query"))
    members = asked.select("length", "block", "query_rows")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                numbers = np.frombuffer(r["query_rows"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(numbers), r["block"])), pa.array(np.arange(len(numbers), dtype=np.int32)),
                                                  pa.array(numbers)], ["block", "at", "query"])

    places = members.mapInArrow(unpack, "block long, at int, query long").join(whose, "query")
    cut = places.join(cutoff, "query").groupBy("block").agg(F.collect_list(F.struct("at", "score")).alias("cutoffs"))
    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Phases 2 and 3: entries at or above the uniform threshold in any list; exact scores of those whose bound reaches the cutoff."""

        def work(pair, ids, own, q_ids, q_rows, local):
            known = {c["at"]: c["score"] for c in pair["cutoffs"] or []}
            out = []
            for i, row in enumerate(q_rows):
                cutoff = known.get(i)
                if cutoff is None:
                    rest = np.arange(len(ids))
                else:
                    threshold = -(-cutoff // len(local))
                    sent = [part[i] >= threshold for part in local]
                    rest = np.flatnonzero(np.logical_or.reduce(sent))
                    # a list that sent nothing for an entry has it below the threshold
                    bound = sum(np.where(s[rest], part[i][rest], threshold - 1) for s, part in zip(sent, local))
                    rest = rest[bound >= cutoff]
                rest = rest[own[rest] != row]
                score = sum(part[i][rest] for part in local) if len(rest) else np.zeros(0, np.int64)
                if cutoff is not None:
                    rest, score = rest[score >= cutoff], score[score >= cutoff]
                order = np.lexsort((ids[rest], -score))[:k_]
                out.append((np.full(len(order), row), np.full(len(order), q_ids[i]), ids[rest][order], score[order]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*out)], ["query", "query_id", "id", "score"])

        yield from meet(batches, work)

    found = met(asked.join(cut, "block", "left")).mapInArrow(resolve, "query long, query_id long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    found = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return found.select("query_id", "rank", F.col("id").alias(key), "score")

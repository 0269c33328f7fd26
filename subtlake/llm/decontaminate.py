"""Benchmark passages in documents, reordered ones included, by greedy string tiling.

Tokens are runs of letters and digits of the lower-cased text. Seeds are runs of ``tile`` tokens: documents and test items that share
enough of them are joined, then each pair is tiled. Tiling marks the longest common runs of unmarked tokens first, found by rolling
hashes (Karp-Rabin) of falling length, and the share of the item's tokens under tiles decides.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subtlake.llm.common import bit_filter, passes
from subtlake.llm.tokens import PUNCTUATION, bounded_batches, gram_hashes, grams_inside, scan, slices, word_hashes
from subtlake.session import checkpointed

_MASK = (1 << 61) - 1  # a prime modulus for rolling hashes
_BASE = 1_000_003


def _rolling(tokens: list[int], marked: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """(first token, hash) of each run of ``size`` unmarked tokens, each hash from the one before."""
    top, value, run = pow(_BASE, size - 1, _MASK), 0, 0
    for i, token in enumerate(tokens):
        if marked[i]:
            value, run = 0, 0
            continue
        if run == size:
            value = (value - tokens[i - size] * top) % _MASK
            run -= 1
        value = (value * _BASE + token) % _MASK
        run += 1
        if run == size:
            yield i - size + 1, value


def _longest(item: list[int], doc: list[int], in_item: list[bool], in_doc: list[bool], size: int) -> tuple[int, list[tuple[int, int, int]]]:
    """All matches of at least ``size`` unmarked tokens that can not be made longer, and the longest length."""
    table = defaultdict(list)
    for at, value in _rolling(item, in_item, size):
        table[value].append(at)
    best, found = 0, []
    for at, value in _rolling(doc, in_doc, size):
        for other in table.get(value, ()):
            if at and other and not in_doc[at - 1] and not in_item[other - 1] and doc[at - 1] == item[other - 1]:
                continue  # part of the match that began before
            n = 0
            while (other + n < len(item) and at + n < len(doc) and not in_item[other + n] and not in_doc[at + n]
                   and item[other + n] == doc[at + n]):
                n += 1
            if n >= size:
                found.append((n, other, at))
                best = max(best, n)
    return best, found


def tile(item: list[int], doc: list[int], shortest: int) -> int:
    """Tokens of ``item`` under tiles of at least ``shortest`` tokens; a token of either side is under one tile at most.

    A falling length is searched for: matches twice as long as expected raise it, else the matches found are marked from the longest
    to the shortest, and the length is halved down to ``shortest``.
    """
    in_item, in_doc, covered = [False] * len(item), [False] * len(doc), 0
    size = max(shortest, min(20, len(item)))
    while True:
        best, found = _longest(item, doc, in_item, in_doc, size)
        if best > 2 * size:
            size = best
            continue
        again = False
        for n, a, b in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
            if any(in_item[a:a + n]) or any(in_doc[b:b + n]):
                again = True  # what is left of it may still be long enough
                continue
            in_item[a:a + n] = in_doc[b:b + n] = [True] * n
            covered += n
        if again:
            continue
        if size <= shortest:
            return covered
        size = max(shortest, size // 2)


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text",
                 item_key: str = "item_id", shortest: int = 5, share: float = 0.8, filter_bits: int = 24) -> DataFrame:
    """``key``, ``text_hash``, ``item_key``, ``item_tokens``, ``covered``, ``coverage``: pairs in which tiles of at least ``shortest`` tokens
    cover at least ``share`` of the item's tokens. One row per different document (key and text) and item.

    Null and empty texts and items without a token are in no pair. An item of fewer than ``shortest`` tokens must be met as a whole.
    Repeated items are each reported under their own key; items that agree in key and text once. ``filter_bits`` sets the size of a
    filter of the items' seeds that only saves work.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("h"), F.lower(text).alias("text"))
    items = items.select(F.col(item_key).alias("item"), F.lower(item_text).alias("text")).distinct()
    id_type, item_type = (x.simpleString() for x in (docs.schema["id"].dataType, items.schema["item"].dataType))

    def item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = scan(part.column("text"), PUNCTUATION)
                hashes = word_hashes(words)
                counts = np.diff(words.first)
                tokens, seeds = [], []
                for i, n in enumerate(counts.tolist()):
                    own = hashes[words.first[i]:words.first[i + 1]]
                    tokens.append(own.view(np.int64))
                    seeds.append(np.unique(gram_hashes(own, min(n, shortest))).view(np.int64) if n else own.view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("item"), pa.array(np.minimum(counts, shortest).astype(np.int32)),
                                                  pa.array(tokens, pa.list_(pa.int64())), pa.array(seeds, pa.list_(pa.int64()))],
                                                 ["item", "size", "tokens", "seeds"])

    tests = items.mapInArrow(item_seeds, f"item {item_type}, size int, tokens array<long>, seeds array<long>").where("size > 0")
    # one number stands for an item's key and tokens, null keys included
    tests = checkpointed(tests.withColumn("number", F.xxhash64("item", "tokens")).dropDuplicates(["number"]))
    lengths = sorted(r["size"] for r in tests.select("size").distinct().collect())  # at most ``shortest`` numbers
    wanted = bit_filter(tests.select(F.explode("seeds").alias("seed")), "seed", filter_bits)

    def doc_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = scan(part.column("text"), PUNCTUATION)
                hashes = word_hashes(words)
                starts, sizes, seeds = [], [], []
                for size in lengths:
                    grams = gram_hashes(hashes, size)
                    at = np.flatnonzero(grams_inside(words, size) & passes(wanted.value, grams))
                    starts.append(at)
                    sizes.append(np.full(len(at), size))
                    seeds.append(grams[at])
                starts, sizes, seeds = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, sizes, seeds))
                if not len(starts):
                    continue
                row = np.searchsorted(words.first, starts, "right") - 1
                order = np.argsort(row, kind="stable")
                rows, first = np.unique(row[order], return_index=True)
                out_seeds, out_tokens = [], []
                for i, mine in zip(rows.tolist(), np.split(order, first[1:])):
                    low, high = words.first[i], words.first[i + 1]
                    under = np.zeros(high - low + 1, np.int64)
                    np.add.at(under, starts[mine] - low, 1)
                    np.add.at(under, starts[mine] - low + sizes[mine], -1)
                    under = np.cumsum(under[:-1]) > 0
                    # the tokens under seeds, one zero for each gap: no tile can reach over it
                    at = np.flatnonzero(under)
                    own = hashes[low:high][at]
                    own = np.insert(own, np.flatnonzero(np.diff(at) > 1) + 1, 0)
                    out_tokens.append(own.view(np.int64))
                    out_seeds.append(np.unique(seeds[mine]).view(np.int64))
                taken = part.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([taken.column("id"), taken.column("h"), pa.array(out_seeds, pa.list_(pa.int64())),
                                                  pa.array(out_tokens, pa.list_(pa.int64()))], ["id", "h", "seeds", "tokens"])

    near = docs.mapInArrow(doc_seeds, f"id {id_type}, h long, seeds array<long>, tokens array<long>")
    near = checkpointed(near.withColumn("doc", F.xxhash64("id", "h", "tokens")))
    # a tile of n tokens holds at least n / shortest seeds, so fewer common seeds can not cover the share
    asked = tests.select("number", F.size("tokens").alias("n"), F.explode("seeds").alias("seed"))
    offered = near.select("doc", F.explode("seeds").alias("seed")).distinct()
    common = offered.join(asked, "seed").groupBy("doc", "number", "n").agg(F.count(F.lit(1)).alias("common"))
    # repeated seeds inside an item may stand for several places: only the different ones are counted, at the least they can be
    least = F.ceil(F.lit(share) * F.col("n") / shortest)
    repeated = tests.select("number", (F.size("tokens") - F.size("seeds") >= F.col("size")).alias("repeats"))
    pairs = common.join(repeated, "number").where(F.col("repeats") | (F.col("common") >= least)).select("doc", "number")
    one = near.withColumn("copy", F.row_number().over(Window.partitionBy("doc").orderBy("doc"))).where("copy = 1").drop("copy", "seeds")
    asked = tests.select("number", "item", F.col("tokens").alias("item_tokens"))
    full = pairs.join(one, "doc").join(asked, "number")

    def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            covered = []
            tests_, texts = batch.column("item_tokens"), batch.column("tokens")
            for i in range(len(batch)):
                item = tests_[i].values.to_numpy().view(np.uint64)
                text_ = texts[i].values.to_numpy().view(np.uint64)
                known = np.isin(text_, item)
                # what the item does not hold can only part tiles
                gap = ~known
                gap[1:] &= known[:-1]
                kept = known | gap
                text_ = np.where(known, text_, 0)[kept]
                covered.append(tile(item.tolist(), text_.tolist(), min(shortest, len(item))))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("h"), batch.column("item"),
                                              pa.array([len(tests_[i]) for i in range(len(batch))], pa.int32()),
                                              pa.array(covered, pa.int32())], ["id", "h", "item", "item_tokens", "covered"])

    out = full.select("id", "h", "item", "tokens", "item_tokens").mapInArrow(
        tiled, f"id {id_type}, h long, item {item_type}, item_tokens int, covered int")
    out = out.withColumn("coverage", F.col("covered") / F.col("item_tokens")).where(F.col("coverage") >= share)
    return out.select(F.col("id").alias(key), F.col("h").alias("text_hash"), F.col("item").alias(item_key), "item_tokens", "covered", "coverage")


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that are in no contaminated pair; all columns stay."""
    found = contaminated(docs, items, text, key, **options)
    found = found.select(F.col(key).alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    return docs.join(found, docs[key].eqNullSafe(found["_id"]) & (F.xxhash64(docs[text]) == found["_hash"]), "left_anti")

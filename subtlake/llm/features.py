"""Hashed features of documents and naive Bayes models over them, counted by Spark.

A model is one row of log odds per bucket and class: its size does not grow with the corpus, and it is all that reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtlake.llm.tokens import PUNCTUATION, bounded_batches, mix, scan, slices, word_hashes

BUCKETS = 1 << 18
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _category(name: str, values: np.ndarray) -> np.ndarray:
    """A bucket for each (name, value)."""
    salt = np.uint64(int.from_bytes(name.encode()[:8].ljust(8, b"\0"), "little"))
    return (mix(values.astype(np.int64).view(np.uint64) + mix(salt.reshape(1))) & np.uint64(BUCKETS - 1)).astype(np.int32)


def document_features(docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",),
                      metadata: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """``keys``, ``text_hash``, ``tokens`` (long), ``words`` and ``page`` (lists of buckets): one row per input row.

    ``words`` are the different words of the whole lower-cased text. ``page`` describes the page without its words: the ``metadata``
    columns, length, line length, the shares of capitals, digits, and punctuation, and how much words repeat. Null and empty texts have no words.
    """
    bounded_batches(docs.sparkSession)
    metadata = tuple(c for c in metadata if c in docs.columns)
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)], F.xxhash64(text).alias("text_hash"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"), *[F.xxhash64(c).alias(f"m{i}") for i, c in enumerate(metadata)])
    kept = [f for f in rows.schema.fields if f.name.startswith("k") or f.name == "text_hash"]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in kept] + ["tokens long, words array<int>, page array<int>"])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = scan(part.column("text"), PUNCTUATION, lower=True)
                buckets = (word_hashes(words) & np.uint64(BUCKETS - 1)).astype(np.int64)
                pairs = np.unique(words.doc() * BUCKETS + buckets)
                ends = np.searchsorted(pairs, np.arange(1, len(part) + 1) * BUCKETS)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array((pairs % BUCKETS).astype(np.int32)))
                shape = _shape(part.column("text"))
                tokens = np.diff(words.first)
                shape["variety"] = np.floor(np.diff(np.append(0, ends)) / np.maximum(tokens, 1) * 20).astype(np.int64) * (tokens > 9)
                page = [_category(f"m{i}", part.column(f"m{i}").to_numpy()) for i in range(len(metadata))]
                page += [_category(name, values) for name, values in shape.items()]
                page = np.stack(page, axis=1)
                pages = pa.ListArray.from_arrays(pa.array((np.arange(len(part) + 1) * page.shape[1]).astype(np.int32)), pa.array(page.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*[part.column(f.name) for f in kept], pa.array(np.diff(words.first).astype(np.int64)), lists, pages],
                                                 [*[f.name for f in kept], "tokens", "words", "page"])

    out = rows.mapInArrow(describe, schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keys)], "text_hash", "tokens", "words", "page")


def _shape(texts: pa.Array) -> dict[str, np.ndarray]:
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    cuts = offsets - offsets[0]

    def count(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(mask))[cuts])

    size = np.diff(cuts)
    letters = np.maximum(size - count(_SPACE[raw]), 1)
    lines = count(raw == 10) + 1

    def steps(share: np.ndarray) -> np.ndarray:
        return np.minimum(np.floor(share * 20), 20).astype(np.int64)

    return {"length": np.floor(np.log2(size + 1) * 2).astype(np.int64), "line": np.floor(np.log2(size / lines + 1) * 2).astype(np.int64),
            "upper": steps(count(_UPPER[raw]) / letters), "digit": steps(count(_DIGIT[raw]) / letters),
            "mark": steps(count(PUNCTUATION[raw] & ~_SPACE[raw]) / letters)}


def flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row number and value of every list entry."""
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy()[offsets[0]:offsets[-1]]
    return np.repeat(np.arange(len(lists)), np.diff(offsets)), values


def class_counts(rows: DataFrame, views: dict[str, str], classes: int) -> dict[str, np.ndarray]:
    """For each view (name of a list column: name of the column with its class, null for rows that do not count): documents per class and
    bucket, with the number of documents of each class in an extra last row. Each task adds up its own; sums meet per bucket.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {v: np.zeros((BUCKETS + 1, classes), np.int64) for v in views}
        for batch in batches:
            for view, column in views.items():
                label = batch.column(column).fill_null(-1).to_numpy(zero_copy_only=False)
                row, bucket = flat(batch.column(view))
                used = label[row] >= 0
                totals[view] += np.bincount(np.where(used, bucket * classes + label[row], (BUCKETS + 1) * classes),
                                            minlength=(BUCKETS + 1) * classes + 1)[:-1].reshape(-1, classes)
                totals[view][BUCKETS] += np.bincount(label[label >= 0], minlength=classes)[:classes]
        for number, total in enumerate(totals.values()):
            bucket, label = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(bucket), number, np.int32)), pa.array(bucket.astype(np.int32)),
                                              pa.array(label.astype(np.int32)), pa.array(total[bucket, label])], ["view", "bucket", "label", "n"])

    wanted = rows.select(*dict.fromkeys([*views, *views.values()]))
    sums = wanted.mapInArrow(count, "view int, bucket int, label int, n long").groupBy("view", "bucket", "label").agg(F.sum("n").alias("n"))
    found = sums.toArrow()  # at most views x buckets x classes rows
    out = {}
    for number, view in enumerate(views):
        out[view] = np.zeros((BUCKETS + 1, classes), np.int64)
        mine = np.asarray(found["view"]) == number
        out[view][np.asarray(found["bucket"])[mine], np.asarray(found["label"])[mine]] = np.asarray(found["n"])[mine]
    return out


def bayes(counts: np.ndarray, smooth: float = 0.5, clear: float = 4.0) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihood of each bucket per class, centred over the classes, and the log prior.

    A bucket counts only if in some class its documents are ``clear`` standard deviations off the class's share: with very many buckets
    the others add up to noise.
    """
    per_class = counts[BUCKETS].astype(float)
    likelihood = np.log((counts[:BUCKETS] + smooth) / (per_class + 2 * smooth))
    likelihood -= likelihood.mean(axis=1, keepdims=True)
    share = per_class / max(per_class.sum(), 1)
    met = counts[:BUCKETS].sum(axis=1, keepdims=True)
    off = np.abs(counts[:BUCKETS] - met * share) / np.sqrt(met * share * (1 - share) + 0.25)
    likelihood[off.max(axis=1) < clear] = 0
    return likelihood, np.log((per_class + 1) / (per_class.sum() + len(per_class)))


def sums(lists: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Sum of the buckets' weights per row and class."""
    row, bucket = flat(lists)
    return np.stack([np.bincount(row, weights[bucket, c], minlength=len(lists)) for c in range(weights.shape[1])], axis=1)


def with_labels(rows: DataFrame, labels: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """``rows`` with the label columns ``columns`` (expression: name); a key that is labelled repeatedly has the majority, 0 in a tie."""
    votes = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_labelled")).agg(
        *[(F.avg(F.expr(e).cast("double")) > 0.5).cast("int").alias(n) for e, n in columns.items()])
    # labels grow with the corpus: one plan for all sizes, and no broadcast
    return rows.join(votes.hint("merge"), F.col(key) == F.col("_labelled"), "left").drop("_labelled")

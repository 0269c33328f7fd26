"""Words and word k-mers of whole texts, as numpy arrays over one Arrow batch.

Texts are scanned as UTF-8 bytes. A null text is an empty one. Hashes never depend on the batch a text arrives in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

BLOCK = 1 << 17  # bytes worked on at a time
_M = np.uint64(0x9E3779B97F4A7C15)
_ALL = (1 << 64) - 1
_POWERS = np.cumprod(np.full(1 << 14, _M), dtype=np.uint64)
_BYTES = np.random.RandomState(7).randint(1, 1 << 62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)

#: The separators of the contract's words: blank and U+0009 to U+000D.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Everything in ASCII but letters and digits separates.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches by bytes, so that long texts do not pile up in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 << 20))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of several texts: text ``i`` has the words ``first[i]:first[i + 1]``.

    ``plain`` holds all words joined by one blank; word ``j`` is ``plain[start[j]:end[j]]``.
    """

    plain: bytes
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def scan(texts: pa.Array, separators: np.ndarray = SPACES, lower: bool = False) -> Words:
    """Words of each text; ``lower`` changes A-Z only."""
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return Words(b"", np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    cuts = offsets - offsets[0]
    if lower:
        table = np.arange(256, dtype=np.uint8)
        table[65:91] += 32
        raw = table[raw]
    inside = ~separators[raw]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edges = cuts[:-1][cuts[:-1] < len(raw)]
    opens[edges] = inside[edges]
    start = np.flatnonzero(opens)
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edges = cuts[1:][cuts[1:] > 0] - 1
    closes[edges] = inside[edges]
    end = np.flatnonzero(closes) + 1
    first = np.searchsorted(start, cuts)
    # words moved together with one blank between them
    length = end - start
    new_end = np.cumsum(length + 1) - 1 if len(length) else length
    new_start = new_end - length
    plain = np.full(int(new_end[-1]) + 1 if len(length) else 0, 0x20, np.uint8)
    mask = np.ones(len(plain), bool)
    mask[new_end] = False
    plain[mask] = raw[inside]
    return Words(plain.tobytes(), new_start, new_end, first)


def slices(batch: pa.RecordBatch, column: str = "text", most: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``most`` bytes of text each, or one row."""
    lengths = np.asarray(pc.binary_length(batch.column(column).fill_null("")))
    begin, total = 0, 0
    for i, n in enumerate(lengths):
        if i > begin and total + n > most:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    if begin < len(lengths):
        yield batch.slice(begin)


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word, in blocks of bytes."""
    out = np.zeros(len(words.start), np.uint64)
    plain = np.frombuffer(words.plain, np.uint8)
    begin = 0
    while begin < len(out):
        stop = max(begin + 1, int(np.searchsorted(words.end, words.start[begin] + BLOCK)))
        s, low = words.start[begin:stop], words.start[begin]
        part = plain[low:words.end[stop - 1]]
        width = np.diff(np.append(s, words.end[stop - 1]))
        at = np.arange(len(part)) - np.repeat(s - low, width)
        values = _BYTES[part] * _POWERS[at & (len(_POWERS) - 1)]
        # the blank behind a word counts for nothing
        blank = words.end[begin:stop - 1] - low
        values[blank] = 0
        length = (words.end[begin:stop] - s).astype(np.uint64)
        out[begin:stop] = mix(np.add.reduceat(values, s - low) + length * _M)
        begin = stop
    return out


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` words, by doubling; runs across texts are included and to be masked."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total, done, power, size, weight = None, 0, hashes, 1, int(_M)
    while True:
        if k & size:
            if total is None:
                total, done, factor = power, size, weight
            else:
                m = len(power) - done
                total = total[:m] + power[done:] * np.uint64(factor)
                done, factor = done + size, factor * weight & _ALL
        if size * 2 > k:
            break
        power = power[:len(power) - size] + power[size:] * np.uint64(weight)
        weight = weight * weight & _ALL
        size *= 2
    return mix(total[:n])


def grams_inside(words: Words, k: int) -> np.ndarray:
    """Which runs of ``k`` words, by first word, lie inside one text."""
    n = len(words.start) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    doc = words.doc()
    return doc[:n] == doc[k - 1:]

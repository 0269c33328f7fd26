"""Filters of keys whose size does not depend on the input."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def bit_filter(keys: DataFrame, column: str, bits: int) -> Broadcast:
    """A filter of ``2 ** bits`` bits of the 64-bit keys in ``column``: its size does not depend on the input.

    A key that was added is always found. Others are found by chance, the more the fuller the filter is, so what passes
    must still be joined exactly. The driver receives at most ``2 ** (bits - 6)`` numbers.
    """
    slot = F.col(column).bitwiseAND((1 << bits) - 1)
    words = keys.select(F.shiftright(slot, 6).alias("word"), F.expr("0L").alias("z"), slot.bitwiseAND(63).cast("int").alias("bit"))
    words = words.select("word", F.expr("shiftleft(1L, bit)").alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    found = words.toArrow()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[np.asarray(found["word"])] = np.asarray(found["mask"]).view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(table)


def bits_of(keys: np.ndarray, bits: int) -> np.ndarray:
    """Such a filter of ``keys`` that are at hand."""
    table = np.zeros(1 << (bits - 6), np.uint64)
    slot = np.unique(keys & np.uint64((1 << bits) - 1))
    words = (slot >> np.uint64(6)).astype(np.int64)
    new = np.flatnonzero(np.diff(words, prepend=-1))
    if len(slot):
        table[words[new]] = np.bitwise_or.reduceat(np.uint64(1) << (slot & np.uint64(63)), new)
    return table


def passes(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the 64-bit ``keys`` the filter ``table`` may hold."""
    slot = keys & np.uint64(len(table) * 64 - 1)
    return (table[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0

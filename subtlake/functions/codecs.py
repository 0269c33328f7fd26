"""The few functions that need Python codecs: Arrow UDFs, applied to prefiltered rows only."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: The characters of bytes 128 to 255 in cp437 and in latin1.
_CP437 = bytes(range(128, 256)).decode("cp437")
_LATIN1 = bytes(range(128, 256)).decode("latin1")


def _recoded(content: bytes | None, fallback: str) -> str | None:
    if content is None:
        return None
    content = bytes(content)
    for mark, codec in ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16")):
        if content.startswith(mark):
            return content.decode(codec, errors="replace")
    return content.decode(fallback, errors="replace")


@F.pandas_udf(T.StringType())
def _recode(contents: pd.Series, fallback: pd.Series) -> pd.Series:
    return pd.Series([_recoded(c, f) for c, f in zip(contents, fallback)])


def fix_mojibake(name: Column) -> Column:
    """Names read as cp437 or latin1 that are UTF-8; others stay."""
    odd = name.rlike(r"[^\x00-\x7F]")
    whole = F.translate(name, _CP437, "").rlike(r"^[\x00-\x7F]*$")
    box = F.encode(F.when(whole, F.translate(name, _CP437, _LATIN1)), "ISO-8859-1").cast("string")
    latin = F.encode(F.when(name.rlike(r"^[\x00-\x{FF}]*$"), name), "ISO-8859-1").cast("string")
    return F.when(odd & F.is_valid_utf8(box), box).when(odd & F.is_valid_utf8(latin), latin).otherwise(name)


def to_utf8(content: Column, fallback: str = "cp1252") -> Column:
    """Bytes -> text. Valid UTF-8 without a byte-order mark is cast in the JVM; the rest is recoded.

    ``fallback`` names the codec of what is neither UTF-8 nor marked.
    """
    plain = F.is_valid_utf8(content.cast("string")) & (F.hex(F.substring(content, 1, 3)) != "EFBBBF")
    odd = _recode(F.when(~plain, content), F.lit(fallback))
    return F.when(plain, content.cast("string")).otherwise(odd)


#: The polynomial of CRC-16/XMODEM without its top bit.
_POLYNOMIAL = 0x1021
#: Bytes folded one by one before the remainders of pieces are combined.
_PIECE = 256


def _times_x(value: int, bits: int) -> int:
    """``value`` as a polynomial over GF(2), times x to the power of ``bits``, reduced."""
    for _ in range(bits):
        value = (value << 1) ^ (_POLYNOMIAL | 0x10000 if value & 0x8000 else 0)
    return value


def _table(values: list[int]) -> Column:
    return F.lit(np.array(values, np.int32))  # one literal, not an array built for each byte


def crc16(content: Column) -> Column:
    """CRC-16/XMODEM of bytes; null for null, 0 for none.

    The remainder is linear over GF(2). Each piece of 256 bytes is folded by the table of one byte's remainders. Then the pieces' remainders
    are summed up, each moved over the bytes behind it: a shift over a whole piece is one table for the high byte and one for the low.
    Bytes of value 0 in front change nothing, so the short piece is the first one and all shifts are alike.
    """
    byte = _table([_times_x(v, 16) for v in range(256)])
    high, low = (_table([_times_x(v << up, 8 * _PIECE) for v in range(256)]) for up in (8, 0))
    size = F.octet_length(content)

    def fold(rest: Column, char: Column) -> Column:
        over = F.shiftright(rest, 8).bitwiseXOR(F.ascii(char))
        return F.shiftleft(rest.bitwiseAND(255), 8).bitwiseXOR(F.get(byte, over))

    def piece(number: Column) -> Column:
        end = size - number * _PIECE
        start = F.greatest(F.lit(0), end - _PIECE)
        chars = F.split(F.decode(F.substring(content, start + 1, end - start), "ISO-8859-1"), "")
        return F.aggregate(chars, F.lit(0), fold)

    def join(rest: Column, own: Column) -> Column:
        moved = F.get(high, F.shiftright(rest, 8)).bitwiseXOR(F.get(low, rest.bitwiseAND(255)))
        return moved.bitwiseXOR(own)

    last = F.floor((size - 1) / _PIECE).cast("int")
    pieces = F.transform(F.sequence(last, F.lit(0), F.lit(-1)), piece)
    return F.when(size == 0, F.lit(0)).otherwise(F.aggregate(pieces, F.lit(0), join))

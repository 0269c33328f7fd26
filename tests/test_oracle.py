"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as contract
from subtlake.functions.codecs import crc16

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, contract.queries()[name], contract.oracle_sql()[name], SF) is None


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["lang", "text", "files", "occurrences"] and rows.count() > 0


def test_crc16_against_bitwise_form(spark):
    def crc(data):
        value = 0
        for byte in data:
            value ^= byte << 8
            for _ in range(8):
                value = (value << 1) ^ 0x1021 if value & 0x8000 else value << 1
                value &= 0xFFFF
        return value

    assert crc(b"123456789") == 0x31C3
    odd = [None, b"", b"\0", b"\0a", bytes(range(256)), bytes(range(256)) + b"\n", b"\xff" * 511, b"\0" * 300 + b"\r\n\x85", bytes(range(255, -1, -1)) * 40]
    frame = spark.createDataFrame([(i, bytearray(x) if x is not None else None) for i, x in enumerate(odd)], "i int, x binary")
    assert [r.c for r in frame.select("i", crc16(F.col("x")).alias("c")).orderBy("i").collect()] == [None if x is None else crc(x) for x in odd]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: r.crc16 for r in contract.queries()["q_crc16"](spark, SF).collect()}
    assert len(got) == len(texts)
    assert all(got[k] == crc(texts[k].encode()) for k in sorted(texts, key=lambda k: len(texts[k]))[:60])


def test_sample_is_repeatable(spark):
    sample = contract.queries()["q_sample_rows"]
    first = [r[0] for r in sample(spark, SF).collect()]
    assert len(set(first)) == 1000 and first == [r[0] for r in sample(spark, SF).collect()]

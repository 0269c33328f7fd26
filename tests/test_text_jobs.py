"""Cues, advertising and archives."""

import io
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from subtlake.functions.text import grouped_removal_regex, removal_regex
from subtlake.operators import ads, archive, cues


def one(spark, value, build):
    return spark.createDataFrame([(value,)], "v string").select(build(F.col("v")).alias("o")).first().o


def test_cue_array(spark):
    srt = "﻿1\r\n00:00:01,5 --> 00:01:02,250\r\nHello\r\nthere\r\n\r\n \r\n2\n01:00:00.000 --> 01:00:01.000 X1:0\n\n\nno cue\n\n3\n0:0:9,000-->0:0:10,000\nBye"
    got = [tuple(c) for c in one(spark, srt, cues.cue_array)]
    assert got == [(0, 1500, 62250, "Hello\nthere"), (1, 3600000, 3601000, ""), (2, 9000, 10000, "Bye")]
    sub = "{24}{48}one|two\n\n{240}{264}three"
    assert [tuple(c) for c in one(spark, sub, cues.cue_array)] == [(0, 1000, 2000, "one\ntwo"), (1, 10000, 11000, "three")]


@pytest.mark.parametrize("n,want", [(4, [0, 1, -2, -1]), (3, [0, 1, -1]), (1, [0]), (0, []),
                                    (45, [*range(30), *range(-10, 0)]), (40, [*range(30), *range(-10, 0)])])
def test_edge_index(spark, n, want):
    assert spark.range(1).select(cues.edge_index(F.lit(n)).alias("i")).first().i == want


def test_candidates(spark):
    lines = [(1, ["hello", "visit www.x.com", "after", "x"]), (2, ["hello", "long one", "next", "visit www.x.com", "end"])]
    df = spark.createDataFrame(lines, "sub long, l array<string>")
    cue = F.transform("l", lambda t, i: F.struct(
        i.alias("ord"), F.when(t == "long one", 5001).when(t == "next", 5000).otherwise(1000).alias("ms"), t.alias("text")))
    near = cues.with_context(df, "sub", cue)
    got = {r.text: (r.sub, r["class"], r.context_before, r.context_after) for r in ads.ad_candidates(near, "sub", duration=F.col("ms")).collect()}
    assert got == {
        "hello": (1, 0, None, None), "visit www.x.com": (1, 1, "hello", None), "after": (1, 0, None, 1), "x": (1, 0, None, None),
        "long one": (2, 2, None, None), "next": (2, 0, None, 2), "end": (2, 0, None, None),
    }


PATTERNS = [
    ("Two lines", "second [0-9]+"), ("Two lines",), (r"www\.site\.com",), ("Übersetzt von .*x",), ("a?b",), ("Subs by x", "and y"), ("Subs by x",),
    ("foo|bar",), ("Two",), ("Subs",),
]
TEXTS = [
    "Two lines\nsecond 12\nkeep", "Two lines|keep", "Two lines\\Nsecond 3", "x www.site.com\r\nrest", "www.site.comrest", "Subs by x\rand y",
    "Subs by x\nand z\nSubs", "nothing here", "aab\nfoo\nbar|Two", "", "Übersetzt von mir x\n.", "Two lines\r\nsecond 9\r\nTwo lines\r\n",
]


def test_remove_ads_equals_ordered_alternation(spark):
    separator, end = rb"(?:\n|\r\n|\r|\\N|\|)", rb"(?:\n|\r\n|\r|\\N|\||$)"
    bodies = [b"(?:" + separator.join(line.encode() for line in p) + end + b")" for p in PATTERNS]
    python = re.compile(b"|".join(bodies))
    want = [python.sub(b"", t.encode()) for t in TEXTS]
    data = [bytearray(t.encode()) for t in TEXTS]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(data)], "i int, content binary")
    got = [bytes(r.content) for r in ads.remove_ads_bytes(df, "content", PATTERNS).orderBy("i").collect()]
    assert got == want
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    assert [r.t for r in ads.remove_ads(texts, "t", PATTERNS).orderBy("i").collect()] == [w.decode() for w in want]
    plain = texts.select("i", F.regexp_replace("t", F.lit(removal_regex(PATTERNS)), F.lit("")).alias("t"))
    assert [r.t for r in plain.orderBy("i").collect()] == [w.decode() for w in want]
    assert grouped_removal_regex(PATTERNS) != removal_regex(PATTERNS)


def test_bytes_without_match_stay(spark):
    data = bytearray(bytes(range(256)) * 3)
    df = spark.createDataFrame([(data,)], "content binary")
    assert bytes(ads.remove_ads_bytes(df, "content", [("no match", b"\xdcber")]).first().content) == bytes(data)


def made_zip(members):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for path, content in members:
            z.writestr(zipfile.ZipInfo(path), content)
    return data.getvalue()


def test_unpack_and_repair(spark):
    srt = b"1\n00:00:01,000 --> 00:00:02,000\n"
    members = [
        ("d/", b""), ("d/x.(7).nfo", b"info"), ("It’s.srt", srt + b"one"), ("It's.srt", srt + b"one"), ("It's.srt", srt + b"two"),
        ("frames.txt", b"{1}{2}x\n"), ("latin", srt + "\xe9".encode("latin1")), ("a.srt.txt", srt), ("l" * 300 + ".srt", srt + b"l"),
    ]
    good = made_zip(members)
    df = spark.createDataFrame([(7, bytearray(good)), (8, bytearray(good[:50])), (9, bytearray(b""))], "num long, content binary")
    unpacked = archive.unpack_archives(df)
    rows = unpacked.collect()
    assert sorted(r.num for r in rows if r.broken) == [8, 9]
    assert [(r.path, bytes(r.content)) for r in rows if not r.broken] == [m for m in members if not m[0].endswith("/")]
    meta = spark.createDataFrame([(7, "sub")], "num long, SubFormat string")
    fixed = {r.new_path: r.text for r in archive.repair_members(unpacked, meta, fallback="iso-8859-1").collect()}
    assert set(fixed) == {"7.It's.srt", "7.It's.2.srt", "7.frames.sub", "7.latin.srt", "7.a.srt",
                          "7." + "l" * 124 + "..." + "l" * 122 + ".srt"}
    assert fixed["7.It's.2.srt"].endswith("two") and fixed["7.latin.srt"].endswith("é")


def test_first_members_inflate_one_member(spark):
    members = [("d/", b""), ("d/x.nfo", b"info" * 500), ("d/.nfo", b"hidden" * 100), ("Title.srt", b"text" * 900), ("big.srt", b"q" * 100_000)]
    good = made_zip(members)

    def damaged(name):
        """The member's bytes overwritten; the directory is whole."""
        with zipfile.ZipFile(io.BytesIO(good)) as z:
            at = z.getinfo(name).header_offset + 30 + len(name)
        return good[:at] + b"\xff" * 8 + good[at + 8:]

    cases = [good, damaged("d/x.nfo"), damaged("big.srt"), damaged("d/.nfo"), good[:60], b"", made_zip([("a.nfo", b"x"), ("b/", b"")])]
    df = spark.createDataFrame([(n, bytearray(c)) for n, c in enumerate(cases)], "num long, content binary")
    found = archive.first_members(df).collect()
    # other members are not read: their damage does not show; a name of dots only has no ending
    assert {r.num: (r.path, bytes(r.content)) for r in found} == {n: ("d/.nfo", b"hidden" * 100) for n in (0, 1, 2)}
    assert {r.total for r in found} == {sum(len(c) for _, c in members)}
    assert sum(len(r.content) for r in found) * 100 < sum(r.total for r in found)


def test_duplicate_forms_agree(spark):
    rows = [(n % 3, f"f{n % 2}.srt", n, bytearray(b"x" * (n % 4))) for n in range(60)]
    df = spark.createDataFrame(rows, "num long, path string, ord int, content binary")
    a = sorted(r.ord for r in archive.drop_equal_content(df).collect())
    b = sorted(r.ord for r in archive.drop_equal_content(df, bounded=False).collect())
    assert a == b and len(a) == len({(r[0], r[1], bytes(r[3])) for r in rows})
    split = archive.number_duplicates(df, bounded=False)
    assert {r.ord: r.new_path for r in split.collect()} == {r.ord: r.new_path for r in archive.number_duplicates(df).collect()}


def test_same_text_ignores_offsets(spark):
    srt = lambda shift, word: f"1\n00:00:0{shift},000 --> 00:00:09,000\n<i>Hello</i>\n{word}\n\n2\n00:01:0{shift},000 --> 00:01:09,000\nBye\n"
    df = spark.createDataFrame([(1, srt(1, "you")), (2, srt(2, "you")), (3, srt(1, "me"))], "num long, t string")
    assert sorted((r.num, r.first_num, r.copies) for r in archive.same_text(df, "num", F.col("t")).collect()) == [(1, 1, 2), (2, 1, 2)]


def test_listing(spark):
    from subtlake.functions.listing import extract_listing

    row = ('<tr onclick="x" class="y"> <td id="name{0}"><a>t</a></td><td>a</td><td><a href="/d">{1}x\n</a><br>z'
           '<span title="{2} votes">{3}</span></td><td><a href="/en/profile/iduser-{4}">u</a></td></tr>')
    html = "<table>" + row.format(11, 250, 3, "5.7", 99) + row.format(12, 0, 0, "0.0", 1) + "</table>"
    assert [tuple(r) for r in one(spark, html, extract_listing)] == [(11, 250, 57, 3, 99), (12, 0, 0, 0, 1)]


def test_archives_in_small_batches(spark):
    """Members come in batches that end with the member that fills them, whatever the number of archives."""
    import pandas as pd

    size, out = 3 << 20, io.BytesIO()
    with zipfile.ZipFile(out, "w") as made:
        made.writestr("a.srt", b"x" * size)
    frames = list(archive._unpack(iter([pd.DataFrame({"num": range(12), "content": [out.getvalue()] * 12})])))
    assert sum(map(len, frames)) == 12 and max(len(f) for f in frames) * size < 24 << 20
    files = spark.range(300).select("id", F.array(F.struct(F.lit("a.srt").alias("path"), F.encode(F.repeat(F.lit("x"), 100_000), "UTF-8").alias("content"))).alias("m"))
    blobs = archive.pack_archives(files.coalesce(1), "id", F.col("m"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20
    sizes = archive.unpack_archives(blobs).groupBy().agg(F.count("num").alias("n"), F.sum("size").alias("size")).first()
    assert tuple(sizes) == (300, 300 * 100_000)

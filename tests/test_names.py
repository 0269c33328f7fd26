"""Names, codes, dates and outcomes."""

import subprocess

import pytest
from pyspark.sql import functions as F

from subtlake.functions import codecs, content, dates, ids, names, outcome, text
from subtlake.operators import languages, ranking


def column(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", build(F.col("v")).alias("o")).orderBy("i").collect()]


def test_zip_names(spark):
    cases = {
        "red.kite.(2004).slv.1cd.(10).zip": ("red kite", "2004", "slv", "1", []),
        "77.miles.of.sand.(2008).().ita.1cd.(501).zip":
            ("77 miles of sand", "2008", "ita", "1", ["extra empty parens after year"]),
        "owl.the.night.clerk.(2001).1cd.(502).zip":
            ("owl the night clerk", "2001", "eng", "1", ["missing sub_lang"]),
        "snowmelt.().pob.1cd.(503).zip": ("snowmelt", "", "pob", "1", ["empty year"]),
        "lost.name.(777).eng.1cd.(504).zip": ("lost name", "777", "eng", "1", ["invalid year"]),
        ".(1975).pol.1cd.(505).zip": ("", "1975", "pol", "1", ["empty movie name"]),
        ".().0cd.(506).zip": ("", "", "eng", "0", ["missing sub_lang", "empty year", "empty movie name"]),
    }
    parsed = column(spark, list(cases), names.parse_zip_name)
    assert [(p.title, p.year, p.lang, p.parts, p.errors) for p in parsed] == list(cases.values())
    assert column(spark, ["x.(2001).zip", "readme"], names.parse_zip_name) == [None, None]


def test_rename_and_legacy(spark):
    assert column(spark, ["1.night.7.(1983).pol.4cd.(1).zip", "1.night.7.(1983).pol.4cd.zip"], names.modernise_name) == [
        "1.night.7.(1983).pol.4cd.zip", None]
    cases = {"5.zip": 5, "5.x.zip": 5, "5.not-found": 5, "5.dmca": 5, "5.dcma": 5, "5.not-found-dmca": 5, "5.html": None,
             "5.zip.broken": None, "x.(1999).eng.1cd.(77).zip": 77, "x.(77).zip": None}
    assert column(spark, list(cases), names.legacy_num) == list(cases.values())


def test_disposition(spark):
    name = 'attachment; filename="night.7.(1983).pol.4cd.(1).zip"'
    assert column(spark, [name], lambda c: names.strip_disposition(c, F.lit(1))) == ["night.7.(1983).pol.4cd"]
    cases = {
        name: ("attachment", "night.7.(1983).pol.4cd.(1).zip"),
        "Attachment; filename*=UTF-8''a%C3%A9+b; filename=x": ("attachment", "aé+b"),
        "attachment; filename*=iso-8859-1'en'%A3%20rates/1": ("attachment", "£ rates_1"),
        'inline; filename*0="foo"; filename*1="bar.txt"; filename*3="no"': ("inline", "foobar.txt"),
        r'attachment; filename="a\"b\\c"': ("attachment", 'a"b_c'),
        "attachment": ("attachment", None),
    }
    assert [tuple(r) for r in column(spark, list(cases), names.disposition_filename)] == list(cases.values())
    long = 'attachment; filename="' + r'\"' * 20_000 + '"'
    assert column(spark, [long], names.disposition_filename)[0].filename == '"' * 20_000


def test_ids(spark):
    shard = [0, 1, 99, 100, 20718, 60413, 7, 1_000_000]
    assert column(spark, shard, ids.shard_file, "long")[4:7] == ["207xxxxx/20718xxx", "604xxxxx/60413xxx", "0xxxxx/7xxx"]
    assert column(spark, shard[:7], ids.shard_path, "long")[4:] == ["02/07/18xxx.db", "06/04/13xxx.db", "00/00/07xxx.db"]
    with pytest.raises(Exception, match="no path for shard"):
        column(spark, [1_000_000], ids.shard_path, "long")
    assert column(spark, [7, 123456789], ids.pad_num, "long") == ["00000007", "123456789"]
    found = column(spark, ["a.org.dump.10200000.to.10299999.v20241124", "a.org.dump.103xxxxx.v20251031",
                           "a.dump.10200000.to.10299998"], ids.release_range)
    assert [tuple(r) if r else None for r in found] == [
        (102, 10200000, 10299999, 20241124), (103, 10300000, 10399999, 20251031), None]


def test_fit_filename(spark):
    values = ["a" * 300 + ".srt", "é" * 200 + ".srt", "short.srt", "x" + "é" * 127, "日本" * 60]

    def expected(name):
        data = name.encode()
        if len(data) <= 255:
            return name
        half = int(len(data[:255].decode(errors="ignore")) / 2) - 1
        return name[:half] + "..." + name[-half:]

    got = column(spark, values, names.fit_filename)
    assert got == [expected(v) for v in values] and all(len(g.encode()) <= 255 for g in got)


def test_extensions(spark):
    cases = {"a.dlsubc": "a.srt", "a.txt": "a.sub", "": "empty_filename.srt", "a.srt": "a.srt", "b": "b", "d.x/f": "d.x/f"}
    assert column(spark, list(cases), names.fix_download_extension) == list(cases.values())
    fix = lambda fmt, micro=False: lambda c: names.fix_extension(c, F.lit(fmt), F.lit(micro))
    assert column(spark, ["a.srt.txt", "a", "", "a.zip", "a.srt", "a.txt"], fix("srt")) == [
        "a.srt", "a.srt", "empty_filename.srt", "a.zip.srt", "a.srt", "a.srt"]
    assert column(spark, ["x.TXT", "x.txt"], fix("sub", True)) == ["x.sub", "x.sub"]
    assert column(spark, ["x.ass", "x.ssa"], fix("ssa")) == ["x.ass", "x.ssa"]


def test_paths(spark):
    path = names.render_path("$base.${num}.$unknown.$$x", {"base": F.lit("b"), "num": F.lit(5)})
    assert spark.range(1).select(path).first()[0] == "b.5.$unknown.$x"


def test_version_order(spark):
    listed = ["k", "k3", "k20", "k03x", "k.q", "k.3.q", "k.20.q", "kk", "m", "4", "4~", "4.0", "4.0~", "4.2", "4.02", "4.2.6", "4.2rc5", "4.2-rc5", "0",
              "20017.s", "20009.t", "20009.tt", "disc.tar.gz", "disc-7.tar.gz", "v3.12.srt", "v3.9.srt", "p4q", "p04", "p~4", "..", ".7", "...7"]
    want = subprocess.run(["sort", "-V"], input="\n".join(listed) + "\n", capture_output=True, text=True,
                          env={"LC_ALL": "C", "PATH": "/usr/bin:/bin"}).stdout.split("\n")[:-1]
    df = spark.createDataFrame([(v,) for v in listed], "v string")
    assert [r.v for r in ranking.version_sort(df, "v").collect()] == want
    keys = column(spark, ["1.1", "1.01", "1.1.1", "1.01.01", "1.1.01", "1.01.1"], names.version_key)
    assert keys[0].whole == keys[1].whole and keys[2].whole == keys[3].whole and keys[4].whole == keys[5].whole


def test_quotes_and_tokens(spark):
    assert column(spark, ["´‘’‚‛＇“”„‟⹂＂ x"], names.normalise_quotes) == ["''''''" + '""""""' + " x"]
    assert column(spark, ["Amélie: L'Été, 2001_a!"], text.fts_tokens) == [["amelie", "l", "ete", "2001_a"]]
    assert column(spark, ["a.b (c) [d]? $^{x}|\\"], text.regex_escape) == [r"a\.b \(c\) \[d\]\? \$\^\{x\}|" + "\\"]
    assert column(spark, ["a\nb\r\nc\rd\\Ne|f"], text.split_lines) == [list("abcdef")]
    assert column(spark, ["Synced BY me", "plain", "Visit WWW.x.y", "wwwx"], text.keyword_hit) == [True, False, True, False]


def test_titles(spark):
    df = spark.createDataFrame([("Dont.Look.2009.x.2009", 2009), ("A.0.b", 0), ("none", 1999)], "r string, y int")
    got = [r[0] for r in df.select(text.release_title(F.col("r"), F.col("y"))).collect()]
    assert got == ["Dont.Look.", "A.0.b", "none"]


def test_dates(spark):
    values = ["2006-11-19 04:26:07", "0000-00-00 00:00:00", "1970-01-08 00:00:00"]
    assert column(spark, values, dates.added_epoch) == [1163910367, None, 604800]
    assert column(spark, [values[2]], lambda c: dates.week_index(c.cast("timestamp_ntz"))) == [1]
    assert column(spark, ["2000-01-01", "2024-02-29"], lambda c: dates.days_since_2000(c.cast("date"))) == [0, 8825]
    assert column(spark, ["5.7", "10.0", "0.29"], dates.rating_x10) == [57, 100, 3]


def test_languages(spark):
    assert column(spark, ["cz", "jp", "ger", "eng", "xx", "de"], languages.two_letter) == ["cs", "ja", "de", "en", "xx", "de"]
    assert column(spark, ["de", "fr", "zh", "xx"], languages.three_letter) == ["ger", "fre", "chi", "xx"]


def test_codecs(spark):
    good = "é日本Ж"
    odd = [good.encode().decode("cp437"), "é".encode().decode("latin1"), "plain", "Ж", None]
    assert column(spark, odd, codecs.fix_mojibake) == [good, "é", "plain", "Ж", None]
    data = [bytearray("é".encode()), bytearray("é".encode("latin1")), bytearray(b"\xef\xbb\xbfa"), bytearray("é".encode("utf-16")), None]
    assert column(spark, data, lambda c: codecs.to_utf8(c, "iso-8859-1"), "binary") == ["é", "é", "a", "é", None]


def test_formats(spark):
    cases = {"1\n00:00:01,000 --> 00:00:02,000\nx": "srt", "WEBVTT\n\n00:00:01.000 --> 00:00:02.000": "vtt",
             "{1}{2}x\n{3}{4}y": "sub", "[Script Info]\n[V4+ Styles]": "ass", "[V4 Styles]": "ssa", "<SAMI>": "smi", "x": "tmp"}
    assert column(spark, list(cases), lambda c: content.detect_format(c, F.lit("tmp"))) == list(cases.values())
    framed = ["{1}{1}25.000\n{123}{234}first|second\n\n  \n{3}{4}x", "{1}{2}a\nno", ""]
    assert column(spark, framed, content.is_microdvd) == [True, False, True]


def test_integrity(spark):
    line = lambda label, value: f"Û  {label:<15}: {value:<57} Û\n"
    lacks = line("Filename", "a.srt") + line("MD5", "ab" * 16) + line("Filename", "b.srt") + line("Size", "3 bytes") + line("MD5", "cd" * 16)
    assert [tuple(m) for m in column(spark, [lacks], content.parse_integrity)[0].members] == [("a.srt", None, "ab" * 16), ("b.srt", 3, "cd" * 16)]
    nfo = (line("Filename", "a.srt") + line("Size", "12 bytes") + line("MD5", "AB" * 16) + line("Format", "SRT")
           + line("Filename", "b.srt") + line("Size", "3 bytes") + line("MD5", "cd" * 16) + line("Format", "sub"))
    got = column(spark, [nfo], content.parse_integrity)[0]
    assert got.format == "srt"
    assert [tuple(m) for m in got.members] == [("a.srt", 12, "ab" * 16), ("b.srt", 3, "cd" * 16)]
    pairs = spark.createDataFrame([("txt", "sub"), ("srt", "sub"), ("SUB", "txt")], "a string, b string")
    assert [r[0] for r in pairs.select(content.same_format(F.col("a"), F.col("b"))).collect()] == [True, False, True]


def test_outcomes(spark):
    rows = [(200, "application/zip", "", "ok"), (200, "text/html; charset=UTF-8", "captcha", "html"),
            (503, "text/html", "Error 503 Backend fetch failed", "wait"), (503, "text/html", "", "wait"), (520, "", None, "wait"), (429, "text/html", "", "retry"),
            (404, "text/html", "nothing", "not_found"), (403, "application/json", '{"code":"BLK0001"}', "blocked"),
            (422, "application/json", "", "retry"), (200, "text/html", "<b>Please confirm you are not robot.</b>", "challenge"),
            (200, "image/png", "", "unknown"), (500, "text/html", "x", "pause")]
    df = spark.createDataFrame(rows, "s int, t string, b string, want string")
    got = df.select(outcome.classify_outcome(F.col("s"), F.col("t"), F.col("b")).alias("o"), "want").collect()
    assert [r.o for r in got] == [r.want for r in got]

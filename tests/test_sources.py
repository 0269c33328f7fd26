"""Readers, writers and streams on small files."""

import json
import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from subtlake.fixed_values import DETAIL_PAGE, DUMP_COLUMNS
from subtlake.operators import ranking, search
from subtlake.sinks import tables as sinks
from subtlake.sources import dump, inbox, providers, tables
from subtlake.streaming import streams

URL = DETAIL_PAGE + "%d/x"


def row(num, name="Some Title", year="2001", lang="en", release="Rel.2001", kind="movie", imdb="133093", fps="23.976"):
    return "\t".join([str(num), name, year, "English", lang, "2006-11-19 04:26:07", imdb, "srt", "1", release, fps, "", "", "",
                      kind, URL % num])


GOOD = [
    row(1), row(2, kind="tv"), row(3, release="first\nsecond line", imdb="20222222222224342"), row(4, release="with\ttab"),
    row(5, release="old\rmac"), row(6, name=""), row(7, lang=""), row(8, year=""), row(9, name="It's", year="666"), row(1, name="Last"),
]
BAD = [row(20, lang="EN"), row(21, kind="radio")]


def write(path, text):
    with open(path, "w", newline="") as f:
        f.write(text)


@pytest.mark.parametrize("block", ["128m", "300b", "90b"])
def test_dump(spark, tmp_path, block):
    lines = [GOOD[0], BAD[0], *GOOD[1:5], BAD[1], *GOOD[5:]]
    surplus = "\t".join(["7587300", "", *row(7587300).split("\t")[1:]])
    write(tmp_path / "dump.tsv", "\t".join(DUMP_COLUMNS) + "\n" + "\n".join(lines) + "\r\n" + surplus + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        good, bad = dump.split_valid(dump.read_dump(spark, str(tmp_path / "dump.tsv")))
        rows = {r.row_id: r for r in good.collect()}
        assert sorted((r.reason, r.row.split("\t")[0]) for r in bad.collect()) == [("ISO639", "20"), ("MovieKind", "21")]
        latest = {r.IDSubtitle: r for r in ranking.dedupe_latest(good, ["IDSubtitle"], ["file", "row_id"]).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == len(GOOD) + 1
    assert latest[3].MovieReleaseName == "first\nsecond line" and latest[3].ImdbID == 20222222222224342
    assert latest[4].MovieReleaseName == "with\ttab" and latest[5].MovieReleaseName == "old\nmac"
    assert latest[8].MovieYear == 0 and latest[6].MovieName == "" and latest[1].MovieName == "Last"
    assert latest[7587300].MovieName == "Some Title"


def test_dump_gzip_parts_and_lost_end(spark, tmp_path):
    import gzip

    folder = tmp_path / "parts"
    folder.mkdir()
    for part in range(3):
        with gzip.open(folder / f"p{part}.gz", "wt") as f:
            f.write("\t".join(DUMP_COLUMNS) + "\n" + "".join(row(part * 100 + i, release=f"a\nb{i}") + "\n" for i in range(50)))
            if part == 2:
                f.write("lost line\n" * 1500)
    good, bad = dump.split_valid(dump.read_dump(spark, str(folder)))
    assert good.count() == 150 and good.select("IDSubtitle").distinct().count() == 150
    assert bad.count() == 1500 and {r.reason for r in bad.select("reason").distinct().collect()} == {"fields"}


def test_dump_header(spark, tmp_path):
    write(tmp_path / "bad.tsv", "a\tb\n")
    with pytest.raises(ValueError):
        dump.read_dump(spark, str(tmp_path / "bad.tsv"))


def test_dump_header_of_every_file(spark, tmp_path):
    folder = tmp_path / "headers"
    folder.mkdir()
    write(folder / "a.tsv", "\t".join(DUMP_COLUMNS) + "\n" + row(1) + "\n")
    write(folder / "b.tsv", "a\tb\n" + row(2) + "\n")
    with pytest.raises(Exception, match="unexpected first line"):
        dump.split_valid(dump.read_dump(spark, str(folder)))[0].collect()


@pytest.mark.parametrize("block", ["128m", "90b"])
def test_dump_damage_stays_in_its_row(spark, tmp_path, block, monkeypatch):
    """A row without its address, one without its time, both in sequence, and a very long good row."""
    monkeypatch.setattr(dump, "_STRETCH", 7)
    no_end = lambda n: row(n, release="a\nb").replace(DETAIL_PAGE, "bad/")
    no_start = lambda n: row(n).replace("2006-11-19", "never")
    long = "\n".join(f"line {i}" for i in range(60))
    rows = [no_end(1), row(2), no_start(3), row(4), no_end(5), no_start(6), row(7, release=long), row(8) + "\r" + row(9)]
    write(tmp_path / "d.tsv", "\t".join(DUMP_COLUMNS) + "\n" + "\n".join(rows) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        good, bad = dump.split_valid(dump.read_dump(spark, str(tmp_path / "d.tsv")))
        kept, reasons = {r.IDSubtitle: r for r in good.collect()}, {r.row.split("\t")[0]: r.reason for r in bad.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(kept) == [2, 4, 7, 8, 9] and kept[7].MovieReleaseName == long
    assert reasons == {"1": "URL", "3": "SubAddDate", "5": "URL"}


def test_dump_rows_are_dealt_out_by_bytes(spark, tmp_path, monkeypatch):
    """Many tasks get rows, though the shuffled bytes are few."""
    monkeypatch.setattr(dump, "_PART", 1 << 12, raising=False)
    monkeypatch.setattr(dump, "_STRETCH", 50)
    write(tmp_path / "d.tsv", "\t".join(DUMP_COLUMNS) + "\n" + "".join(row(i, release=f"a\nb{i}") + "\n" for i in range(600)))
    rows = dump.read_dump_rows(spark, str(tmp_path / "d.tsv")).withColumn("task", F.spark_partition_id()).collect()
    assert len({r.row_id for r in rows}) == len(rows) == 600 and all("\n" in r.row for r in rows)
    assert len({r.task for r in rows}) > 16


def test_inbox_folder_and_stream(spark, tmp_path):
    names = {"1.x.zip": "archive", "2.zip": "archive", "3.not-found": "not_found", "4.not-found-dmca": "takedown", "5.dmca": "takedown",
             "6.dcma": "takedown", "7.html": "html", "7.2.html": "html", "8.zip.broken": "broken", "9.unknown": "unknown",
             "10.zip": "not_found", "x.(2001).eng.1cd.(11).zip": "archive", "notes": "other"}
    folder = tmp_path / "new"
    folder.mkdir()
    for name in names:
        write(folder / name, "x" if name.endswith(".zip") and name != "10.zip" else "")
    listed = inbox.list_inbox(spark, str(folder))
    assert {r.name: r.state for r in listed.collect()} == names
    assert sorted(r.num for r in inbox.done_ids(listed).collect()) == [1, 2, 3, 4, 5, 6, 10, 11]
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    time.sleep(0.2)
    streams.run_available(streams.stream_inbox(spark, str(folder), settle_ms=50), out, state)
    write(folder / "12.zip", "x")
    time.sleep(0.2)
    streams.run_available(streams.stream_inbox(spark, str(folder), settle_ms=50), out, state)
    # moved in with an old time, and a file that is there twice
    write(folder / "13.zip", "x")
    os.utime(folder / "13.zip", (1_000_000_000, 1_000_000_000))
    for _ in range(2):
        time.sleep(0.2)
        streams.run_available(streams.stream_inbox(spark, str(folder), settle_ms=50), out, state)
    rows = spark.read.parquet(out)
    assert {r.name: r.state for r in rows.collect()} == {**names, "12.zip": "archive", "13.zip": "archive"} and rows.count() == 15


def test_upsert_stream_over_batches(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "root")
    source.mkdir()
    schema = "num long, seq long, v string"
    for batch in ([(1, 1, "a"), (2, 1, "b"), (1, 2, "c")], [(2, 0, "old"), (3, 1, "d"), (1, 3, "e")]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").json(str(source))
        streams.upsert_latest(spark.readStream.schema(schema).json(str(source)), ["num"], ["seq"], root)
    read = lambda: {r.num: r.v for r in streams.read_latest(spark, root, ["num"], ["seq"]).collect()}
    assert read() == {1: "e", 2: "b", 3: "d"}
    streams.compact_latest(spark, root, ["num"], ["seq"])
    assert read() == {1: "e", 2: "b", 3: "d"}
    # the next batch, and another stream that starts at batch 0, keep what was folded; folding after every batch
    for i, batch in enumerate([[(4, 1, "f"), (2, 5, "g")], [(5, 1, "h")], [(5, 0, "old")]]):
        place = str(source) if i == 0 else str(tmp_path / "other")
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").json(place)
        state = f"{root}/_checkpoint"
        if i == 1:
            os.rename(state, str(tmp_path / "gone"))
        streams.upsert_latest(spark.readStream.schema(schema).json(place), ["num"], ["seq"], root, every=1)
    assert read() == {1: "e", 2: "g", 3: "d", 4: "f", 5: "h"}
    # a run that ends before its log entry changes nothing
    spark.createDataFrame([(9, 9, "x")], schema).write.parquet(f"{root}/generation-{streams._generation(spark, root) + 1}/base")
    assert read()[5] == "h" and 9 not in read()


def test_shard_completion_over_batches(spark, tmp_path):
    """Ids that are not expected, repeats and null ids complete nothing; a complete shard is reported once."""
    source, root = tmp_path / "in", str(tmp_path / "root")
    source.mkdir()
    expected = spark.createDataFrame([(0,), (1,), (2,), (2,), (10,), (None,)], "num long")
    seen = []
    for batch in ([(0, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:01"), (1, "2024-01-01 00:00:09"), (9, "2024-01-01 00:00:01"), (None, None)],
                  [(2, "2023-01-01 00:10:00"), (1, "2024-01-01 00:00:01"), (10, "2024-01-01 00:11:00")], [(2, "2024-01-02 00:00:00"), (10, None)]):
        spark.createDataFrame(batch, "num long, at string").coalesce(1).write.mode("append").json(str(source))
        stream = spark.readStream.schema("num long, at timestamp").json(str(source))
        streams.shard_completion(stream, expected, "num", "at", root, 10)
        done = spark.read.option("pathGlobFilter", "*.parquet").schema("shard long, have long, last_arrival timestamp").parquet(f"{root}/version=*")
        seen.append(sorted((r.shard, r.have, str(r.last_arrival)) for r in done.collect()))
    complete = [(0, 3, "2024-01-01 00:00:09"), (1, 1, "2024-01-01 00:11:00")]
    assert seen == [[], complete, complete]


def test_late_rows_of_windows(spark, tmp_path):
    """Rows within the delay change their window, later ones are left out."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    for batch in (["2024-01-01 10:00:00"], ["2024-01-01 12:00:00"], ["2024-01-01 11:55:00", "2024-01-01 10:30:00"], ["2024-01-01 15:00:00"]):
        spark.createDataFrame([(at,) for at in batch], "at string").coalesce(1).write.mode("append").json(str(source))
        stream = spark.readStream.schema("at timestamp").json(str(source))
        totals = streams.tumbling_totals(stream, "at", [], F.lit("ok"))
        streams.run_available(totals.select(F.col("window_start").cast("string"), "requests"), out, str(tmp_path / "state"))
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [
        ("2024-01-01 10:00:00", 1), ("2024-01-01 11:00:00", 1), ("2024-01-01 12:00:00", 1)]


def test_catalogue_and_lists(spark, tmp_path):
    write(tmp_path / "basics.tsv", "tconst\ttitleType\tprimaryTitle\toriginalTitle\tisAdult\tstartYear\tendYear\truntimeMinutes\tgenres\n"
          'tt0000001\tmovie\tA "quoted" title\t\\N\t0\t1894\t\\N\t1\tShort\ntt10\ttvSeries\tB\tB\t0\t\\N\t\\N\t\\N\t\\N\n')
    rows = tables.read_title_basics(spark, str(tmp_path / "basics.tsv")).orderBy("id").collect()
    assert [(r.id, r.primaryTitle, r.originalTitle, r.startYear, r.genres) for r in rows] == [
        (1, 'A "quoted" title', "", 1894, "Short"), (10, "B", "B", 0, "")]
    write(tmp_path / "ids.txt", "5\n+7\n--- a\n\n9 \n")
    assert sorted(r.num for r in tables.read_id_list(spark, str(tmp_path / "ids.txt")).collect()) == [5, 7, 9]
    write(tmp_path / "ads.txt", "one|two|6074|71|5698025|chi\n- x -\\Ny|5038|-2|6859871|eng\n")
    ads = tables.read_ad_samples(spark, str(tmp_path / "ads.txt")).orderBy("sub").collect()
    assert [tuple(r) for r in ads] == [("one|two", 6074, 71, 5698025, "chi"), ("- x -\\Ny", 5038, -2, 6859871, "eng")]
    shards = spark.createDataFrame([("shards/0xxxxx/7xxx.db",)], "p string").select(tables.shard_of_file(F.col("p")).alias("shard"))
    assert tables.ids_of_shards(shards).agg(F.min("num"), F.max("num"), F.count("num")).first()[:] == (7000, 7999, 1000)


def test_providers(spark, tmp_path):
    config = {"providers": [{"id": "off", "enabled": False, "num_range_from": 1, "num_range_to": 999999},
                            {"id": "a", "num_range_from": 10, "num_range_to": 20, "lang": "ger"}, {"id": "b", "num_range_from": 15, "num_range_to": 30},
                            {"id": "multi", "db_path_format": "/{shard_id}xxx.db", "shard_size": 1000}, {"id": "open", "num_range_from": 500, "lang": "eng"}]}
    write(tmp_path / "registry.json", json.dumps(config))
    registry = providers.read_registry(spark, str(tmp_path / "registry.json"))
    assert [p["id"] for p in registry] == ["a", "b", "multi", "open"]
    shards = providers.expand_provider(registry[2], ["x/1xxx.db", "x/12xxx.db"])
    assert {(p["id"], p["num_range_from"], p["num_range_to"]) for p in shards} == {
        ("multi/shard-1", 1000, 1999), ("multi/shard-12", 12000, 12999)}
    langs = providers.expand_provider({"id": "l", "db_path_format": "/langs/{lang}.db"}, ["l/ger.db", "l/eng.db"])
    assert {(p["id"], p["lang"]) for p in langs} == {("l/lang-ger", "ger"), ("l/lang-eng", "eng")}
    routed = spark.createDataFrame([(12, "ger"), (16, "eng"), (16, "ger"), (40, "ger"), (40, "eng"), (1500, "ger"), (31, "ger")], "num long, lang string")
    got = search.route_to_provider(routed, registry[:2] + shards + registry[3:], "num", "lang")
    assert {(r.num, r.lang): r.provider for r in got.collect()} == {
        (12, "ger"): "a", (16, "eng"): "b", (16, "ger"): "a", (40, "ger"): None, (40, "eng"): "open",
        (1500, "ger"): "multi/shard-1", (31, "ger"): None}


def test_snapshots(spark, tmp_path):
    root, first = str(tmp_path / "snap"), datetime(2024, 1, 1)
    assert sinks.snapshot_is_due(spark, root, first)
    sinks.publish_snapshot(spark.range(3), root, first)
    assert not sinks.snapshot_is_due(spark, root, first + timedelta(days=9))
    assert sinks.snapshot_is_due(spark, root, first + timedelta(days=11))
    sinks.publish_snapshot(spark.range(5), root, first + timedelta(days=11))
    assert sinks.read_snapshot(spark, root).count() == 5 and len([d for d in os.listdir(root) if d.startswith("snapshot")]) == 2


def test_export_lines_are_in_order(spark, tmp_path):
    meta = spark.range(0, 3000, 7).select(F.col("id").alias("num"), (F.col("id") * 2).alias("epoch"))
    sinks.export_id_time(meta.repartition(5), "num", "epoch", str(tmp_path / "out"), 1000)
    lines = []
    for bucket in range(3):
        folder = tmp_path / "out" / f"bucket={bucket}"
        for name in sorted(os.listdir(folder)):
            if name.startswith("part"):
                with open(folder / name) as f:
                    lines += [json.loads(line) for line in f]
    assert lines == [[n, 2 * n] for n in range(0, 3000, 7)]


def test_delayed_release_replaces(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    rows = [(1, "2024-01-01 00:00:00", "a"), (1, "2024-01-03 00:00:00", "b"), (2, "2024-01-02 00:00:00", "c"), (3, "2024-01-12 00:00:00", "d")]
    spark.createDataFrame(rows, "num long, at string, v string").coalesce(1).write.mode("append").json(str(source))
    stream = spark.readStream.schema("num long, at timestamp, v string").json(str(source))
    out = str(tmp_path / "out")
    streams.run_available(streams.delayed_release(stream, ["num"], "at"), out, str(tmp_path / "state"))
    assert {r.num: r.v for r in spark.read.parquet(out).collect()} == {1: "b", 2: "c"}


def test_release_is_no_folder(spark, tmp_path):
    shards = spark.createDataFrame([(i, i // 5) for i in range(2000)], "num long, release_id long")
    sinks.write_release(shards, shards.select("release_id").where("release_id % 2 = 0"), shards.select("num").where("num % 3 > 0"), f"{tmp_path}/out")
    got = spark.read.parquet(f"{tmp_path}/out")
    assert sorted((r.num, r.release_id) for r in got.collect()) == [(i, i // 5) for i in range(2000) if i // 5 % 2 == 0 and i % 3]
    assert len(list((tmp_path / "out").rglob("*.parquet"))) <= 8 and not list((tmp_path / "out").glob("release_id=*"))


def test_events_of_many_files(spark, tmp_path):
    """A part of the events in many files is one batch: no row is late because of another file."""
    from subtlake.plans import streaming

    rows = [(i, i % 3, f"2024-01-{1 + i % 28:02d} 00:30:00", "error" if i % 5 == 0 else "view", 1.0) for i in range(280)]
    events = spark.createDataFrame(rows, "event_id long, user_id long, ts string, event_type string, value double")
    events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).repartitionByRange(8, F.desc("ts")).write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 27))  # a split, and so a file, for each file
    try:
        got = streaming.stream_daily_quota(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = {}
    for _, user, ts, *_ in rows:
        want[user, ts[:10]] = want.get((user, ts[:10]), 0) + 1
    assert {(r.user_id, str(r.day)): r.downloads for r in got} == want


def test_small_shards_share_a_state(spark, tmp_path):
    """Complete shards over several runs of shards, with negative ids, in batches; one call of the function serves a run."""
    source, root = tmp_path / "in", str(tmp_path / "root")
    ids = [*range(-10, 200), *range(streams.STATE_IDS - 7, streams.STATE_IDS + 8), 7 * streams.STATE_IDS]
    expected = spark.createDataFrame([(i,) for i in ids], "num long")
    for batch in (ids[::2], ids[1::3], ids):
        spark.createDataFrame([(i, f"2024-01-01 00:00:{i % 60:02d}") for i in batch], "num long, at string").write.mode("append").json(str(source))
        stream = spark.readStream.schema("num long, at timestamp").json(str(source))
        streams.shard_completion(stream, expected, "num", "at", root, 5)
    done = spark.read.option("pathGlobFilter", "*.parquet").schema("shard long, have long, last_arrival timestamp").parquet(f"{root}/version=*")
    want = {}
    for i in ids:
        want.setdefault(i // 5, []).append(i % 60)
    assert sorted((r.shard, r.have, r.last_arrival.second) for r in done.collect()) == sorted((s, len(x), max(x)) for s, x in want.items())
    assert spark.read.format("statestore").load(f"{root}/_checkpoint").count() == 4


def test_marks_are_spread(spark, tmp_path):
    from subtlake.plans.inputs import write_marks

    names = spark.createDataFrame([(f"{i}.zip", i % 3) for i in range(400)], "name string, size int").coalesce(1)
    folders = write_marks(names, str(tmp_path / "marks"))
    assert len(folders) > spark.sparkContext.defaultParallelism
    listed = inbox.list_inbox(spark, *folders)
    assert sorted((r.name, r.size) for r in listed.collect()) == sorted((f"{i}.zip", i % 3) for i in range(400))
    by_task = listed.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert max(by_task) < 200


def test_few_shards_are_spread(spark):
    ids = tables.ids_of_shards(spark.createDataFrame([(i,) for i in range(64)], "shard long").coalesce(1), "shard", 10)
    assert sorted(r.num for r in ids.collect()) == list(range(640))
    assert max(len(x) for x in ids.rdd.glom().collect()) < 640


def test_archives_of_a_lookup_are_packed_by_all_cores(spark, monkeypatch):
    from subtlake.plans import titles

    seen = []

    def pack(rows, *rest, pack=titles.archive.pack_archives):
        seen.append(rows.rdd.getNumPartitions())
        return pack(rows, *rest)

    monkeypatch.setattr(titles.archive, "pack_archives", pack)
    titles.lookup(spark, "/root/testdata/sf0.001")
    assert seen and min(seen) >= spark.sparkContext.defaultParallelism

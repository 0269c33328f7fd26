"""Gaps, islands, packs and completeness."""

import random

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from subtlake.operators import grouping, recon, sequences


def ids(spark, numbers):
    return spark.createDataFrame([(n,) for n in numbers], "num long")


def test_gaps_and_islands_across_borders(spark):
    present = [1, 2, 3, 5, 6, 9, 20, 21, 22, 23, 23]
    for bucket in (1, 2, 5, 1000):
        gaps = sorted(r.num for r in sequences.id_gaps(ids(spark, present), bucket=bucket).collect())
        assert gaps == [4, 7, 8, *range(10, 20)]
        runs = sequences.islands(ids(spark, present), bucket=bucket)
        assert sorted(map(tuple, runs.collect())) == [(1, 3), (5, 6), (9, 9), (20, 23)]
    entries = [r.entry for r in sequences.compress_runs(runs).orderBy("lo").collect()]
    assert entries == ["[1,3]", "5", "6", "9", "[20,23]"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(0, 400), min_size=1, max_size=120), st.sampled_from([3, 17, 100]))
def test_gaps_and_islands_make_the_range(spark, present, bucket):
    gaps = {r.num for r in sequences.id_gaps(ids(spark, present), bucket=bucket).collect()}
    assert gaps | present == set(range(min(present), max(present) + 1)) and not gaps & present
    runs = [tuple(r) for r in sequences.islands(ids(spark, present), bucket=bucket).collect()]
    assert {n for lo, hi in runs for n in range(lo, hi + 1)} == present
    assert all(hi + 1 not in present and lo - 1 not in present for lo, hi in runs)


def test_long_gap_is_cut(spark):
    assert sequences.id_gaps(ids(spark, [0, 50_001])).count() == 50_000


def test_first_missing_and_done(spark):
    runs = sequences.islands(ids(spark, [1, 2, 3, 5, 6]), bucket=2)
    first = lambda after: sequences.first_missing(runs, after).first()[0]
    assert [first(0), first(1), first(3), first(4), first(9)] == [4, 4, 4, 7, 10]
    for cell in (2, 256):
        done = sequences.is_num_done(ids(spark, range(8)), runs, cell=cell)
        assert done.count() == 8 and sorted(r.num for r in done.where("done").collect()) == [1, 2, 3, 5, 6]


def test_steady_run(spark):
    rows = sequences.steady_run(ids(spark, [3, 10, 11, 12, 14, 15]), "num", 9, 4).collect()
    assert {r.num: r.after_break for r in rows} == {10: False, 11: False, 12: False, 14: True, 15: True}


def test_time_outliers_carry_over(spark):
    rng = random.Random(3)
    times = [rng.randint(0, 1000) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(times)), "num long, ts long")
    got = {r.num: r.earlier_max for r in sequences.time_outliers(df, "num", "ts", 7).collect()}
    want = {i: max(times[:i]) for i in range(1, 200) if times[i] < max(times[:i])}
    assert got == want


def plain_packs(rows, limit):
    """One file after the other, per key."""
    state, out = {}, {}
    for num, key, size in sorted(rows, key=lambda r: (r[0], r[2])):
        pack, used = state.get(key, (-1, None))
        if used is None or used + size >= limit:
            pack, used = pack + 1, 0
        state[key] = (pack, used + size)
        out.setdefault((num, key, size), []).append(pack)
    return out


def packed(df, keys, **options):
    out = {}
    for r in grouping.pack_by_size(df, keys, "num", "size", 1000, **options).collect():
        out.setdefault((r.num, r.lang if keys else None, r["size"]), []).append(r.pack)
    return {k: sorted(v) for k, v in out.items()}


def test_pack_by_size_follows_the_sequence(spark):
    rng = random.Random(9)
    # a language with a third of all rows, another in a few far ids, empty and oversized files, ids on both sides of 0, stretches without ids
    rows = [(n, "x" if rng.random() < 0.4 else rng.choice("yz"), rng.choice([0, 1, 10, 300, 489, 490, 980, 2000])) for n in range(-150, 900) if not 200 < n < 420]
    rows += [(50_000 + n, "far", 300) for n in range(20)] + [(7, "x", 5), (7, "x", 600)]
    df = spark.createDataFrame(rows, "num long, lang string, size long")
    full = [r for r in rows if r[2] > 0]
    for keys in ([], ["lang"]):
        want = {k: sorted(v) for k, v in plain_packs([(n, lang if keys else None, s) for n, lang, s in full], 980).items()}
        for bucket, fan in ((40, 2), (7, 16)) if keys else ((40, 3), (100_000, 16)):
            assert packed(df, keys, bucket=bucket, fan=fan) == want, (keys, bucket)
    later = [(n, None, s) for n, _, s in full if n >= 100]
    assert packed(df, [], first=100, bucket=40, fan=2) == {k: sorted(v) for k, v in plain_packs(later, 980).items()}
    assert packed(df.limit(0), ["lang"]) == {}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 30), min_size=1, max_size=12), min_size=1, max_size=9), st.integers(1, 60))
def test_stretches_compose_like_the_sequence(stretches, limit):
    functions = [grouping._steps(np.array(s), limit) for s in stretches]
    whole = grouping._steps(np.concatenate(stretches), limit)
    for parts in (functions, [grouping._compose(functions[i:i + 2], limit) for i in range(0, len(functions), 2)]):
        total, breaks, after, packs = grouping._compose(parts, limit)
        assert total == whole[0]
        for threshold in range(1, min(limit, total) + 1):
            one, two = (grouping._through(f, np.array([threshold])) for f in ((total, breaks, after, packs), whole))
            assert max(int(one[0][0]), 0) == max(int(two[0][0]), 0) and one[1][0] == two[1][0]


def test_reconcile_and_completeness(spark):
    one = lambda *n: ids(spark, n)
    flags = recon.reconcile(one(0, 1, 2, 3, 10, 11, 11), one(0, 1, 1, 12), one(2), one(3))
    assert sorted(r.num for r in flags.where("missing").collect()) == [10, 11]
    status = {r.shard: (r.expected, r.have, r.missing, r.complete) for r in recon.shard_status(flags, 10).collect()}
    assert status == {0: (4, 2, 0, True), 1: (2, 0, 2, False)}
    assert [r.num for r in recon.next_missing(flags, 1, 10).collect()] == [10]


def test_work_queue(spark):
    wanted, done = ids(spark, range(100)), ids(spark, range(0, 100, 2))
    assert [r.num for r in recon.work_queue(wanted, done, 10, 40, 3).collect()] == [11, 13, 15]
    shuffled = [r.num for r in recon.work_queue(wanted, done, 0, 99, None, seed=1).collect()]
    assert sorted(shuffled) == list(range(1, 100, 2)) and shuffled != sorted(shuffled)


def test_chunks(spark):
    df = spark.createDataFrame([("en", n) for n in range(0, 70, 2)] + [("de", 5)], "lang string, num long")
    rows = {(r.lang, r.chunk): (r.chunk_name, r.ids) for r in grouping.chunk_by_count(df, "lang", "num", 10, 16).collect()}
    assert rows == {("en", 0): ("0-18", 10), ("en", 1): ("20-38", 10), ("en", 2): ("40-58", 10),
                    ("en", 3): ("60-68", 5), ("de", 0): ("5-5", 1)}


def test_results_do_not_depend_on_partitions(spark):
    numbers = [n for n in range(2000) if n % 7 and n % 11]
    one = sequences.islands(ids(spark, numbers).coalesce(1), bucket=50)
    many = sequences.islands(ids(spark, numbers).repartition(8), bucket=50)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))

"""Posting lists and the search by them against plain searches."""

import itertools
import random
import re

from pyspark.sql import functions as F

from subtlake.operators import postings

TEXTS = [
    (1, "to be or not to be"), (2, "Be, to! be to be"), (3, None), (4, ""), (5, "... --"), (6, "not to be " * 40), (None, "to be"),
    (7, "a a a a"), (8, "a b a a b"), (8, "a b a a b"), (-3, "or not to"), (900, "x " * 5000 + "to be or not"),
]
PHRASES = [(1, '"to be"'), (2, '"not to be"'), (3, "a a"), (4, "a a b"), (5, "be"), (6, ""), (7, None), (8, "to nowhere"), (9, "BE to"),
           (10, '"to be"'), (11, "x to be or"), (12, "not to be not to be not"), (13, "a a a a a")]


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def searched(spark, width, span, tmp_path):
    blocks = postings.posting_blocks(spark.createDataFrame(TEXTS, "num long, text string"), "num", "text", width, span)
    postings.write_postings(blocks, f"{tmp_path}/lists")
    return spark.read.parquet(f"{tmp_path}/lists"), spark.createDataFrame(PHRASES, "query_id int, phrase string")


def test_search_equals_plain_search(spark, tmp_path):
    texts = {n: words(t) for n, t in TEXTS if n is not None}
    phrases, sets = {}, set()
    for q, p in PHRASES:
        wanted = words(p)
        for n, t in texts.items():
            starts = [i for i in range(len(t) - len(wanted) + 1) if t[i:i + len(wanted)] == wanted] if wanted else []
            if starts:
                phrases[q, n] = (len(starts), starts[0])
            if wanted and set(wanted) <= set(t):
                sets.add((q, n))
    for width, span in ((256, 1 << 16), (4, 8), (1, 3)):  # phrases run over the ends of stretches
        lists, queries = searched(spark, width, span, tmp_path / f"{width}-{span}")
        got = postings.phrase_hits(lists, queries, "phrase", width, span).collect()
        assert len(got) == len(phrases) and {(r.query_id, r.num): (r.hits, r["first"]) for r in got} == phrases
        hits = postings.word_hits(lists, queries, "phrase", width, span).collect()
        assert len(hits) == len(sets) and {tuple(r) for r in hits} == sets


def test_blocks_are_bounded_and_ordered(spark, tmp_path):
    lists, _ = searched(spark, 4, 8, tmp_path)
    rows = lists.collect()
    assert max(r.n for r in rows) <= 32 and all(r.n == len(r["at"]) == len(r.place) for r in rows)
    assert all(0 <= a < 4 and 0 <= p < 8 for r in rows for a, p in zip(r["at"], r.place))
    assert all(list(zip(r["at"], r.place)) == sorted(set(zip(r["at"], r.place))) for r in rows)
    assert all(r.low == r.block * 4 + r["at"][0] and r.high == r.block * 4 + r["at"][-1] for r in rows)
    assert len([r for r in rows if r.token == "x"]) == 5000 // 8  # a very frequent word has many lists
    spans = [(min(r[:3] for r in part), max(r[:3] for r in part)) for part in lists.rdd.glom().map(list).collect() if part]
    assert all(a[1] < b[0] for a, b in zip(sorted(spans), sorted(spans)[1:]))


def test_nothing_to_search(spark, tmp_path):
    lists, queries = searched(spark, 4, 8, tmp_path)
    assert postings.phrase_hits(lists.limit(0), queries, "phrase").count() == 0
    assert postings.word_hits(lists, queries.where(F.lit(False)), "phrase").count() == 0


def made_rows(frame):
    """Rows that the joins of a plan have given, with the plans of all stages it has run."""
    def walk(node):
        own = node.nodeName()
        children = [node.children().apply(i) for i in range(node.children().size())]
        if own.startswith("AdaptiveSparkPlan"):
            children = [node.executedPlan()]
        elif "QueryStage" in own:
            children = [node.plan()]
        held = [node.metrics().apply("numOutputRows").value()] if "Join" in own else []
        return held + [x for c in children for x in walk(c)]

    frame.collect()
    return max(walk(frame._jdf.queryExecution().executedPlan()), default=0)


def test_joins_do_not_multiply_queries_by_places(spark, tmp_path):
    """All texts are of the same 24 words, and very many phrases and sets of them are asked."""
    named = [f"w{i:02}" for i in range(24)]
    texts = {n: random.Random(n).sample(named, 12) for n in range(60)}
    rows = spark.createDataFrame([(n, " ".join(t)) for n, t in texts.items()], "num long, text string")
    postings.write_postings(postings.posting_blocks(rows, "num", "text"), f"{tmp_path}/lists")
    lists = spark.read.parquet(f"{tmp_path}/lists")
    phrases = dict(enumerate(itertools.permutations(named[:12], 3)))
    found = postings.phrase_hits(lists, spark.createDataFrame([(q, " ".join(p)) for q, p in phrases.items()], "query_id int, text string"), "text")
    held = sorted((q, n) for q, p in phrases.items() for n, t in texts.items() if any(tuple(t[i:i + 3]) == p for i in range(10)))
    assert made_rows(found) <= 2 * len(phrases) and sorted((r.query_id, r.num) for r in found.collect()) == held
    sets = dict(enumerate(itertools.combinations(named, 5)))
    found = postings.word_hits(lists, spark.createDataFrame([(q, " ".join(p)) for q, p in sets.items()], "query_id int, text string"), "text")
    held = sorted((q, n) for q, p in sets.items() for n, t in texts.items() if set(p) <= set(t))
    assert made_rows(found) <= len(held) + 5 * len(sets) and sorted(map(tuple, found.collect())) == held


def test_word_sets_of_a_long_text(spark, tmp_path):
    texts = spark.createDataFrame([(1, " ".join(f"a{i}" for i in range(1500))), (2, "a1 a2")], "num long, text string")
    postings.write_postings(postings.posting_blocks(texts, "num", "text", 4, 8), f"{tmp_path}/lists")
    asked = [(i, f"a{i} a{i + 1} a{(i * 7) % 1500} a{1499 - i}") for i in range(1499)] + [(5000, "a2 a1"), (5001, "a1 b")]
    got = postings.word_hits(spark.read.parquet(f"{tmp_path}/lists"), spark.createDataFrame(asked, "query_id long, text string"), "text", 4, 8)
    assert sorted(tuple(r) for r in got.collect()) == [(i, 1) for i in range(1499)] + [(5000, 1), (5000, 2)]


def moved_rows(frame):
    """Rows that the exchanges of a plan have written, in all stages it has run."""
    def walk(node):
        own = node.nodeName()
        children = [node.children().apply(i) for i in range(node.children().size())]
        if own.startswith("AdaptiveSparkPlan"):
            children = [node.executedPlan()]
        elif "QueryStage" in own:
            children = [node.plan()]
        held = node.metrics().apply("shuffleRecordsWritten").value() if own == "Exchange" else 0
        return held + sum(map(walk, children))

    rows = frame.collect()
    return rows, walk(frame._jdf.queryExecution().executedPlan())


def test_hits_of_word_sets_are_not_moved(spark, tmp_path):
    """There are far more hits than words in the texts; neither they nor the queries are dealt out with the texts."""
    named = [f"w{i:02}" for i in range(14)]
    texts = {n: random.Random(n).sample(named, 9) for n in range(50)}
    rows = spark.createDataFrame([(n, " ".join(t * 2)) for n, t in texts.items()], "num long, text string")
    postings.write_postings(postings.posting_blocks(rows, "num", "text"), f"{tmp_path}/lists")
    sets = dict(enumerate(itertools.combinations(named, 4)))
    asked = spark.createDataFrame([(q, " ".join(p)) for q, p in sets.items()], "query_id int, text string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got, moved = moved_rows(postings.word_hits(spark.read.parquet(f"{tmp_path}/lists"), asked, "text"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    held = sorted((q, n) for q, p in sets.items() for n, t in texts.items() if set(p) <= set(t))
    assert sorted(map(tuple, got)) == held and moved <= 50 * 9 < len(held)


def test_word_sets_in_many_parts(spark, tmp_path, monkeypatch):
    """Texts, sets, candidates and hits that are worked on in small parts; queries that come twice, without an id, or very often."""
    for name, value in (("SETS", 40), ("TEXTS", 30), ("_STEP", 16)):
        monkeypatch.setattr(postings, name, value)
    named = [f"w{i}" for i in range(12)]
    texts = [(n - 20, " ".join(random.Random(n).choices(named, k=n % 23))) for n in range(90)]
    postings.write_postings(postings.posting_blocks(spark.createDataFrame(texts, "num long, text string"), "num", "text", 16, 4), f"{tmp_path}/lists")
    asked = [(f"q{i}", " ".join(random.Random(-i).choices(named, k=i % 5))) for i in range(60)]
    asked += asked[7:9] + [(None, "w1 w2")] + [(f"often{i}", "w3, W3 w5") for i in range(50)] + [("unknown", "w1 x"), ("null", None)]
    got = postings.word_hits(spark.read.parquet(f"{tmp_path}/lists"), spark.createDataFrame(asked, "query_id string, text string"), "text", 16, 4)
    held = [(q, n) for q, p in asked for n, t in texts if words(p) and set(words(p)) <= set(words(t))]
    order = lambda r: (r[0] or "", r[1])
    assert got.schema["query_id"].dataType.simpleString() == "string"
    assert sorted(map(tuple, got.collect()), key=order) == sorted(held, key=order)


def test_words_of_equal_numbers_get_others(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(postings, "_word", lambda token, seed: F.pmod(F.xxhash64(F.lit(seed), token), F.lit(40)))
    texts = spark.createDataFrame([(i, f"w{i} w{(i + 1) % 12}") for i in range(12)], "num long, text string")
    postings.write_postings(postings.posting_blocks(texts, "num", "text"), f"{tmp_path}/lists")
    asked = spark.createDataFrame([(i, f"w{i}") for i in range(12)] + [(20, "x1"), (21, "x2")], "query_id int, text string")
    got = postings.word_hits(spark.read.parquet(f"{tmp_path}/lists"), asked, "text")
    assert sorted(map(tuple, got.collect())) == sorted((i, n) for i in range(12) for n in (i, (i - 1) % 12))


def test_posting_lists_take_one_shuffle(spark):
    blocks = postings.posting_blocks(spark.createDataFrame(TEXTS, "num long, text string"), "num", "text")
    plan = blocks.sortWithinPartitions("token")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange rangepartitioning(token" in plan


def test_lists_written_in_parts(spark, tmp_path):
    rows = spark.createDataFrame(TEXTS + [(n, f"w{n % 90} to be w{n % 7}") for n in range(1000, 1400)], "num long, text string")
    blocks = postings.posting_blocks(rows, "num", "text", 4, 8)
    cuts = postings.token_cuts(rows, "text", 3)
    assert 1 <= len(cuts) <= 2 and cuts == sorted(cuts)
    postings.write_postings(blocks, f"{tmp_path}/whole")
    whole = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/whole").collect()))
    for i, some in enumerate((cuts, ["to"], ["", "be", "~"])):
        postings.write_postings(blocks, f"{tmp_path}/{i}", some)
        assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/{i}").collect())) == whole
    none = rows.limit(0)
    assert postings.token_cuts(none, "text", 3) == []

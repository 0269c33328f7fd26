"""Manifest, near-duplicate vectors and divergences against plain versions, and their defined results in odd cases."""

import hashlib
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from subtlake.llm import divergence, graph, manifest, quality, vectors, vocabulary

SF = "/root/testdata/sf0.001"


# manifest

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha(*last[i:i + 8]) for i in range(0, len(last), 8)])
    return levels


def plain_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text); per row what the operator gives, and the tampered leaf."""
    def leaf(row):
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])

    groups = defaultdict(list)
    for row in rows:
        chosen = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
        text = row[4] and "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
        groups[row[2]].append(((row[0] is not None, row[0] or 0, leaf(row)), leaf((*row[:4], text)) if chosen else leaf(row), row[0]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([x[0][2] for x in sorted(groups[g])]) for g in names}
    top = plain_tree([trees[g][-1][0] for g in names])
    out = []
    for place, g in enumerate(names):
        for at, ((_, _, own), now, key) in enumerate(sorted(groups[g])):
            proof, node = [], now
            for levels, i in ((trees[g], at), (top, place)):
                for level in levels[:-1]:
                    run = range(i // 8 * 8, min(len(level), i // 8 * 8 + 8))
                    proof += [level[j] for j in run if j != i]
                    node = sha(*[node if j == i else level[j] for j in run])
                    i //= 8
            out.append((key, own, trees[g][-1][0], top[-1][0], sha(*proof), node, node == top[-1][0]))
    return sorted(out, key=repr)


CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def spark_manifest(df):
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = manifest.manifest(df, tampered={"text": F.when(chosen, F.translate("text", CAPITALS, CAPITALS.lower()))})
    found = found.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256), "folded_root", "verified")
    return sorted((tuple(r) for r in found.collect()), key=repr)


def docs(spark, rows):
    """With columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, "x", 1, "y", 2, "z") for r in rows],
                                 "doc_id long, source string, lang string, n_chars long, text string, g string, at int, hash string, id long, path string")


def test_manifest_equals_plain_trees(spark):
    rng = np.random.RandomState(4)
    # over one block, blocks with a last run of one, single rows, null and empty languages, nulls, repeated keys and rows, long texts
    rows = [(int(i), f"s{i % 7}", "en", 5, f"Text {i} É") for i in rng.permutation(4 * 512 + 1)]
    rows += [(10_000 + i, None, "de", None, "Ab" * i) for i in range(65)] + [(20_000, "s", "", 3, "One"), (20_001, "s", None, 3, None)]
    rows += [(None, None, "de", None, None), (None, "s", "de", 1, "Q"), (7, "s", "fr", 1, "A"), (7, "s", "fr", 1, "B"), (7, "s", "fr", 1, "B")]
    rows += [(30_000 + i, "s", f"l{i}", 1, "X " * 100_000 if i == 3 else "") for i in range(9)]
    got = spark_manifest(docs(spark, rows).repartition(5))
    assert got == plain_manifest(rows)
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_few_rows(spark):
    assert spark_manifest(docs(spark, [])) == []
    one = [(1, "s", "en", 2, "Hi")]
    assert spark_manifest(docs(spark, one)) == plain_manifest(one)


# vectors

def plain_links(rows, least=0.93):
    """key -> (links, component), rows that repeat a key as rows of their own."""
    def ok(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n, group = [0] * len(rows), list(range(len(rows)))
    units = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok(v) else None for _, v, _ in rows]

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, (_, v, a) in enumerate(rows):
        for j in range(i):
            if a is not None and a == rows[j][2] and units[i] is not None and units[j] is not None and len(v) == len(rows[j][1]):
                if units[i] @ units[j] >= least or list(v) == list(rows[j][1]):
                    n[i], n[j] = n[i] + 1, n[j] + 1
                    group[root(i)] = root(j)
    low = defaultdict(list)
    for i, (key, _, _) in enumerate(rows):
        low[root(i)].append(key)
    smallest = {g: min((k for k in keys if k is not None), default=None) for g, keys in low.items()}
    return sorted(((key, n[i], smallest[root(i)]) for i, (key, _, _) in enumerate(rows)), key=repr)


def planted(rng, dimension=32):
    """Groups of near copies, a lump larger than a cluster, chains, copies, and vectors on their own."""
    def near(base, n, spread):
        return [base + spread * rng.randn(dimension) / np.sqrt(dimension) for _ in range(n)]

    out = []
    for base in rng.randn(60, dimension):
        out += [(v, 1) for v in near(base, rng.randint(1, 6), 0.2 * np.linalg.norm(base))]
    lump = rng.randn(dimension)
    out += [(v, 1) for v in near(lump, 150, 0.2 * np.linalg.norm(lump))] + [(lump, 1)] * 40 + [(lump, 2)] * 3
    chain = [rng.randn(dimension)]
    for _ in range(15):
        chain += near(chain[-1], 1, 0.3 * np.linalg.norm(chain[-1]))
    return out + [(v, 1) for v in chain]


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.RandomState(8)
    some = planted(rng)
    rows = [(int(k), [float(np.float32(x)) for x in v], label) for k, (v, label) in zip(rng.permutation(len(some)), some)]
    odd = [1.0] + [0.0] * 31
    rows += [(-1, None, 1), (-2, [], 1), (-3, [0.0] * 32, 1), (-4, [float("nan")] + odd[1:], 1), (-5, [float("inf")] + odd[1:], 1), (-6, [None] + odd[1:], 1),
             (-7, odd, None), (-8, odd, None), (None, odd, 3), (-9, odd, 3), (-9, odd, 3), (-10, [2.0 * x for x in odd], 3), (None, odd, 4), (-11, [1.0, 0.0], 3)]
    frame = spark.createDataFrame([(k, v, a, 1, "x", 2, 3) for k, v, a in rows],
                                  "vec_id long, embedding array<float>, label int, node long, shard string, links long, x int").repartition(3)
    want = plain_links(rows)
    for size in (64, 4096):  # cut into clusters, the lump dealt out; each label in one
        got = vectors.near_vectors(frame, size=size)
        assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
        got = got.collect()
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)
        links = sum(r.n_links for r in got)
        true = sum(w[1] for w in want)
        assert 0.97 * true <= links <= true
        if size == 4096:
            assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == want
    assert vectors.near_vectors(frame.limit(0)).count() == 0


def test_graph_reaches_all_near_vectors():
    rng = np.random.RandomState(2)
    x = np.array([v for v, label in planted(rng, 48) if label == 1])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = np.unique(x, axis=0)
    near = graph.build(x, 16, 24, 1.2)
    assert (near >= 0).sum(axis=1).max() <= 16 and all(i not in set(row) for i, row in enumerate(near))
    offsets, ties = graph.both_ways(near)
    wide = np.full((len(x), np.diff(offsets).max()), -1)
    for i in range(len(x)):
        wide[i, :offsets[i + 1] - offsets[i]] = ties[offsets[i]:offsets[i + 1]]
    walk = graph.Walk(x, wide, x, graph.medoid(x), 24)
    walk.expand(0.83)
    rows, ids, sims = walk.found()
    assert len(set(zip(rows.tolist(), ids.tolist()))) == len(rows)
    assert (sims >= 0.93).sum() >= 0.97 * (x @ x.T >= 0.93).sum()


def test_dense_shards_take_little_memory():
    rng = np.random.RandomState(3)
    x = 1 + 0.3 * rng.standard_normal((512, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tracemalloc.start()
    near = graph.build(x, 16, 24, 1.2)
    offsets, ties = graph.both_ways(near)
    wide = np.full((len(x), np.diff(offsets).max()), -1)
    for i in range(len(x)):
        wide[i, :offsets[i + 1] - offsets[i]] = ties[offsets[i]:offsets[i + 1]]
    walk = graph.Walk(x, wide, x, graph.medoid(x), 24)
    walk.expand(0.83)
    rows, ids, sims = walk.found()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(rows) == len(x) ** 2  # each vector is like each
    assert np.allclose(sims, (x @ x.T)[rows, ids], rtol=0, atol=1e-12)
    assert most < 100 << 20


# divergence

def test_transducer_numbers_sorted_terms():
    rng = np.random.RandomState(5)
    terms = sorted({bytes(rng.choice(list(b"abc\xc3\xa9"), rng.randint(1, 9)).tolist()) for _ in range(800)} | {b"a", b"ab", b"abc", b"z" * 500})
    machine = vocabulary.build(terms)
    # minimal: states are as many as different sets of endings
    ends = defaultdict(set)
    for t in terms:
        for i in range(len(t) + 1):
            ends[t[:i]].add(t[i:])
    assert len(machine.first) == len({frozenset(e) for e in ends.values()})
    words = terms + [b"abd", b"zz", b"q", b"abcabcabcabc", b"z" * 501, b"\xff"]
    data = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    again = vocabulary.joined([vocabulary.load(machine.dump(), int(machine.root[0])), machine])
    for m, root in ((machine, machine.root[0]), (again, again.root[0]), (again, again.root[1])):
        got = vocabulary.numbers(m, data, end - [len(w) for w in words], end, np.full(len(words), root))
        assert got.tolist() == [terms.index(w) if w in ends and w in set(terms) else -1 for w in words]
    assert vocabulary.numbers(vocabulary.build([]), data, end[:1] * 0, end[:1], np.zeros(1, int)).tolist() == [-1]


def plain_divergences(rows, least, top=10):
    rows = [(text or "", lang or "", source or "") for text, lang, source in rows]
    words = [[re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)] for text, _, _ in rows]
    out = []
    for lang in {r[1] for r in rows}:
        held = Counter(w for own, r in zip(words, rows) if r[1] == lang for w in set(own))
        kept = sorted((w for w, n in held.items() if n >= least), key=lambda w: w.encode())
        counts = {s: Counter() for s in {r[2] for r in rows if r[1] == lang}}
        for own, r in zip(words, rows):
            if r[1] == lang:
                counts[r[2]].update(w for w in own if held[w] >= least)

        def shares(c):
            return {w: 1 + 1_000_000_000 * (c[w] + 2) // (sum(c.values()) + 2 * len(kept)) for w in kept}

        of = {s: shares(c) for s, c in counts.items()}
        whole = shares(sum(counts.values(), Counter()))
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for s, p in of.items():
            pairs = [(t, sum(f(p[w], q[w]) for w in kept)) for t, q in of.items() if t != s]
            best = [(w, f(p[w], whole[w])) for w in kept if counts[s][w] and p[w] > whole[w]]
            for part, items, most in (("pair", pairs, None), ("term", best, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(items[:most])]
    return sorted(out)


def test_divergences_equal_a_plain_version(spark):
    rng = np.random.RandomState(6)
    words = ["One", "two", "été", "naïve", "x1y", "ZZ", "a", "ab", "b" * 5000, "日本", "日", "k\u212a"] + [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9)]
    rows = []
    for i in range(260):
        lang = "en" if rng.rand() < 0.5 else [None, "", "de", "fr"][rng.randint(4)]
        source = "hot" if rng.rand() < 0.4 else [None, "", "s1", "s2", "ünï", "s3"][rng.randint(6)]
        rows.append((" ".join(rng.choice(words, rng.randint(0, 30))) if i % 17 else None, lang, source))
    rows += [("Two  TWO two", "en", "s9"), ("...", "en", "nothing"), (None, "xx", "one"), ("once", "xx", "two")] + [rows[0]] * 3 + [("two " * 30_000, "en", "hot")]
    frame = spark.createDataFrame([(i, *r, 1, "t", 2, "i") for i, r in enumerate(rows)],
                                  "doc_id long, text string, lang string, source string, ord long, term string, n long, item string").repartition(3)
    want = plain_divergences(rows, 5)
    assert {r[2] for r in want} == {"pair", "term"}
    # small stretches, blocks and tiles; and the usual ones
    for options in ({"stretch": 7, "most": 4000, "tile": 3, "cells": 16}, {}):
        got = divergence.divergences(frame, least=5, **options)
        assert sorted(tuple(r) for r in got.collect()) == want
    none = divergence.divergences(frame, least=1000)
    assert sorted(tuple(r) for r in none.collect()) == plain_divergences(rows, 1000)
    assert divergence.divergences(frame.limit(0)).count() == 0


# quality: what views exchange

def test_rounds_teach_where_labels_are_few_and_cost_nothing_where_they_are_many(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    judged = labels.where("pmod(xxhash64(doc_id, 'outer'), 4) = 0").withColumn("y", F.expr("quality = 1 and toxic = 0"))
    given = labels.where("pmod(xxhash64(doc_id, 'outer'), 4) <> 0")

    def loss(labelled, rounds):
        scored = quality.score_quality(docs, labelled, rounds=rounds).join(judged, "doc_id")
        return scored.agg(F.avg(-F.log(F.greatest(F.lit(1e-6), F.expr("if(y, score, 1 - score)"))))).first()[0]

    few = given.where("pmod(xxhash64(doc_id, 'p'), 5) = 0")
    assert loss(few, 2) <= loss(few, 0)
    assert loss(given, 2) <= loss(given, 0) + 0.005


def test_pseudo_labels_keep_the_balance_and_stay_bounded():
    own, taught = np.zeros((quality.BUCKETS + 1, 2)), np.zeros((quality.BUCKETS + 1, 2))
    own[-1], taught[-1] = (100, 300), (40, 9000)
    assert np.allclose(quality._weights(own, taught, 0.25) * taught[-1], (25, 75))
    assert np.allclose(quality._weights(own, taught, 1.0) * taught[-1], (40, 120))
    taught[-1] = (0, 9000)  # one class alone teaches nothing
    assert (quality._weights(own, taught, 1.0) * taught[-1] == 0).all()
    cells = np.zeros(len(quality._STEPS), int)
    cells[[0, 10, 790, 800]] = 30, 30, 30, 30
    assert quality._edges(cells, 0.4, 0.0) == (0, 800)  # 24 each: the outermost step reaches them
    assert quality._edges(cells, 0.6, 0.0) == (10, 790)

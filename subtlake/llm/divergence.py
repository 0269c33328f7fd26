"""How the sources of a language differ in their words: exact divergences of smoothed term shares.

A first reading of the texts finds the terms to keep. They are numbered in sorted order and cut into stretches, and each stretch becomes
a minimal acyclic transducer (``vocabulary``). A second reading streams the texts through the transducers and counts by number. Blocks
of transducers of a bounded size are sent to the tasks, with a reading for each block.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subtlake.llm import vocabulary
from subtlake.llm.common import stored
from subtlake.llm.tokens import bounded_batches, scan, slices
from subtlake.operators.numbering import Descending, number_rows

#: Letters and everything beyond ASCII are in terms.
SEPARATORS = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
SCALE = 1_000_000_000
SLICE = 1 << 20  # bytes of text worked on at a time


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes without separators, start and end of each word, and its row."""
    words = scan(texts, SEPARATORS, lower=True)
    plain = np.frombuffer(words.plain, np.uint8)
    mask = np.ones(len(plain), bool)
    mask[words.end] = False
    end = np.cumsum(words.end - words.start)
    return plain[mask], end - (words.end - words.start), end, words.doc()


def _as_array(data: np.ndarray, end: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], end]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(end), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


def _pooled(batches: Iterator[pa.RecordBatch], most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Counts ``n`` of equal keys added up within a task, as far as ``most`` rows reach."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size > most:
            added = _added(held)
            held, size = [added], len(added)
            if size > most // 2:
                yield added
                held, size = [], 0
    if size:
        yield _added(held)


def _added(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    names = batches[0].schema.names
    table = pa.Table.from_batches(batches).group_by(names[:-1]).aggregate([("n", "sum")])
    return table.rename_columns({"n_sum": "n"}).select(names).combine_chunks().to_batches()[0]


def kept_terms(docs: DataFrame, least: int = 10) -> DataFrame:
    """``lang``, ``term`` (UTF-8): the terms in at least ``least`` of a language's rows of ``docs`` (lang, text)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=SLICE):
                data, _, end, doc = _words(part.column("text"))
                coded = _as_array(data, end).dictionary_encode()
                langs = part.column("lang").dictionary_encode()
                term, lang, size = np.asarray(coded.indices), np.asarray(langs.indices).astype(np.int64), max(1, len(coded.dictionary))
                # once per row, then rows by language
                row, term = np.divmod(np.unique(doc.astype(np.int64) * size + term), size)
                pairs, n = np.unique(lang[row] * size + term, return_counts=True)
                of, term = (pa.array(x) for x in np.divmod(pairs, size))
                yield pa.RecordBatch.from_arrays([langs.dictionary.take(of), coded.dictionary.take(term).cast(pa.binary()), pa.array(n)], ["lang", "term", "n"])

    found = docs.select("lang", "text").mapInArrow(lambda batches: _pooled(count(batches)), "lang string, term binary, n long")
    return found.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("lang", "term")


def transducers(terms: DataFrame, stretch: int) -> DataFrame:
    """``lang``, ``stretch``, ``low`` (its first term), ``root``, ``parts``, ``bytes``: a transducer for each ``stretch`` terms in order.

    ``terms`` (lang, term, ord from 0). A task holds the terms of one stretch."""
    def make(key: tuple, table: pa.Table) -> pa.Table:
        words = table.sort_by("ord").column("term").to_pylist()
        machine = vocabulary.build(words)
        parts = machine.dump()
        return pa.table({"lang": pa.array([key[0].as_py()], pa.string()), "stretch": pa.array([key[1].as_py()], pa.int64()), "low": pa.array([words[0]], pa.binary()),
                         "root": pa.array([int(machine.root[0])], pa.int64()), "parts": pa.array([parts], pa.list_(pa.binary())),
                         "bytes": pa.array([sum(map(len, parts))], pa.int64())})

    cut = terms.withColumn("stretch", F.floor(F.col("ord") / stretch).cast("long"))
    return cut.groupBy("lang", "stretch").applyInArrow(make, "lang string, stretch long, low binary, root long, parts array<binary>, bytes long")


class _Block:
    """Some transducers of several languages, and the way from a word to its stretch."""

    def __init__(self, rows: list, stretch: int):
        self.machine = vocabulary.joined([vocabulary.load(r["parts"], r["root"]) for r in rows])
        self.langs: dict[str, list[int]] = {}
        for i, r in enumerate(rows):
            self.langs.setdefault(r["lang"], []).append(i)
        self.low = {lang: [bytes(rows[i]["low"]) for i in of] for lang, of in self.langs.items()}
        self.heads = {lang: _heads_of(low) for lang, low in self.low.items()}
        self.offset = np.array([r["stretch"] * stretch for r in rows], np.int64)

    def number(self, lang: str, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        low, heads = self.low[lang], self.heads[lang]
        # the last stretch that does not begin behind the word: by the first 8 bytes, by all where these do not tell
        head = _head(data, start, end)
        place = np.searchsorted(heads, head, side="right") - 1
        unsure = np.flatnonzero((place >= 0) & (heads[np.maximum(place, 0)] == head))
        if len(low) > 1:
            for i in unsure.tolist():
                place[i] = bisect.bisect_right(low, data[start[i]:end[i]].tobytes()) - 1
        out = np.full(len(start), -1, np.int64)
        some = np.flatnonzero(place >= 0)
        of = np.array(self.langs[lang])[place[some]]
        found = vocabulary.numbers(self.machine, data, start[some], end[some], self.machine.root[of])
        out[some] = np.where(found < 0, -1, found + self.offset[of])
        return out


def _head(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The first 8 bytes of each word as a number that sorts like them."""
    out = np.zeros(len(start), np.uint64)
    for i in range(8):
        inside = start + i < end
        byte = np.zeros(len(start), np.uint64)
        byte[inside] = data[start[inside] + i]
        out = (out << np.uint64(8)) | byte
    return out


def _heads_of(words: list[bytes]) -> np.ndarray:
    return np.array([int.from_bytes(w[:8].ljust(8, b"\0"), "big") for w in words], np.uint64)


def _blocks(machines: DataFrame, most: int) -> Iterator[list]:
    """Lists of transducers of at most ``most`` bytes together (or one), in order; the driver holds one list at a time."""
    sizes = machines.select("lang", "stretch", "bytes").orderBy("lang", "stretch").collect()  # a row for each stretch
    begin, total = 0, 0
    for i, r in enumerate([*sizes, None]):
        if r is None or (total and total + r["bytes"] > most):
            wanted = machines.sparkSession.createDataFrame(sizes[begin:i]).select("lang", "stretch") if i > begin else None
            if wanted is not None:
                yield sorted(machines.join(F.broadcast(wanted), ["lang", "stretch"], "left_semi").collect(), key=lambda x: (x["lang"], x["stretch"]))
            begin, total = i, 0
        if r is not None:
            total += r["bytes"]


def recount(docs: DataFrame, machines: DataFrame, stretch: int, most: int) -> DataFrame:
    """``lang``, ``source``, ``ord``, ``n``: occurrences of the kept terms, by streaming each text through the transducers."""
    context = docs.sparkSession.sparkContext
    found = None
    for rows in _blocks(machines, most):
        block = context.broadcast(rows)

        def count(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            own = _Block(block.value, stretch)
            for batch in batches:
                for part in slices(batch, most=SLICE):
                    yield from _count(own, part)

        more = docs.select("lang", "source", "text").mapInArrow(lambda batches, count=count: _pooled(count(batches)), "lang string, source string, ord long, n long")
        found = more if found is None else found.unionAll(more)
    if found is None:
        return docs.sparkSession.createDataFrame([], "lang string, source string, ord long, n long")
    return found.groupBy("lang", "source", "ord").agg(F.sum("n").alias("n"))


def _count(block: _Block, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Occurrences by language, source and number. A word that comes again in the slice has gone through the transducer already."""
    data, start, end, doc = _words(part.column("text"))
    langs, sources = part.column("lang").dictionary_encode(), part.column("source").dictionary_encode()
    lang_of, source_of = (np.asarray(x.indices).astype(np.int64) for x in (langs, sources))
    for i, lang in enumerate(langs.dictionary.to_pylist()):
        if lang not in block.langs:
            continue
        mine = np.flatnonzero(lang_of[doc] == i)
        words = _as_array(data, end).take(pa.array(mine)).dictionary_encode()
        which, first = np.asarray(words.indices), np.zeros(len(words.dictionary), np.int64)
        first[which[::-1]] = mine[::-1]
        number = block.number(lang, data, start[first], end[first])[which]
        hit = number >= 0
        size = int(number.max(initial=0)) + 1
        pairs, n = np.unique(source_of[doc[mine[hit]]] * size + number[hit], return_counts=True)
        source, number = np.divmod(pairs, size)
        yield pa.RecordBatch.from_arrays([pa.array([lang]).take(pa.array(np.zeros(len(n), np.int64))), sources.dictionary.take(pa.array(source)),
                                          pa.array(number), pa.array(n)], ["lang", "source", "ord", "n"])


def _share(n: str, total: str, kept: str):
    """1 + floor(1e9 (n + 2) / (total + 2 kept)), exact: the product may leave 64 bits."""
    return F.expr(f"1L + (cast({SCALE} as decimal(10)) * (cast({n} as decimal(20)) + 2)) div (cast({total} as decimal(20)) + 2 * cast({kept} as decimal(20)))")


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)): shares are at most 1e9 + 1, so the square fits 64 bits."""
    return (p - q) * (p - q) // (p + q)


def divergences(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = 10, top: int = 10,
                stretch: int = 1 << 15, most: int = 64 << 20, tile: int = 64, cells: int = 4096) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: each source of a language against the others and against the language.

    Null texts, languages and sources are empty ones. Terms are runs of letters and of characters beyond ASCII, A-Z in lower case; a
    language keeps those in ``least`` of its rows. With a group's count n of a term, N of all kept ones and V kept terms, the share is
    p = 1 + floor(1e9 (n + 2) / (N + 2 V)), and f = floor((p - q)^2 / (p + q)).

    ``pair``: the sum of f over all kept terms against each other source of the language (0 without kept terms). ``term``: the ``top``
    terms whose share in the source is above that in the language. Ranks go by value from the greatest, then by item; a kept term's
    place among terms is its number in the transducer. Sources and languages without terms take part; rows that repeat count again; no
    rows give no rows. Other columns of ``docs`` are not read.

    ``stretch`` terms make a transducer; transducers of up to ``most`` bytes are sent at once, with a reading of the texts for each
    such block. Pairs are worked on in tiles of ``tile`` by ``tile`` sources and ``cells`` terms.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))])
    groups = stored(rows.select("lang", "source").distinct(), "groups")
    terms = stored(kept_terms(rows, least), "terms")
    terms = number_rows(terms, ["lang"], [F.col("term")], "ord").withColumn("ord", F.col("ord") - 1)
    terms = stored(terms, "numbered")
    machines = stored(transducers(terms, stretch), "transducers")
    counts = stored(recount(rows, machines, stretch, most), "counts")
    kept = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # numbers of a language's sources in sorted order, and the share of a term that a source does not have
    numbered = number_rows(groups, ["lang"], [F.col("source")], "s").join(totals, ["lang", "source"], "left").join(kept, "lang", "left")
    numbered = numbered.select("lang", "source", (F.col("s") - 1).alias("s"), F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"))
    numbered = stored(numbered.withColumn("none", F.when(F.col("kept") > 0, _share("0", "total", "kept"))), "sources")
    shares = counts.join(numbered, ["lang", "source"]).withColumn("p", _share("n", "total", "kept"))
    pairs = _pairs(shares, numbered, kept, tile, cells)
    named = numbered.select("lang", "s", "source")
    other = named.select("lang", F.col("s").alias("t"), F.col("source").alias("item"))
    pairs = named.join(other, "lang").where("s <> t").join(pairs, ["lang", "s", "t"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    pairs = number_rows(stored(pairs, "pairs"), ["lang", "source"], [Descending(F.col("value")), F.col("item")], "rank")
    # terms against the language
    whole = counts.groupBy("lang", "ord").agg(F.sum("n").alias("n"))
    sums = whole.groupBy("lang").agg(F.sum("n").alias("total"))
    whole = whole.join(sums, "lang").join(kept, "lang").select("lang", "ord", _share("n", "total", "kept").alias("q"))
    over = shares.select("lang", "source", "ord", "p").join(whole, ["lang", "ord"]).where("p > q")
    over = over.withColumn("value", F.expr("(p - q) * (p - q) div (p + q)"))
    place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ord")
    best = over.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
    best = best.join(terms, ["lang", "ord"]).select("lang", "source", F.lit("term").alias("part"), F.decode("term", "UTF-8").alias("item"), "value", "rank")
    return pairs.select(*best.columns).withColumn("rank", F.col("rank").cast("int")).unionAll(best)


def _pairs(shares: DataFrame, numbered: DataFrame, kept: DataFrame, tile: int, cells: int) -> DataFrame:
    """``lang``, ``s``, ``t``, ``value`` for both orders of each two sources: the sums of f over all kept terms.

    Sources are cut into runs of ``tile`` and terms into runs of ``cells``. Each two runs of sources and each run of terms with any
    count meet in a task of their own, as dense matrices; terms that no source of the two has are added by their number.
    """
    runs = numbered.groupBy("lang").agg(F.floor(F.max("s") / tile).alias("last"))
    mine = F.floor(F.col("s") / tile)
    others = F.sequence(F.lit(0).cast("long"), F.col("last"))
    dealt = shares.join(runs, "lang").select("lang", "s", "ord", "p", mine.alias("run"), F.explode(others).alias("other"))
    dealt = dealt.select("lang", F.least("run", "other").alias("a"), F.greatest("run", "other").alias("b"), F.floor(F.col("ord") / cells).alias("c"), "s",
                         (F.col("ord") % cells).alias("o"), "p")
    # what each source has for terms without a count, and how many terms a run has
    tiles = numbered.where("kept > 0").join(runs, "lang").select("lang", "kept", "s", "none", mine.alias("run"), F.explode(others).alias("other"))
    tiles = tiles.groupBy("lang", F.least("run", "other").alias("a"), F.greatest("run", "other").alias("b")).agg(
        F.max("kept").alias("kept"), F.array_sort(F.collect_list(F.struct("s", "none"))).alias("sources"))
    tiles = tiles.withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("kept") - 1) / cells))))

    def add(key: tuple, found: pa.Table, tile_: pa.Table) -> pa.Table:
        if not len(tile_):
            raise ValueError("a count without its sources")
        c, total = key[3].as_py(), tile_.column("kept")[0].as_py()
        sources = {r["s"]: r["none"] for r in tile_.column("sources")[0].as_py()}
        ids = np.array(sorted(sources), np.int64)
        width = min(cells, total - c * cells)
        table = np.repeat(np.array([sources[i] for i in ids.tolist()], np.int64)[:, None], width, axis=1)
        if len(found):
            table[np.searchsorted(ids, found.column("s").to_numpy()), found.column("o").to_numpy()] = found.column("p").to_numpy()
        left = np.flatnonzero(ids // tile == key[1].as_py())
        right = np.flatnonzero(ids // tile == key[2].as_py())
        s, t, value = [], [], []
        for i in left.tolist():
            of = right if key[1].as_py() != key[2].as_py() else right[right > i]
            value.append(_distance(table[i], table[of]).sum(axis=1))
            s.append(np.full(len(of), ids[i]))
            t.append(ids[of])
        s, t, value = (np.concatenate(x).astype(np.int64) for x in (s, t, value))
        return pa.table({"lang": pa.array([key[0].as_py()] * len(s), pa.string()), "s": s, "t": t, "value": value})

    keys = ["lang", "a", "b", "c"]
    sums = dealt.groupBy(*keys).cogroup(tiles.groupBy(*keys)).applyInArrow(add, "lang string, s long, t long, value long")
    sums = stored(sums.groupBy("lang", "s", "t").agg(F.sum("value").alias("value")), "sums")
    return sums.unionAll(sums.select("lang", F.col("t").alias("s"), F.col("s").alias("t"), "value"))

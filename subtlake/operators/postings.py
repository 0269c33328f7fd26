"""Posting lists with positions, in blocks of bounded size, and the search for phrases and word sets by them."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from subtlake.functions.text import fts_tokens, phrase_text
from subtlake.operators.bits import bit_filter, bits_of, passes
from subtlake.session import release_shuffles, scratch_path, shuffle_partitions, stored
from subtlake.sources.listing import opened

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILTER_BITS = 26
COMMON = 1 << 16  # a word is common if it has one of so many entries; there are at most so many such words
SETS = 1 << 21  # words of the sets that a task holds at a time
TEXTS = 1 << 20  # words of the texts that a task holds at a time
_STEP = 1 << 17  # candidates worked on at a time
WIDTH = 256  # ids of a block
SPAN = 1 << 16  # words of a text that lie in one stretch
ORDER = ["token", "block", "stretch"]  # of posting lists


def posting_blocks(texts: DataFrame, num: str, text: str, width: int = WIDTH, span: int = SPAN) -> DataFrame:
    """(token, block, stretch, low, high, n, at, place): where each word stands in the texts.

    A block holds the ids ``block * width`` to ``(block + 1) * width - 1``, a stretch ``span`` words of each of their texts, so a list
    has at most ``width * span`` entries however frequent its word is. ``at`` (id) and ``place`` (position, from 0) count from the
    start of the block and of the stretch, in ascending order; ``low`` and ``high`` are the first and last id, ``n`` the entries.
    Ids are unique: equal rows count once. Null ids, null texts and texts without words have no entries.
    """
    words = texts.where(F.col(num).isNotNull()).select(F.col(num).cast("long").alias("num"), F.posexplode(fts_tokens(F.col(text))).alias("pos", "token"))
    entry = F.pmod("num", F.lit(width)) * F.lit(span).cast("long") + F.pmod("pos", F.lit(span))
    places = words.select("token", F.floor(F.col("num") / width).alias("block"), F.expr(f"int(pos div {span})").alias("stretch"), entry.alias("entry"))
    # dealt out once, in the order they are written in: grouping needs no other shuffle
    lists = places.repartitionByRange(*ORDER).groupBy(*ORDER).agg(F.array_sort(F.collect_set("entry")).alias("entries"))
    at, place = (lambda e: F.floor(e / F.lit(span)).cast("int")), (lambda e: F.pmod(e, F.lit(span)).cast("int"))
    start = F.col("block") * width
    return lists.select(
        *ORDER, (start + at(F.element_at("entries", 1))).alias("low"), (start + at(F.element_at("entries", -1))).alias("high"),
        F.size("entries").alias("n"), F.transform("entries", at).alias("at"), F.transform("entries", place).alias("place"))


def token_cuts(texts: DataFrame, text: str, parts: int) -> list[str]:
    """At most ``parts - 1`` tokens that cut the words of the texts into about even parts, from the first words of some 2000 texts."""
    every = max(1, texts.count() // 2000)
    some = texts.where(F.pmod(F.xxhash64(text), F.lit(every)) == 0).limit(4000)
    words = some.select(F.explode(F.slice(fts_tokens(F.col(text)), 1, 64)).alias("token")).agg(F.array_sort(F.collect_list("token")).alias("w"))
    at = [F.get("w", F.floor(F.size("w") * F.lit(i) / F.lit(parts)).cast("int")).alias(f"c{i}") for i in range(1, parts)]
    return sorted({token for token in words.select(*at).first() if token is not None})


def write_postings(blocks: DataFrame, path: str, cuts: list[str] | tuple[str, ...] = ()) -> None:
    """The blocks in the order of tokens and ids, as ``posting_blocks`` has dealt them; those of a frequent word are spread over files.

    With ``cuts``, the tokens below, between and from them on are written one part after the other, so that only the words of a part
    lie on disk beside the lists.
    """
    token = F.col("token")
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = blocks.where((token >= low if low is not None else F.lit(True)) & (token < high if high is not None else F.lit(True)))
        part.sortWithinPartitions(*ORDER).write.mode("append").option("compression", "zstd").parquet(path)
        release_shuffles(blocks.sparkSession)


def _asked(queries: DataFrame, words: Column) -> DataFrame:
    """Queries with their ``words`` and a key of them; queries without a word can have no hit."""
    rows = queries.withColumn("words", words).where(F.size("words") > 0)
    return rows.withColumn("key", F.sha2(F.array_join("words", " "), 256))


def _entries(postings: DataFrame, ids: DataFrame, width: int, span: int) -> DataFrame:
    """(num, pos, id) of the words that have an id (token, id)."""
    lists = postings.select("token", "block", "stretch", "at", "place").join(ids, "token")
    rows = lists.select("id", "block", "stretch", F.explode(F.arrays_zip("at", "place")).alias("e"))
    return rows.select((F.col("block") * width + F.col("e.at")).alias("num"), (F.col("stretch") * span + F.col("e.place")).alias("pos"), "id")


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """Different ``rows`` with a number each, ``id``; written, so that it stays theirs."""
    return stored(rows.withColumn("id", F.monotonically_increasing_id()), name)


def phrase_hits(postings: DataFrame, queries: DataFrame, text: str, width: int = WIDTH, span: int = SPAN) -> DataFrame:
    """(query_id, num, hits, first): texts that hold the words of a query next to each other in order, how often, and where first.

    Equal phrases are searched once. Runs of 1, 2, 4, ... words that phrases hold are numbered, and a run in a text is two runs of half
    its length, side by side; a phrase is two runs that cover it. A place of a text holds one run of a length, so what is joined grows
    with the texts, however many phrases share a frequent word.
    """
    asked = _asked(queries, fts_tokens(phrase_text(F.col(text))))
    sets = stored(asked.select("key", "words").dropDuplicates(["key"]), "phrases")
    longest = sets.agg(F.max(F.size("words"))).first()[0] or 0
    each = sets.select("key", F.size("words").alias("wanted"), F.posexplode("words").alias("offset", "token"))
    ids = _numbered(each.select("token").distinct(), "tokens")
    parts = each.join(ids, "token").select("key", "wanted", "offset", "id")
    runs, length, found = _entries(postings, ids, width, span), 1, None
    while True:
        # phrases of up to twice the length: a run at their start and one at their end
        fit = parts.where(F.col("wanted").between(length, 2 * length - 1))
        gap = F.col("wanted") - length
        last = fit.where(F.col("offset") == gap).select("key", F.col("id").alias("b"))
        wants = fit.where("offset = 0").select("key", F.col("id").alias("a"), gap.alias("gap")).join(last, "key")
        at = runs.withColumnRenamed("id", "a").join(wants.select("a", "gap").distinct(), "a").withColumn("end", F.col("pos") + F.col("gap"))
        met = at.join(runs.select("num", F.col("pos").alias("end"), F.col("id").alias("b")), ["num", "end"]).join(wants, ["a", "b", "gap"])
        met = met.groupBy("key", "num").agg(F.count(F.lit(1)).alias("hits"), F.min("pos").alias("first"))
        found = met if found is None else found.unionAll(met)
        if 2 * length > longest:
            break
        on = lambda rows, place, by: rows.withColumnRenamed("id", "a").join(
            rows.select(*by, (F.col(place) - length).alias(place), F.col("id").alias("b")), [*by, place])
        pairs = on(parts, "offset", ["key", "wanted"])
        ids = _numbered(pairs.select("a", "b").distinct(), "runs")
        parts = stored(pairs.join(ids, ["a", "b"]).select("key", "wanted", "offset", "id"), "parts")
        runs = stored(on(runs, "pos", ["num"]).join(ids, ["a", "b"]).select("num", "pos", "id"), "places")
        length *= 2
    return found.join(asked.select("query_id", "key"), "key").select("query_id", "num", "hits", "first")


def _chained(before: np.ndarray, words: np.ndarray, seed: int) -> np.ndarray:
    """Keys of sequences of words from the keys of what stands before their last word."""
    x = before * np.uint64(0x9E3779B97F4A7C15) + words.view(np.uint64) + np.uint64(seed)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word(token: Column, seed: int) -> Column:
    """The number of a word."""
    return F.xxhash64(F.lit(seed), token)


def _seed(tokens: DataFrame) -> int:
    """The first seed that gives different tokens different numbers."""
    for seed in count():
        same = tokens.groupBy(_word(F.col("token"), seed)).agg(F.min("token").alias("a"), F.max("token").alias("b"))
        if same.where("a <> b").isEmpty():
            return seed


def _ranked(words: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """0 for words that are not common, for the others the higher the more frequent."""
    known, ranks = common
    if not len(known):
        return np.zeros(len(words), np.int64)
    at = np.minimum(np.searchsorted(known, words), len(known) - 1)
    return np.where(known[at] == words, ranks[at], 0)


def _pieces(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Stretches (begin, stop) of a list whose ``sizes`` add up to ``most``, or of one entry."""
    ends, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + most, "right")))
        yield begin, stop
        begin = stop


class _Sets:
    """Sets of words and who asks for them, found by the keys of their words in order."""

    def __init__(self, ids: pa.Array, lists: pa.ListArray) -> None:
        sizes = lists.value_lengths().to_numpy()
        words, first = lists.flatten().to_numpy(), np.cumsum(sizes) - sizes
        one, two, begun = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64), []
        own = np.arange(len(sizes))
        for i in count():
            own = own[sizes[own] > i]
            if not len(own):
                break
            one[own], two[own] = _chained(one[own], words[first[own] + i], 1), _chained(two[own], words[first[own] + i], 2)
            begun.append(one[own[sizes[own] > i + 1]])
        order = np.lexsort((two, one))
        one, two = one[order], two[order]
        new = np.flatnonzero(np.diff(one, prepend=~one[:1]).astype(bool) | np.diff(two, prepend=~two[:1]).astype(bool))
        self.ids, self.one, self.two, self.first, self.times = ids.take(pa.array(order)), one[new], two[new], new, np.diff(new, append=len(one))
        self.starts = np.unique(np.concatenate(begun))
        bits = min(FILTER_BITS, max(16, len(words).bit_length() + 5))
        self.words, self.known = bits_of(words.view(np.uint64), bits), bits_of(np.concatenate([self.starts, self.one]), bits)

    def begun(self, one: np.ndarray) -> np.ndarray:
        """Which keys are those of the start of a set."""
        at = np.searchsorted(self.starts, one)
        return self.starts[np.minimum(at, len(self.starts) - 1)] == one if len(self.starts) else np.zeros(len(one), bool)

    def place(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Where the sets of these keys stand among all, -1 for keys of none."""
        at = np.searchsorted(self.one, one)
        while True:
            at = np.where(at < len(self.one), at, -1)
            held = (at >= 0) & (self.one[at] == one)
            other = held & (self.two[at] != two)
            if not other.any():
                return np.where(held, at, -1)
            at = at + other

    def asked(self, nums: np.ndarray, at: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray]]:
        """Who asks for the sets that were found, and the texts that hold them."""
        order = np.argsort(at, kind="stable")
        nums, at = nums[order], at[order]
        for begin, stop in _pieces(self.times[at], _STEP):
            times = self.times[at[begin:stop]]
            rows = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times - self.first[at[begin:stop]], times)
            yield self.ids.take(pa.array(rows)), np.repeat(nums[begin:stop], times)


def _sets_of(folder: str, kind: pa.DataType, most: int) -> Callable[[], Iterator[_Sets]]:
    """The written sets, about ``most`` words at a time. What fits in at once is read once."""
    from pyarrow import fs, parquet

    def read() -> Iterator[_Sets]:
        system, path = opened(folder)
        held, size = [], 0
        for name in sorted(x.path for x in system.get_file_info(fs.FileSelector(path)) if x.path.endswith(".parquet")):
            with system.open_input_file(name) as source:
                for batch in parquet.ParquetFile(source).iter_batches(1 << 12, columns=["query_id", "words"]):
                    held.append(batch)
                    size += len(batch.column("words").flatten())
                    if size >= most:
                        yield made(held)
                        held, size = [], 0
        if held:
            yield made(held)

    def made(batches: list[pa.RecordBatch]) -> _Sets:
        table = pa.Table.from_batches(batches).combine_chunks()
        return _Sets(pa.concat_arrays(table["query_id"].cast(kind).chunks), pa.concat_arrays(table["words"].chunks))

    kept: list[_Sets] = []

    def every() -> Iterator[_Sets]:
        if kept:
            yield kept[0]
            return
        parts, sets = 0, None
        for sets in read():
            yield sets
            parts += 1
        if parts == 1:
            kept.append(sets)

    return every


def _sets_in(words: np.ndarray, ends: np.ndarray, sets: _Sets) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place of a word, place of a set) for the sets that end with this word in its text: starts of sets go on with each later word of
    the text, up to its end."""
    none = np.zeros(len(words), np.uint64)
    one, two, last, todo = _chained(none, words, 1), _chained(none, words, 2), np.arange(len(words)), []
    while True:
        at = sets.place(one, two)
        whole = np.flatnonzero(at >= 0)
        if len(whole):
            yield last[whole], at[whole]
        goes_on = np.flatnonzero(sets.begun(one) & (last < ends[last] - 1))
        if len(goes_on):
            last = last[goes_on]
            todo.append([one[goes_on], two[goes_on], last, _pieces(ends[last] - 1 - last, _STEP)])
        # some at a time, what follows from them first: what is held is bounded for each word of a set
        while todo and (piece := next(todo[-1][-1], None)) is None:
            todo.pop()
        if not todo:
            return
        one, two, last = (x[slice(*piece)] for x in todo[-1][:3])
        more = ends[last] - 1 - last
        own = np.repeat(np.arange(len(last)), more)
        after = np.arange(len(own)) - np.repeat(np.cumsum(more) - more - last - 1, more)
        new = _chained(one[own], words[after], 1)
        some = np.flatnonzero(passes(sets.known, new))  # the filter spares most searches
        one, two, last = new[some], _chained(two[own[some]], words[after[some]], 2), after[some]


def word_hits(postings: DataFrame, queries: DataFrame, text: str, width: int = WIDTH, span: int = SPAN) -> DataFrame:
    """(query_id, num): texts that hold every word of a query, in any order. Equal sets of words are searched once.

    Words have numbers and an order, common ones last. Each text goes through its own words in this order, from the first word of a
    set to the second and on, as long as a filter may know the words so far as the start of a set. Whole sets are known by a key of
    128 bits, and hits are final where they are found: there are up to texts times queries of them, so they are never dealt out. A
    task reads the sets from the shared folder, a bounded part at a time.
    """
    spark = postings.sparkSession
    asked = _asked(queries, F.array_distinct(fts_tokens(F.col(text)))).select("query_id", "words", F.monotonically_increasing_id().alias("row"))
    asked = stored(asked, "asked")
    counts = stored(postings.groupBy("token").agg(F.sum("n").alias("n")), "counts")
    named = asked.select(F.explode("words").alias("token"))
    seed = _seed(counts.select("token").unionAll(named))
    total = counts.agg(F.sum("n")).first()[0] or 0
    most = counts.where(F.col("n") * COMMON >= total).select(_word(F.col("token"), seed).alias("word"), "n").orderBy("n", "word").toArrow()
    order = np.argsort(most["word"].to_numpy())
    common = spark.sparkContext.broadcast((most["word"].to_numpy()[order], order + 1))
    wanted = bit_filter(named.select(_word(F.col("token"), seed).alias("word")), "word", FILTER_BITS)

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("words")
            sizes, words = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
            words = words[np.lexsort((words, _ranked(words, common.value), np.repeat(np.arange(len(sizes)), sizes)))]
            starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), pa.ListArray.from_arrays(pa.array(starts), pa.array(words)), batch.column("row")],
                                             ["query_id", "words", "row"])

    kind = asked.schema["query_id"].dataType
    numbered = asked.select("query_id", F.transform("words", lambda x: _word(x, seed)).alias("words"), "row")
    sets = numbered.mapInArrow(in_order, T.StructType([T.StructField("query_id", kind), T.StructField("words", T.ArrayType(T.LongType())), T.StructField("row", T.LongType())]))
    folder = scratch_path(spark, "sets")
    sets.repartitionByRange("words", "row").sortWithinPartitions("words", "row").select("query_id", "words").write.parquet(folder)
    release_shuffles(spark)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(passes(wanted.value, batch.column("word").to_numpy().view(np.uint64))))
            lists = batch.column("at")
            sizes, at = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
            own = np.repeat(np.arange(len(sizes)), sizes)
            once = np.flatnonzero((np.diff(own, prepend=-1) != 0) | (np.diff(at, prepend=-1) != 0))  # ascending: many places, one id
            own, at = own[once], at[once]
            nums = batch.column("block").to_numpy()[own] * width + at
            for i in range(0, len(own), _STEP):
                yield pa.RecordBatch.from_arrays([pa.array(nums[i:i + _STEP]), pa.array(batch.column("word").to_numpy()[own[i:i + _STEP]])], ["num", "word"])

    arrow, sets_most, texts_most = to_arrow_type(kind), SETS, TEXTS

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, held, size = _sets_of(folder, arrow, sets_most), [], 0
        for batch in batches:
            held.append((batch.column("num").to_numpy(), batch.column("word").to_numpy()))
            size += len(held[-1][0])
            if size >= texts_most and held[0][0][0] != held[-1][0][-1]:
                nums, words = map(np.concatenate, zip(*held))
                tail = int(np.searchsorted(nums, nums[-1]))  # the last text may go on in the next batch
                yield from hits(nums[:tail], words[:tail], every)
                held, size = [(nums[tail:], words[tail:])], len(nums) - tail
        if size:
            yield from hits(*map(np.concatenate, zip(*held)), every)

    def hits(nums: np.ndarray, words: np.ndarray, every: Callable[[], Iterator[_Sets]]) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((words, _ranked(words, common.value), nums))
        nums, words = nums[order], words[order]
        once = np.flatnonzero((np.diff(nums, prepend=nums[:1] - 1) != 0) | (np.diff(words, prepend=words[:1]) != 0))
        nums, words = nums[once], words[once]
        for sets in every():
            own = np.flatnonzero(passes(sets.words, words.view(np.uint64)))
            texts, known = nums[own], words[own]
            ends = np.searchsorted(texts, texts, "right")
            held, size = [], 0
            for last, at in _sets_in(known, ends, sets):
                held.append((texts[last], at))
                size += len(at)
                if size > _STEP:
                    yield from out(held, sets)
                    held, size = [], 0
            if held:
                yield from out(held, sets)

    def out(held: list, sets: _Sets) -> Iterator[pa.RecordBatch]:
        for ids, nums in sets.asked(*map(np.concatenate, zip(*held))):
            yield pa.RecordBatch.from_arrays([ids, pa.array(nums)], ["query_id", "num"])

    found = postings.select("block", _word(F.col("token"), seed).alias("word"), "at").mapInArrow(entries, "num long, word long")
    # a task's hits grow with all sets, so the number of tasks is set and not left to the size of the texts
    texts = found.repartition(shuffle_partitions(postings), "num").sortWithinPartitions("num")
    return texts.mapInArrow(search, T.StructType([T.StructField("query_id", kind), T.StructField("num", T.LongType())]))

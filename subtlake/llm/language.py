"""Language of documents by fusing evidence: the text, the declared markup language, the address suffix, and the host.

The text's likelihood comes from byte trigrams, counted per declared language over all documents. What text alone says is then
aggregated by host, by its parent domain and over all documents; each level smooths the one below, which gives every host a prior.
Declared languages and suffixes weigh as much as they agreed with the texts. All of it meets in one posterior.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtlake.llm.common import stored
from subtlake.llm.tokens import bounded_batches, slices

GRAMS = 1 << 15


def declared_code(column: Column) -> Column:
    """The primary part of a language tag, in lower case; null if it is none."""
    code = F.lower(F.regexp_extract(column, r"^\s*([A-Za-z]{2,3})(?:[-_].*)?\s*$", 1))
    return F.when(code != "", code)


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(host != "", host)


def parent_of(host: Column) -> Column:
    """The last two labels of a host, itself if it has fewer."""
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    """The last label of a host with more than one."""
    return F.when(F.instr(host, ".") > 0, F.substring_index(host, ".", -1))


def _trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of each byte trigram with a letter in it; A-Z in lower case, other ASCII bytes as blanks."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    cuts = offsets - offsets[0]
    plain = _PLAIN[raw].astype(np.int32)
    if len(plain) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bucket = ((plain[:-2] * 31 + plain[1:-1]) * 199 + plain[2:]) * 40503 >> 3 & (GRAMS - 1)
    row = np.repeat(np.arange(len(texts)), np.diff(cuts))
    whole = (row[:-2] == row[2:]) & (plain[:-2] + plain[1:-1] + plain[2:] > 3 * 32)
    return row[:-2][whole], bucket[whole]


_PLAIN = np.full(256, 32, np.uint8)
_PLAIN[97:123] = np.arange(97, 123)
_PLAIN[65:91] = np.arange(97, 123)
_PLAIN[128:] = np.arange(128, 256)


def _languages(rows: DataFrame) -> list[str]:
    """All declared languages, the most frequent first; two or three letters, so at most 26 ** 2 + 26 ** 3."""
    found = rows.where("declared is not null").groupBy("declared").agg(F.count(F.lit(1)).alias("n"))
    return [r["declared"] for r in found.orderBy(F.desc("n"), "declared").collect()]


def _gram_counts(rows: DataFrame, languages: list[str]) -> DataFrame:
    """``bucket``, ``language`` (its number), ``n``: trigrams per declared language; a task holds at most ``GRAMS * 64`` sums at a time."""
    number = {x: i for i, x in enumerate(languages)}
    width = len(languages)

    def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
        at, back = np.unique(np.concatenate([x for x, _ in parts]), return_inverse=True)
        total = np.zeros(len(at), np.int64)
        np.add.at(total, back, np.concatenate([n for _, n in parts]))
        return at, total

    def out(parts: list) -> pa.RecordBatch:
        at, total = merged(parts)
        return pa.RecordBatch.from_arrays([pa.array((at // width).astype(np.int32)), pa.array((at % width).astype(np.int32)), pa.array(total)],
                                          ["bucket", "language", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for part in slices(batch):
                which = np.array([number[x] for x in part.column("declared").to_pylist()], np.int64)
                row, bucket = _trigrams(part.column("text"))
                at, n = np.unique(bucket * width + which[row], return_counts=True)
                parts.append((at.astype(np.int64), n.astype(np.int64)))
                size += len(at)
                if size > 2 * GRAMS * 64:
                    parts = [merged(parts)]
                    size = len(parts[0][0])
                    if size > GRAMS * 64:
                        yield out(parts)
                        parts, size = [], 0
        if parts:
            yield out(parts)

    sums = rows.where("declared is not null").select("declared", "text").mapInArrow(count, "bucket int, language int, n long")
    return stored(sums.groupBy("bucket", "language").agg(F.sum("n").alias("n")), "grams")


def _sums(table: DataFrame, by: str, size: int) -> np.ndarray:
    found = table.groupBy(by).agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(size)
    total[np.asarray(found[by])] = np.asarray(found["n"])
    return total


def _block_scores(rows: DataFrame, counts: DataFrame, width: int, block: int, text_weight: float) -> DataFrame:
    """``text_hash``, ``grams``, ``low`` (first language of the block), ``logs`` (of the block's languages): one row per row and block.

    The log likelihood of a trigram bucket is smoothed by the bucket's share over all languages. One block's model is
    ``GRAMS * block`` numbers, whatever the number of languages; the texts are read once for each block.
    """
    overall = _sums(counts, "bucket", GRAMS)
    spoken = _sums(counts, "language", width)
    overall = (overall + 0.5) / (overall.sum() + 0.5 * GRAMS)
    tables = []
    for low in range(0, width, block):
        size = min(block, width - low)
        found = counts.where((F.col("language") >= low) & (F.col("language") < low + size)).toArrow()
        own = np.zeros((GRAMS, size))
        own[np.asarray(found["bucket"]), np.asarray(found["language"]) - low] = np.asarray(found["n"])
        each = (own + 50 * overall[:, None]) / (spoken[low:low + size] + 50)
        model = rows.sparkSession.sparkContext.broadcast(np.log(each / overall[:, None]))

        def read(batches: Iterator[pa.RecordBatch], model=model, low=low) -> Iterator[pa.RecordBatch]:
            weights = model.value * text_weight
            for batch in batches:
                for part in slices(batch):
                    row, bucket = _trigrams(part.column("text"))
                    logs = np.stack([np.bincount(row, weights[bucket, i], minlength=len(part)) for i in range(weights.shape[1])], axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("text_hash"), pa.array(np.bincount(row, minlength=len(part))), pa.array(np.full(len(part), low, np.int32)),
                         pa.array(list(logs), pa.list_(pa.float64()))], ["text_hash", "grams", "low", "logs"])

        scores = rows.select("text_hash", "text").mapInArrow(read, "text_hash long, grams long, low int, logs array<double>")
        tables.append(stored(scores.groupBy("text_hash", "low").agg(F.first("grams").alias("grams"), F.first("logs").alias("logs")), "scores"))
        model.unpersist()
    return reduce(DataFrame.unionAll, tables)


def identify(docs: DataFrame, text: str = "text", key: str = "doc_id", declared: Column | None = None, host: Column | None = None,
             text_weight: float = 0.25, host_weight: float = 20.0, accept: float = 0.5, block: int = 64) -> DataFrame:
    """``key``, ``text_hash``, ``declared``, ``language``, ``posterior``, ``accepted``: one row per input row.

    ``declared`` and ``host`` are columns of ``docs``; what is null or unknown says nothing. Every declared language takes part;
    ``block`` languages are scored at a time. Trigrams overlap, so their likelihood counts ``text_weight``-fold. A host's prior is
    worth its own documents plus ``host_weight`` documents of its parent's. A document without any letter has no language and is not
    accepted; others are if the best language reaches ``accept``. Ties go to the more frequent language. Without any declared
    language nothing is accepted.
    """
    bounded_batches(docs.sparkSession)
    none = F.lit(None).cast("string")
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("text_hash"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       (declared_code(declared) if declared is not None else none).alias("declared"),
                       (host if host is not None else none).alias("host"))
    languages = _languages(rows)
    if not languages:
        return rows.select(F.col("id").alias(key), "text_hash", "declared", none.alias("language"), F.lit(None).cast("double").alias("posterior"),
                           F.lit(False).alias("accepted"))
    width = len(languages)
    scores = _block_scores(rows, _gram_counts(rows, languages), width, block, text_weight)
    peak = F.struct((-F.array_max("logs")).alias("minus"), (F.col("low") + F.array_position("logs", F.array_max("logs")).cast("int") - 1).alias("best"))
    best = scores.where("grams > 0").groupBy("text_hash").agg(F.min(peak)["best"].alias("best"))
    # a result hangs on text, declared language and host alone
    cases = rows.groupBy("text_hash", "declared", "host").agg(F.count(F.lit(1)).alias("n")).join(best, "text_hash", "left")
    cases = cases.withColumn("parent", parent_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
    cases = stored(cases, "cases")
    every = _shares(cases, width)
    joined = cases.join(scores, "text_hash")
    for by in ("declared", "suffix", "host", "parent"):
        votes = _votes(cases, by)
        joined = joined.join(votes.withColumnRenamed(by, "_by"), F.col(by) == F.col("_by"), "left").drop("_by")
    shares = F.array(*[F.lit(x) for x in every])

    def had(by: str, i: Column) -> Column:
        return F.coalesce(F.element_at(f"{by}_votes", i), F.lit(0))

    def posterior(log: Column, j: Column) -> Column:
        i = (F.col("low") + j).cast("int")
        share = F.element_at(shares, i + 1)
        above = (had("parent", i) + host_weight * share) / (F.col("parent_n") + host_weight)
        prior = (had("host", i) + host_weight * above) / (F.col("host_n") + host_weight)
        ratio = [F.coalesce(F.log((had(by, i) + 10 * share) / (F.col(f"{by}_n") + 10) / share), F.lit(0.0)) for by in ("declared", "suffix")]
        return log + F.log(F.coalesce(prior, share)) + ratio[0] + ratio[1]

    joined = joined.withColumn("all", F.transform("logs", posterior)).withColumn("top", F.array_max("all"))
    mass = F.aggregate("all", F.lit(0.0), lambda total, x: total + F.exp(x - F.col("top")))
    at = F.col("low") + F.array_position("all", F.col("top")).cast("int")
    parts = joined.groupBy("text_hash", "declared", "host").agg(
        F.max("grams").alias("grams"), F.min(F.struct((-F.col("top")).alias("minus"), at.alias("at"))).alias("first"),
        F.collect_list(F.struct("top", mass.alias("mass"))).alias("parts"))  # one a block
    total = F.aggregate("parts", F.lit(0.0), lambda total, x: total + x["mass"] * F.exp(x["top"] + F.col("first.minus")))
    told = parts.where("grams > 0").select(F.col("text_hash").alias("_hash"), F.col("declared").alias("_declared"), F.col("host").alias("_host"),
                                           F.element_at(F.array(*[F.lit(x) for x in languages]), F.col("first.at")).alias("language"),
                                           (1 / total).alias("posterior"))
    same = (F.col("text_hash") == F.col("_hash")) & F.col("declared").eqNullSafe(F.col("_declared")) & F.col("host").eqNullSafe(F.col("_host"))
    found = rows.select("id", "text_hash", "declared", "host").join(stored(told, "told"), same, "left")
    return found.select(F.col("id").alias(key), "text_hash", "declared", "language", "posterior",
                        F.coalesce(F.col("posterior") >= accept, F.lit(False)).alias("accepted"))


def _shares(cases: DataFrame, width: int) -> list[float]:
    found = {r["best"]: r["n"] for r in cases.where("best is not null").groupBy("best").agg(F.sum("n").alias("n")).collect()}
    total = sum(found.values()) + width
    return [(found.get(i, 0) + 1) / total for i in range(width)]


def _votes(cases: DataFrame, by: str) -> DataFrame:
    """``by``, ``{by}_n`` and ``{by}_votes``: how many texts had it, in all and as a map by the language they speak."""
    own = cases.where(f"{by} is not null and best is not null").groupBy(by, "best").agg(F.sum("n").alias("n"))
    return own.groupBy(by).agg(F.sum("n").alias(f"{by}_n"), F.map_from_entries(F.collect_list(F.struct("best", "n"))).alias(f"{by}_votes"))


def keep_identified(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The accepted rows of ``docs``; all columns stay."""
    gone = identify(docs, text, key, **options).where(~F.col("accepted"))
    gone = gone.select(F.col(key).alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    return docs.join(gone, docs[key].eqNullSafe(gone["_id"]) & (F.xxhash64(docs[text]) == gone["_hash"]), "left_anti")

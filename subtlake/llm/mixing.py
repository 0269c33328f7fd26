"""Mixing documents to target weights of domains, with soft membership.

A classifier learned from a labelled table gives every document its chances of belonging to each domain. Document rates (how often a
document is to be used) then follow from a distributed projected-gradient least-squares fit over all documents: no rate is negative,
and the expected tokens of each domain meet their targets. Only sums over the domains reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtlake.llm.common import free_names, stored
from subtlake.llm.features import bayes, class_counts, document_features, sums, with_labels
from subtlake.session import checkpointed

#: Domains as expressions over the labelled table, the first that holds counts; the last takes the rest.
DOMAINS = {"toxic": "toxic = 1", "poor": "quality = 0", "good": "true"}
#: Target shares of the tokens.
TARGETS = {"toxic": 0.05, "poor": 0.1, "good": 0.85}
#: How far the likelihoods of the words and of the page may be flattened.
_HEATS = [(words, page) for words in (1.0, 2.0, 4.0, 8.0, 16.0) for page in (0.7, 1.0, 1.5, 3.0)]


def _likelihoods(batch: pa.RecordBatch, models) -> list[np.ndarray]:
    return [sums(batch.column(view), likelihood) for view, likelihood in models.items()]


def _log_posteriors(likelihoods: list[np.ndarray], prior: np.ndarray, heats: tuple[float, float]) -> np.ndarray:
    total = sum((x / heat for x, heat in zip(likelihoods, heats)), prior)
    total -= total.max(axis=1, keepdims=True)
    return total - np.log(np.exp(total).sum(axis=1, keepdims=True))


def domain_posteriors(docs: DataFrame, labels: DataFrame, domains: dict[str, str] | None = None, text: str = "text", key: str = "doc_id",
                      held_out: int = 5) -> DataFrame:
    """``key``, ``text_hash``, ``tokens``, ``posterior`` (list of chances in the order of ``domains``): one row per input row.

    Naive Bayes over the words and the shape of the text, counted on all labelled documents. One in ``held_out`` of them, by hash of the
    key, is kept apart to choose how far the likelihoods are flattened. Domains never labelled keep a small chance. Without labels
    every document has the same chances.
    """
    domains = domains or DOMAINS
    names = list(domains)
    rows = document_features(docs, text, (key,), ())
    rows = with_labels(rows, labels, key, {f"cast(coalesce({e}, false) as int)": f"_d{i}" for i, e in enumerate(domains.values())})
    which = F.coalesce(*[F.when(F.col(f"_d{i}") == 1, F.lit(i)) for i in range(len(names))])
    rows = rows.withColumn("label", which).drop(*[f"_d{i}" for i in range(len(names))])
    rows = stored(rows.withColumn("own", F.when(F.pmod(F.xxhash64(F.col(key), F.lit("held")), F.lit(held_out)) != 0, F.col("label"))), "features")
    models = {v: bayes(c) for v, c in class_counts(rows, {"words": "own", "page": "own"}, len(names)).items()}
    prior = models["page"][1]
    models = {v: likelihood for v, (likelihood, _) in models.items()}

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("label").to_numpy()
            found = _likelihoods(batch, models)
            each = [-_log_posteriors(found, prior, heat)[np.arange(len(label)), label].sum() for heat in _HEATS]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(_HEATS), dtype=np.int32)), pa.array(each)], ["heat", "loss"])

    held = rows.where("label is not null and own is null").select("words", "page", "label")
    loss = {r["heat"]: r["loss"] for r in held.mapInArrow(losses, "heat int, loss double").groupBy("heat").agg(F.sum("loss").alias("loss")).collect()}
    heat = _HEATS[min(loss, key=lambda i: (round(loss[i], 6), i))] if loss else _HEATS[-1]
    kind = docs.schema[key].dataType.simpleString()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chances = np.exp(_log_posteriors(_likelihoods(batch, models), prior, heat))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text_hash"), batch.column("tokens"), pa.array(list(chances), pa.list_(pa.float64()))],
                                             ["id", "text_hash", "tokens", "posterior"])

    out = rows.select(F.col(key).alias("id"), "text_hash", "tokens", "words", "page").mapInArrow(
        predict, f"id {kind}, text_hash long, tokens long, posterior array<double>")
    return out.withColumnRenamed("id", key)


def _moved(batch: pa.RecordBatch, steps: list[tuple[np.ndarray, float]], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posteriors, ``rate`` and ``ahead`` of a batch's documents after the rounds ``steps``.

    A round moves ``ahead`` against the gradient, which for a document is its posterior times the step, never below 0: the new rate.
    The next ``ahead`` lies beyond it, by the round's momentum times what the rate has changed.
    """
    chances = batch.column("posterior").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    rate, ahead = (batch.column("state").field(i).to_numpy(zero_copy_only=False) for i in range(2))
    for step, beyond in steps:
        after = np.maximum(0.0, ahead - chances @ step)
        rate, ahead = after, after + beyond * (after - rate)
    return chances, rate, ahead


def _totals(moved: DataFrame, steps: list[tuple[np.ndarray, float]], width: int) -> np.ndarray:
    """Expected tokens per domain at ``rate`` and at ``ahead`` after the rounds ``steps``; each task sends one row."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * width)
        for batch in batches:
            chances, rate, ahead = _moved(batch, steps, width)
            tokens = batch.column("tokens").fill_null(0).to_numpy(zero_copy_only=False).astype(float)
            total += np.concatenate([(tokens * rate) @ chances, (tokens * ahead) @ chances])
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in total], names)

    names = [f"s{i}" for i in range(2 * width)]
    sums_ = moved.select("tokens", "posterior", "state").mapInArrow(add, ", ".join(f"{n} double" for n in names))
    found = sums_.agg(*[F.sum(n).alias(n) for n in names]).first()
    return np.array([found[n] for n in names]).reshape(2, width)


def _after(moved: DataFrame, steps: list[tuple[np.ndarray, float]], width: int) -> DataFrame:
    """``moved`` with the state after the rounds ``steps``."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, rate, ahead = _moved(batch, steps, width)
            state = pa.StructArray.from_arrays([pa.array(rate), pa.array(ahead)], ["rate", "ahead"])
            yield batch.set_column(batch.schema.get_field_index("state"), "state", state)

    return moved.mapInArrow(walk, moved.schema)


def fit_rates(posteriors: DataFrame, targets: list[float], close: float = 1e-6, window: int = 10, gain: float = 0.1, kept: int = 32) -> DataFrame:
    """``posteriors`` with ``rate``: nonnegative, so that expected domain tokens are ``targets`` times all tokens.

    Least squares over the domain totals, weighted by the inverse of their second moments, under which a gradient step of length 1 is
    safe. All documents start at rate 1 and move by projected gradient with momentum: each round is one aggregate over all documents,
    and the step, one number per domain, is all that comes to the driver and goes back. The fit ends when every total is within ``close``
    of all tokens, or when ``window`` rounds have brought the squared distance down by less than the share ``gain`` (no nonnegative
    rates meet the targets); the best round's rates are returned. After ``kept`` rounds the rates are written, so a plan never holds
    more steps. Documents without tokens move like others of their posterior; equal posteriors have equal rates. Without any tokens
    all rates are 1; an empty table stays empty.
    """
    width = len(targets)
    p, t = F.col("posterior"), F.col("tokens").cast("double")
    products = [F.sum(t * p[i] * p[j]).alias(f"g{i}_{j}") for i in range(width) for j in range(i, width)]
    sums_ = posteriors.agg(F.sum(t).alias("t"), *products).first()
    total = float(sums_["t"] or 0)
    if total == 0:
        return posteriors.withColumn("rate", F.lit(1.0))
    gram = np.array([[sums_[f"g{min(i, j)}_{max(i, j)}"] for j in range(width)] for i in range(width)]) / total
    weight = np.linalg.pinv(gram, rcond=1e-9, hermitian=True)
    goal = np.array(targets) / sum(targets)
    (kept_as,) = free_names(posteriors, "state_")  # a column ``state`` of the input keeps its name to the end
    moved = posteriors.withColumnsRenamed({"state": kept_as}) if "state" in posteriors.columns else posteriors
    moved = moved.withColumn("state", F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("ahead")))
    steps: list[tuple[np.ndarray, float]] = []
    best, lowest, pace = (moved, steps), [], 1.0
    while True:
        off, off_ahead = _totals(moved, steps, width) / total - goal
        distance = float(off @ weight @ off)
        if not lowest or distance < lowest[-1]:
            best = moved, steps
        lowest.append(min([distance, *lowest[-1:]]))
        if np.abs(off).max() <= close or distance < 1e-15 or (len(lowest) > window and lowest[-1] > (1 - gain) * lowest[-1 - window]):
            break
        next_pace = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        steps = [*steps, (weight @ off_ahead, (pace - 1) / next_pace)]
        pace = next_pace
        if len(steps) == kept:
            moved, steps = stored(_after(moved, steps, width), "rates"), []
    rated = _after(*best, width).withColumn("rate", F.col("state")["rate"]).drop("state")
    return rated.withColumnsRenamed({kept_as: "state"}) if "state" in posteriors.columns else rated


def copies(rate: Column, key: Column) -> Column:
    """Whole number of uses with the rate as its mean: the fraction is decided by a hash of the key."""
    chance = F.pmod(F.xxhash64(key, F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("int")).cast("int")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, domains: dict[str, str] | None = None,
        text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``text_hash``, ``tokens``, ``posterior``, ``rate``, ``copies``: one row per input row. See the two steps."""
    domains, targets = domains or DOMAINS, targets or TARGETS
    chances = checkpointed(domain_posteriors(docs, labels, domains, text, key))
    rated = fit_rates(chances, [targets[d] for d in domains])
    return rated.withColumn("copies", copies(F.col("rate"), F.col("text_hash")))


def apply_mix(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that have a use, with ``mix_rate`` and ``mix_copies``; rows of rate 0 go."""
    rated = mix(docs, labels, text=text, key=key, **options)
    id_, hash_ = free_names(docs, "_id", "_hash")
    rated = rated.select(F.col(key).alias(id_), F.col("text_hash").alias(hash_), F.col("rate").alias("mix_rate"), F.col("copies").alias("mix_copies"))
    rated = rated.where("mix_rate > 0").dropDuplicates([id_, hash_])
    columns = [c for c in docs.columns if c not in ("mix_rate", "mix_copies")]
    joined = docs.select(*columns).join(rated, F.col(key).eqNullSafe(F.col(id_)) & (F.xxhash64(text) == F.col(hash_)))
    return joined.select(*columns, "mix_rate", "mix_copies")

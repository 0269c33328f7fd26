"""Quality of documents by co-training: a classifier of the text's words and one of the page's metadata teach each other.

Each round, a bounded share of the documents without a label, those on which one view is surest, get that view's answer as a label for
the other view. Views and their sum are calibrated on labelled documents kept apart, and what makes the sum worse there is not learnt.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtlake.llm.common import stored
from subtlake.llm.features import BUCKETS, bayes, class_counts, document_features, sums, with_labels

VIEWS = ("words", "page")
_STEPS = np.linspace(-1, 1, 801)  # cells in which raw scores are counted for the calibration


def _scorer(model: tuple[np.ndarray, np.ndarray], view: str):
    """Raw scores in -1 to 1 of a view: the weights of a row's buckets and the prior, squashed."""
    likelihood, p = model
    weights, prior = likelihood[:, 1] - likelihood[:, 0], float(p[1] - p[0])
    # what travels with the tasks are the buckets that count, mostly few
    used = np.flatnonzero(weights).astype(np.int32)
    values = weights[used].astype(np.float32)

    def raw(batch: pa.RecordBatch) -> np.ndarray:
        dense = np.zeros((BUCKETS, 1), np.float32)
        dense[used, 0] = values
        return np.tanh((sums(batch.column(view), dense)[:, 0] + prior) / 8)

    return raw


def _platt(cells: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the log odds, fitted on counts (cell, class) by Newton steps; the slope is not negative."""
    x, n = _STEPS, cells.sum(axis=1).astype(float)
    if cells.sum(axis=0).min() == 0:
        good, bad = cells[:, 1].sum(), cells[:, 0].sum()
        return 0.0, float(np.log((good + 1) / (bad + 1)))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        gradient = np.array([((n * p - cells[:, 1]) * x).sum() + 1e-3 * a, (n * p - cells[:, 1]).sum()])
        w = n * p * (1 - p)
        hessian = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a - np.clip(step[0], -5, 5), b - np.clip(step[1], -5, 5)
    return max(float(a), 0.0), float(b)


def _count_cells(rows: DataFrame, read, sets: int, keep: list[str]) -> np.ndarray:
    """Counts [set, cell, class] of what ``read`` (batch to one array in -1 to 1 a set) says of ``rows``; class 0 where there is no label."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((sets, len(_STEPS), 2), np.int64)
        for batch in batches:
            label = batch.column("label").fill_null(0).to_numpy(zero_copy_only=False)
            for i, scores in enumerate(read(batch)):
                np.add.at(total, (i, _cell(scores), label), 1)
        i, cell, label = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32)) for x in (i, cell, label)] + [pa.array(total[i, cell, label])],
                                         ["number", "cell", "label", "n"])

    found = rows.select(*keep, "label").mapInArrow(count, "number int, cell int, label int, n long")
    cells = np.zeros((sets, len(_STEPS), 2), np.int64)
    for r in found.groupBy("number", "cell", "label").agg(F.sum("n").alias("n")).collect():  # at most sets x cells x 2 rows
        cells[r["number"], r["cell"], r["label"]] = r["n"]
    return cells


def _cell(scores: np.ndarray) -> np.ndarray:
    return np.rint((scores + 1) / 2 * (len(_STEPS) - 1)).astype(int)


def _view_odds(view: str, raw: np.ndarray, scale: tuple[float, float], tokens: np.ndarray, prior: float) -> np.ndarray:
    """Calibrated log odds of a view; no words say nothing."""
    odds = scale[0] * raw + scale[1]
    return np.where(tokens == 0, prior, odds) if view == "words" else odds


def _sum(words: np.ndarray, page: np.ndarray, prior: float) -> np.ndarray:
    """The views' log odds together, cut to -8 to 8 and brought to -1 to 1."""
    return np.clip((words + page - prior) / 8, -1, 1)


def _best(held: DataFrame, tried: dict[str, list], prior: float) -> tuple[tuple[int, int], dict[str, tuple[float, float]], float]:
    """Of the models tried for each view the pair whose calibrated sum has the least log loss on the held-out rows (the first in a tie),
    slopes and offsets of its views and of their sum (``both``), and the loss."""
    raw = [(v, _scorer(m, v)) for v in VIEWS for m in tried[v]]
    scales = [_platt(c) for c in _count_cells(held, lambda b: [r(b) for _, r in raw], len(raw), [*VIEWS, "tokens"])]
    split = len(tried["words"])
    pairs = [(i, j) for i in range(split) for j in range(len(tried["page"]))]

    def sums_of(batch: pa.RecordBatch) -> list[np.ndarray]:
        tokens = batch.column("tokens").to_numpy()
        odds = [_view_odds(v, r(batch), s, tokens, prior) for (v, r), s in zip(raw, scales)]
        return [_sum(odds[i], odds[split + j], prior) for i, j in pairs]

    found = []
    for pair, cells in zip(pairs, _count_cells(held, sums_of, len(pairs), [*VIEWS, "tokens"])):
        a, b = _platt(cells)
        x = np.clip(a * _STEPS + b, -30, 30)
        loss = (cells[:, 1] * np.log1p(np.exp(-x)) + cells[:, 0] * np.log1p(np.exp(x))).sum() / max(cells.sum(), 1)
        found.append((float(loss), pair, (a, b)))
    loss, (i, j), both = min(found, key=lambda f: f[:2])
    return (i, j), {"words": scales[i], "page": scales[split + j], "both": both}, loss


def score_quality(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", good: str = "quality = 1 and toxic = 0",
                  rounds: int = 2, sure: float = 0.9, held_out: int = 5, share: float = 0.3, weights: tuple[float, ...] = (0.25, 1.0)) -> DataFrame:
    """``key``, ``text_score``, ``page_score``, ``score`` (chances of being good) and ``good`` (score of at least 0.5): one row per input row.

    ``good`` is an expression over ``labels``. One in ``held_out`` labelled documents, by hash of the key, only calibrates the views and
    their sum and chooses between models. In a round each view labels for the other the documents without a label that it ranks highest
    and lowest, ``share`` of all of them, split as the labelled classes are (documents of one step of the scale stay together), where
    the sum is ``sure`` too. The pseudo-labels of a class together weigh one of ``weights`` times the given labels of that class, so
    the balance of the classes stays; they may bring in buckets, or only weigh those that the given labels tell apart. Of these
    models and the last ones each view keeps what makes the log loss of the calibrated sum least; where that is the last ones, the
    exchange has nothing more to teach and ends.

    Documents without words are scored by their page alone; null keys have no label. Without labels of both classes every score is the
    share of good labels, a half if there are none. Documents of the same chance get the same score and verdict; repeated rows are
    scored alike, each for itself. A chance of exactly a half counts as good.
    """
    rows = document_features(docs, text, (key,))
    rows = with_labels(rows, labels, key, {f"cast(({good}) as int)": "label"})
    rows = stored(rows.withColumn("held", F.pmod(F.xxhash64(F.col(key), F.lit("held")), F.lit(held_out)) == 0), "features")
    held = stored(rows.where("held and label is not null").select(*VIEWS, "tokens", "label"), "held-labels")
    own = class_counts(rows.withColumn("own", F.when(~F.col("held"), F.col("label"))), {"words": "own", "page": "own"}, 2)
    prior = _share(rows)
    models = {v: bayes(c) for v, c in own.items()}
    clear = {v: m[0].any(axis=1, keepdims=True) for v, m in models.items()}
    _, scale, loss = _best(held, {v: [m] for v, m in models.items()}, prior)
    for _ in range(rounds):
        told = _pseudo(rows, models, scale, sure, share, prior)
        taught = class_counts(told, {"words": "for_words", "page": "for_page"}, 2)
        tried = {v: [models[v]] for v in VIEWS}
        for v in VIEWS:
            for weight in weights:
                likelihood, p = bayes(own[v] + taught[v] * _weights(own[v], taught[v], weight))
                tried[v] += [(likelihood, p), (likelihood * clear[v], p)]
        (i, j), scale, loss = _best(held, tried, prior)
        if (i, j) == (0, 0):
            break
        models = {"words": tried["words"][i], "page": tried["page"][j]}
    raw = {v: _scorer(models[v], v) for v in VIEWS}
    kind = docs.schema[key].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            views = [_view_odds(v, raw[v](batch), scale[v], batch.column("tokens").to_numpy(), prior) for v in VIEWS]
            both = scale["both"][0] * _sum(*views, prior) + scale["both"][1]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(1 / (1 + np.exp(-np.clip(x, -30, 30)))) for x in (*views, both)]],
                                             ["id", "text_score", "page_score", "score"])

    out = rows.select(F.col(key).alias("id"), "tokens", *VIEWS).mapInArrow(score, f"id {kind}, text_score double, page_score double, score double")
    return out.withColumnRenamed("id", key).withColumn("good", F.col("score") >= 0.5)


def _weights(own: np.ndarray, taught: np.ndarray, weight: float) -> np.ndarray:
    """Weight of a pseudo-label of each class: together at most ``weight`` of the class's given labels, the same share in both classes."""
    given, new = own[BUCKETS].astype(float), taught[BUCKETS].astype(float)
    reached = min([weight, *(new / np.maximum(given, 1))])
    return reached * given / np.maximum(new, 1)


def _share(rows: DataFrame) -> float:
    good, n = rows.agg(F.sum("label"), F.count("label")).first()
    return float(np.log(((good or 0) + 1) / (n - (good or 0) + 1)))


def _edges(cells: np.ndarray, share: float, prior: float) -> tuple[int, int]:
    """Highest cell that counts as bad and lowest that counts as good, by the counts of rows without a label in each cell."""
    good = cells.sum() * share / (1 + np.exp(-prior))
    bad = cells.sum() * share - good
    # a cell counts while those beyond it have not reached the share
    high, low = cells.sum() - np.cumsum(cells) < good, np.cumsum(cells) - cells < bad
    return int(np.flatnonzero(low)[-1]) if low.any() else -1, int(np.flatnonzero(high)[0]) if high.any() else len(_STEPS)


def _pseudo(rows: DataFrame, models, scale, sure: float, share: float, prior: float) -> DataFrame:
    """Labels of each view for documents without one, from what the other view ranks first or last and the sum is sure of."""
    raw = {v: _scorer(models[v], v) for v in VIEWS}
    edge = float(np.log(sure / (1 - sure)))
    free = rows.where("label is null")
    cells = _count_cells(free, lambda b: [raw[v](b) for v in VIEWS], len(VIEWS), list(VIEWS))[:, :, 0]
    edges = {v: _edges(c, share, prior) for v, c in zip(VIEWS, cells)}

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {v: raw[v](batch) for v in VIEWS}
            views = [_view_odds(v, found[v], scale[v], batch.column("tokens").to_numpy(), prior) for v in VIEWS]
            both = scale["both"][0] * _sum(*views, prior) + scale["both"][1]
            out = []
            for teacher in ("page", "words"):
                at, (low, high) = _cell(found[teacher]), edges[teacher]
                out.append(np.where((at >= high) & (both >= edge), 1, np.where((at <= low) & (both <= -edge), 0, -1)))
            yield pa.RecordBatch.from_arrays([*[batch.column(v) for v in VIEWS], *[pa.array(x, pa.int32(), mask=x < 0) for x in out]],
                                             [*VIEWS, "for_words", "for_page"])

    return free.select(*VIEWS, "tokens").mapInArrow(label, "words array<int>, page array<int>, for_words int, for_page int")

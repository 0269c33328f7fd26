"""A flat graph over the unit vectors of one shard: built with robust pruning, searched greedily and then by range.

All queries of a shard walk side by side, so every step is a few array operations. ``near[i]`` are the neighbours of vector ``i``,
filled up with -1. Similarities are inner products in double precision. Where a step gathers vectors or lists for pairs, it does so in
blocks: a shard that is dense all over has as many pairs as the square of its vectors, each with the longest list or a whole vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BLOCK = 1 << 20  # numbers gathered at once: 8 MB


def _blocks(n: int, width: int) -> Iterator[slice]:
    """``n`` rows of ``width`` numbers in runs of at most ``_BLOCK`` numbers."""
    step = max(1, _BLOCK // max(1, width))
    return (slice(first, first + step) for first in range(0, n, step))


def _products(x: np.ndarray, rows: np.ndarray, y: np.ndarray, ids: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows))
    for part in _blocks(len(rows), x.shape[1]):
        out[part] = np.einsum("ij,ij->i", x[rows[part]], y[ids[part]])
    return out


def medoid(x: np.ndarray) -> int:
    """The vector that is most like the others."""
    return int(np.argmax(x @ x.mean(axis=0)))


class Walk:
    """Greedy search of ``queries`` over the graph: what was seen, and how similar it is."""

    def __init__(self, x: np.ndarray, near: np.ndarray, queries: np.ndarray, start: int, beam: int, width: int = 4):
        self.x, self.near, self.queries = x, near, queries
        n = len(queries)
        self.seen, self.expanded = np.zeros((n, len(x)), bool), np.zeros((n, len(x)), bool)
        self.rows: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []
        self.sims: list[np.ndarray] = []
        self._greedy(start, beam, width)

    def _look(self, rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
        sims = _products(self.queries, rows, self.x, ids)
        self.seen[rows, ids] = True
        self.rows.append(rows)
        self.ids.append(ids)
        self.sims.append(sims)
        return sims

    def _greedy(self, start: int, beam: int, width: int) -> None:
        """Each step opens the best unopened of the ``beam`` best that were seen, until all of these are open."""
        n = len(self.queries)
        best_id = np.full((n, beam), -1)
        best = np.full((n, beam), -np.inf)
        opened = np.ones((n, beam), bool)
        best_id[:, 0] = start
        best[:, 0] = self._look(np.arange(n), np.full(n, start))
        opened[:, 0] = False
        active = np.arange(n)
        while len(active):
            shut = ~opened[active]
            chosen = shut & (np.cumsum(shut, axis=1) <= width)
            opened[active] |= chosen
            ids = best_id[active]
            at, _ = np.nonzero(chosen)
            self.expanded[active[at], ids[chosen]] = True
            found = np.full((len(active), width * self.near.shape[1]), -1)
            place = (np.cumsum(chosen, axis=1) - 1)[chosen]
            found.reshape(len(active), width, -1)[at, place] = self.near[ids[chosen]]
            found.sort(axis=1)
            new = found >= 0
            new[:, 1:] &= found[:, 1:] != found[:, :-1]
            new &= ~self.seen[active[:, None], np.maximum(found, 0)]
            sims = np.full(found.shape, -np.inf)
            r, _ = np.nonzero(new)
            sims[new] = self._look(active[r], found[new])
            ids = np.concatenate([ids, found], axis=1)
            sims = np.concatenate([best[active], sims], axis=1)
            was = np.concatenate([opened[active], ~new], axis=1)
            order = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
            best_id[active], best[active] = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
            opened[active] = np.take_along_axis(was, order, 1)
            active = active[~opened[active].all(axis=1)]

    def expand(self, least: float) -> None:
        """On from every seen vector of similarity ``least`` or more, until no further one turns up."""
        rows, ids, sims = self.found()
        while True:
            go = sims >= least
            rows, ids = rows[go], ids[go]
            go = ~self.expanded[rows, ids]
            rows, ids = rows[go], ids[go]
            if not len(rows):
                return
            self.expanded[rows, ids] = True
            mark = np.zeros(self.seen.shape, bool)
            for part in _blocks(len(rows), self.near.shape[1]):
                on = self.near[ids[part]]
                at, place = np.nonzero(on >= 0)
                mark[rows[part][at], on[at, place]] = True
            mark &= ~self.seen
            rows, ids = np.nonzero(mark)
            sims = self._look(rows, ids)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.concatenate(self.rows), np.concatenate(self.ids), np.concatenate(self.sims)


def _best(rows: np.ndarray, ids: np.ndarray, sims: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` most similar ids of each of ``n`` rows, filled up with -1."""
    order = np.lexsort((ids, -sims, rows))
    rows, ids, sims = rows[order], ids[order], sims[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    kept = place < most
    out, own = np.full((n, most), -1), np.full((n, most), -np.inf)
    out[rows[kept], place[kept]] = ids[kept]
    own[rows[kept], place[kept]] = sims[kept]
    return out, own


def _prune(x: np.ndarray, ids: np.ndarray, sims: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Robust pruning of each row's candidates, best first: a candidate goes if a chosen one is ``alpha`` times nearer to it than the row is."""
    out = np.full((len(ids), degree), -1)
    for part in _blocks(len(ids), ids.shape[1] * max(ids.shape[1], x.shape[1])):
        out[part] = _pruned(x, ids[part], sims[part], degree, alpha)
    return out


def _pruned(x: np.ndarray, ids: np.ndarray, sims: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    out = np.full((len(ids), degree), -1)
    vectors = x[np.maximum(ids, 0)]
    apart = 2 - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))  # squared distances
    own = 2 - 2 * sims
    left = ids >= 0
    every = np.arange(len(ids))
    for step in range(degree):
        some = left.any(axis=1)
        if not some.any():
            break
        pick = left.argmax(axis=1)
        out[some, step] = ids[every, pick][some]
        left &= ~(alpha * alpha * apart[every, pick] <= own)
        left[every, pick] = False
    return out


def build(x: np.ndarray, degree: int, beam: int, alpha: float) -> np.ndarray:
    """The graph of ``x``: batches of vectors, each as large as all before, are searched from the medoid and tied to what they saw, both ways."""
    n, first = len(x), medoid(x)
    order = np.concatenate([[first], np.delete(np.arange(n), first)])
    near = np.full((n, degree), -1)
    done, most = 1, 2 * beam
    while done < n:
        batch = order[done:2 * done]
        rows, ids, sims = Walk(x, near, x[batch], first, beam).found()
        near[batch] = _prune(x, *_best(rows, ids, sims, len(batch), most), degree, alpha)
        # the way back: what a vector has and what it gets, pruned again
        source = np.repeat(batch, degree)
        target = near[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        hit = np.unique(target)
        place = np.searchsorted(hit, target)
        had = near[hit]
        rows = np.concatenate([place, np.repeat(np.arange(len(hit)), degree)[had.ravel() >= 0]])
        ids = np.concatenate([source, had[had >= 0]])
        sims = _products(x, hit[rows], x, ids)
        near[hit] = _prune(x, *_best(rows, ids, sims, len(hit), most), degree, alpha)
        done *= 2
    return near


def both_ways(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ties of the graph in both directions, as (offsets, neighbours): what pruning left tied one way can be walked either way."""
    source = np.repeat(np.arange(len(near)), near.shape[1])[near.ravel() >= 0]
    target = near[near >= 0]
    ties = np.unique(np.concatenate([source * len(near) + target, target * len(near) + source]))
    return np.searchsorted(ties, np.arange(len(near) + 1) * len(near)), ties % len(near)

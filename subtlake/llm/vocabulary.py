"""A minimal acyclic transducer over sorted terms: which term a word is, as its number in sorted order.

The automaton shares common beginnings and endings; each arc carries how many terms lie before those behind it, so the sum along
a word's path is the word's number. Words of a whole batch are streamed through it side by side, a byte of each at a step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_WORDS = 4  # 64-bit words of a state's set of bytes


@dataclass
class Transducer:
    """States as arrays: ``bytes_`` the set of a state's outgoing bytes, ``first`` its first arc, ``final`` whether a term ends there;
    arcs in byte order: ``target`` and ``before``."""

    bytes_: np.ndarray
    first: np.ndarray
    final: np.ndarray
    target: np.ndarray
    before: np.ndarray
    root: np.ndarray

    def dump(self) -> list[bytes]:
        return [self.bytes_.tobytes(), self.first.tobytes(), np.packbits(self.final).tobytes(), self.target.tobytes(), self.before.tobytes()]

    def size(self) -> int:
        return sum(map(len, self.dump()))


def load(parts: list[bytes], root: int) -> Transducer:
    first = np.frombuffer(parts[1], np.int64)
    return Transducer(np.frombuffer(parts[0], np.uint64).reshape(-1, _WORDS), first, np.unpackbits(np.frombuffer(parts[2], np.uint8), count=len(first)).astype(bool),
                      np.frombuffer(parts[3], np.int64), np.frombuffer(parts[4], np.int64), np.array([root]))


def joined(some: list[Transducer]) -> Transducer:
    """Several transducers in one set of arrays, each with its root."""
    states = np.cumsum([0, *[len(x.first) for x in some]])
    arcs = np.cumsum([0, *[len(x.target) for x in some]])
    return Transducer(np.concatenate([x.bytes_ for x in some]), np.concatenate([x.first + a for x, a in zip(some, arcs)]), np.concatenate([x.final for x in some]),
                      np.concatenate([x.target + s for x, s in zip(some, states)]), np.concatenate([x.before for x in some]),
                      np.array([int(x.root[0]) + s for x, s in zip(some, states)]))


def build(terms: list[bytes]) -> Transducer:
    """The minimal transducer of ``terms``, which are sorted bytewise and different.

    One term after the other: what the last term has beyond the common beginning is final, and each of its states is replaced by
    an equal one that is there already.
    """
    number: dict[tuple, int] = {}  # a state is whether a term ends there, and its arcs
    below: list[int] = []  # terms behind each state

    def settle(final: bool, arcs: list[tuple[int, int]]) -> int:
        state = (final, tuple(arcs))
        found = number.get(state)
        if found is None:
            found = number[state] = len(below)
            below.append(final + sum(below[target] for _, target in arcs))
        return found

    path: list[list] = [[False, []]]  # of the last term: [final, arcs so far], a state for each byte and one more
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            path[-1][1].append((last[len(path) - 1], settle(final, arcs)))

    for term in terms:
        common = 0
        for x, y in zip(last, term):
            if x != y:
                break
            common += 1
        close(common)
        path.extend([False, []] for _ in range(len(term) - common))
        path[-1][0] = True
        last = term
    close(0)
    root = settle(*path[0])
    states = len(below)
    sets, first, final = np.zeros((states, _WORDS), np.uint64), np.zeros(states, np.int64), np.zeros(states, bool)
    target, before = [], []
    for (ends, arcs), i in number.items():
        first[i], final[i], passed = len(target), ends, int(ends)
        for byte, to in arcs:
            sets[i, byte >> 6] |= np.uint64(1) << np.uint64(byte & 63)
            target.append(to)
            before.append(passed)
            passed += below[to]
    return Transducer(sets, first, final, np.array(target, np.int64), np.array(before, np.int64), np.array([root]))


def numbers(machine: Transducer, data: np.ndarray, start: np.ndarray, end: np.ndarray, root: np.ndarray) -> np.ndarray:
    """The number of each word ``data[start:end]`` among the terms of the transducer whose root it starts from, -1 if it is none."""
    out = np.full(len(start), -1, np.int64)
    rows, state, total, at = np.arange(len(start)), root.astype(np.int64), np.zeros(len(start), np.int64), start.astype(np.int64)
    one = np.uint64(1)
    while len(rows):
        ended = at == end[rows]
        if ended.any():
            done = ended & machine.final[state]
            out[rows[done]] = total[done]
            going = ~ended
            rows, state, total, at = rows[going], state[going], total[going], at[going]
        byte = data[at].astype(np.int64)
        word, bit = byte >> 6, (byte & 63).astype(np.uint64)
        own = machine.bytes_[state, word]
        alive = (own >> bit) & one > 0
        if not alive.all():
            rows, state, total, at, word, bit, own = (x[alive] for x in (rows, state, total, at, word, bit, own))
        arc = machine.first[state] + np.bitwise_count(own & ((one << bit) - one))
        for w in range(_WORDS - 1):
            arc += np.where(word > w, np.bitwise_count(machine.bytes_[state, w]), 0)
        total = total + machine.before[arc]
        state, at = machine.target[arc], at + 1
    return out

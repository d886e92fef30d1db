"""Weighted acyclic automata over words: phrases with counts, built from sorted runs, united and composed, on numpy arrays."""

from __future__ import annotations

import pickle
from bisect import bisect_left, bisect_right
from dataclasses import dataclass, field

import numpy as np
import zstandard

ENTRIES = 1 << 20  # phrases that are collected before a union is summed up


@dataclass
class Transducer:
    """States are runs of arcs (label, weight, target) in label order; target 0 is the state without arcs.

    The weight of an arc is the count of the phrase that ends with it, 0 if none does. Labels are numbers of ``words``,
    which are sorted, so phrases come out in byte order of their words.
    """

    words: list[bytes]
    first: np.ndarray  # arcs of state s: first[s] to first[s + 1]
    label: np.ndarray
    weight: np.ndarray
    target: np.ndarray
    start: int

    def dump(self) -> bytes:
        weight = self.weight if self.weight.max(initial=0) >= 1 << 32 else self.weight.astype(np.uint32)
        parts = (b" ".join(self.words), *(x.astype(np.uint32) for x in (self.first, self.label)), weight, self.target.astype(np.uint32), self.start)
        return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(parts, protocol=5))

    @staticmethod
    def load(data: bytes) -> Transducer:
        words, first, label, weight, target, start = pickle.loads(zstandard.ZstdDecompressor().decompress(data))
        return Transducer(words.split(b" ") if words else [], *(x.astype(np.int64) for x in (first, label, weight, target)), start)

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        """(codes, weights) of all phrases in order; codes are label numbers, one row a phrase, padded with -1."""
        rows = np.empty((1, 0), np.int32)
        state, found = np.array([self.start]), []
        while len(state):
            sizes = self.first[state + 1] - self.first[state]
            owner = np.repeat(np.arange(len(state)), sizes)
            arc = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + self.first[state][owner]
            rows = np.column_stack([rows[owner], self.label[arc].astype(np.int32)])
            ends = self.weight[arc] > 0
            found.append((rows[ends], self.weight[arc][ends]))
            rows, state = rows[self.target[arc] > 0], self.target[arc][self.target[arc] > 0]
        width = max((codes.shape[1] for codes, _ in found if len(codes)), default=1)
        codes = np.full((sum(len(c) for c, _ in found), width), -1, np.int32)
        at = 0
        for own, _ in found:
            codes[at : at + len(own), : min(own.shape[1], width)] = own[:, :width]
            at += len(own)
        return codes, np.concatenate([w for _, w in found]) if found else np.empty(0, np.int64)

    def weights_of(self, codes: np.ndarray) -> np.ndarray:
        """Composition with the phrases ``codes`` (padded with -1; unknown words are -2): the count of each, 0 if absent."""
        keys = (np.repeat(np.arange(len(self.first) - 1), np.diff(self.first)) << 32) | self.label
        state, weight = np.full(len(codes), self.start), np.zeros(len(codes), np.int64)
        for column in codes.T:
            going = column != -1
            wanted = (state << 32) | np.maximum(column, 0)
            at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
            hit = going & (column >= 0) & (state > 0) & (keys[at] == wanted if len(keys) else False)
            weight[going] = 0
            weight[hit] = self.weight[at[hit]]
            state = np.where(going, 0, state)
            state[hit] = self.target[at[hit]]
        return weight


def build(words: list[bytes], codes: np.ndarray, weights: np.ndarray) -> Transducer:
    """The minimal transducer of sorted phrases (rows of ``codes``, shorter ones padded with -1, which sorts first).

    The run is read in order; a state is finished when its prefix ends and shared with an equal state met before.
    """
    n, width = codes.shape
    new = np.zeros((n, width), bool)  # the row is the first one with its prefix of that length
    if n:
        new[0] = True
        new[1:] = np.logical_or.accumulate(codes[1:] != codes[:-1], axis=1)
        new &= codes >= 0
    register: dict[bytes, int] = {}
    arcs: list[np.ndarray] = []
    first = [0, 0]
    children = np.empty((0, 4), np.int64)  # (row, label, weight, target) of the arcs one level down

    def finish(block: np.ndarray) -> int:
        signature = block.tobytes()
        state = register.get(signature)
        if state is None:
            state = register[signature] = len(first) - 1
            arcs.append(block)
            first.append(first[-1] + len(block))
        return state

    for depth in range(width, 0, -1):
        rows = np.flatnonzero(new[:, depth - 1])
        ends = codes[rows, depth] < 0 if depth < width else np.ones(len(rows), bool)
        targets = np.zeros(len(rows), np.int64)
        bounds = np.searchsorted(children[:, 0], np.r_[rows, n]) if len(children) else np.zeros(len(rows) + 1, np.int64)
        blocks = np.ascontiguousarray(children[:, 1:])
        for place in np.flatnonzero(np.diff(bounds)).tolist():
            targets[place] = finish(blocks[bounds[place] : bounds[place + 1]])
        children = np.column_stack([rows, codes[rows, depth - 1], np.where(ends, weights[rows], 0), targets])
    start = finish(np.ascontiguousarray(children[:, 1:]))
    together = np.concatenate(arcs) if arcs else np.empty((0, 3), np.int64)
    return Transducer(words, np.array(first, np.int64), *together.T, start)


@dataclass
class Union:
    """Sums the weights of many transducers, a bounded number of phrases of them at a time."""

    parts: list[tuple[list[bytes], np.ndarray, np.ndarray]] = field(default_factory=list)
    size: int = 0
    summed: int = 0

    def add(self, one: Transducer) -> None:
        codes, weights = one.phrases()
        self.parts.append((one.words, codes, weights))
        self.size += len(codes)
        if self.size > max(ENTRIES, 2 * self.summed):
            self._sum()

    def _sum(self) -> None:
        words = sorted(set().union(*(w for w, _, _ in self.parts)))
        number = {word: i for i, word in enumerate(words)}
        width = max(codes.shape[1] for _, codes, _ in self.parts)
        codes = np.full((sum(len(c) for _, c, _ in self.parts), width), -1, np.int32)
        at = 0
        for own, part, _ in self.parts:
            rank = np.array([*map(number.__getitem__, own), -1], np.int32)  # the last one stands for padding
            codes[at : at + len(part), : part.shape[1]] = rank[part]
            at += len(part)
        weights = np.concatenate([w for _, _, w in self.parts])
        order = np.lexsort(codes.T[::-1])
        codes, weights = codes[order], weights[order]
        new = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]).any(axis=1)]) if len(codes) else np.empty(0, np.int64)
        self.parts = [(words, codes[new], np.add.reduceat(weights, new) if len(new) else weights)]
        self.size = self.summed = len(new)

    def result(self, least: int) -> Transducer:
        """The transducer of all phrases whose weights sum to ``least`` or more."""
        self._sum()
        words, codes, weights = self.parts[0]
        kept = weights >= least
        return trim(words, codes[kept], weights[kept])


def trim(words: list[bytes], codes: np.ndarray, weights: np.ndarray) -> Transducer:
    """``build`` with only the words that occur."""
    used = np.unique(codes[codes >= 0])
    rank = np.full(len(words) + 1, -1, np.int64)
    rank[used] = np.arange(len(used))
    return build([words[i] for i in used.tolist()], rank[codes], weights)


@dataclass(frozen=True)
class Ranges:
    """Ranges of phrases in word order: cut between first words and, for very frequent first words, between second ones."""

    cuts: tuple[bytes, ...] = ()
    hot: dict[bytes, tuple[int, tuple[bytes, ...]]] = field(default_factory=dict)

    def of(self, first: bytes, second: bytes = b"") -> int:
        if first in self.hot:
            base, cuts = self.hot[first]
            return base + bisect_right(cuts, second)
        return bisect_right(self.cuts, first)

    def of_rows(self, words: list[bytes], codes: np.ndarray) -> np.ndarray:
        by_word = np.searchsorted([bisect_left(words, c) for c in self.cuts], np.arange(len(words)), side="right")
        numbers = by_word[codes[:, 0]]
        for word, (base, cuts) in self.hot.items():
            at = bisect_left(words, word)
            if at < len(words) and words[at] == word:
                rows = np.flatnonzero(codes[:, 0] == at)
                second = codes[rows, 1] if codes.shape[1] > 1 else np.full(len(rows), -1)
                numbers[rows] = base + np.searchsorted([bisect_left(words, c) for c in cuts], second, side="right")
        return numbers


def even_ranges(counts: dict[bytes, int], number: int) -> Ranges:
    """About ``number`` ranges of equal weight by a sample's word counts; heavier words are cut by their second words."""
    total = sum(counts.values())
    if number <= 1 or not total:
        return Ranges()
    cuts, filled, share = [], 0, total / number
    for word in sorted(counts):
        if filled >= share:
            cuts.append(word)
            filled = 0
        filled += counts[word]
    hot, base = {}, len(cuts) + 1
    for word in sorted(w for w, c in counts.items() if c > share):
        own = cuts[:: max(1, int(len(cuts) * share / counts[word]))]
        hot[word] = (base, tuple(own))
        base += len(own) + 1
    return Ranges(tuple(cuts), hot)

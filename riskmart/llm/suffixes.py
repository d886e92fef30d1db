"""Suffix arrays by induced sorting and permuted common prefixes, on numpy arrays.

Induction runs bucket by bucket: all entries of a bucket that are known at a time are handled in one vector step, in the
order in which a scan would meet them, so the work is linear with a small number of steps per symbol.
"""

from __future__ import annotations

from array import array

import numpy as np


def classify(text: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than their successor; the end of the text is smaller than any symbol."""
    n = len(text)
    smaller = np.zeros(n, bool)
    if n > 1:
        differs = np.r_[text[1:] != text[:-1], True]
        at = np.where(differs, np.arange(n), n)
        nearest = np.minimum.accumulate(at[::-1])[::-1]  # where the run of equal symbols ends
        rises = np.r_[text[1:] > text[:-1], False]
        smaller = rises[nearest]
    return smaller


def _deal(entries: np.ndarray, symbols: np.ndarray, buckets: list[list[np.ndarray]]) -> None:
    """Append entries to the buckets of their symbols, keeping their order."""
    if len(entries):
        order = np.argsort(symbols, kind="stable")
        entries, symbols = entries[order], symbols[order]
        cuts = np.flatnonzero(np.diff(symbols)) + 1
        for first, part in zip(np.r_[0, cuts], np.split(entries, cuts)):
            buckets[symbols[first]].append(part)


def induce(text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, size: int) -> np.ndarray:
    """Suffix array from the leftmost-smaller positions in their order: larger types ascending, then smaller descending."""
    n, empty = len(text), np.empty(0, np.int64)
    larger: list[list[np.ndarray]] = [[] for _ in range(size)]
    lms: list[list[np.ndarray]] = [[] for _ in range(size)]
    _deal(leftmost, text[leftmost], lms)
    if n:
        larger[text[n - 1]].append(np.array([n - 1]))  # the end of the text induces the last suffix first

    def before(entries: np.ndarray, kind: bool) -> tuple[np.ndarray, np.ndarray]:
        entries = entries[entries > 0] - 1
        entries = entries[smaller[entries] == kind]
        return entries, text[entries]

    done: list[np.ndarray] = []
    for symbol in range(size):
        parts, wave = [], np.concatenate(larger[symbol]) if larger[symbol] else empty
        while len(wave):
            parts.append(wave)
            entries, symbols = before(wave, False)
            own = symbols == symbol
            wave = entries[own]
            _deal(entries[~own], symbols[~own], larger)
        for part in lms[symbol]:
            _deal(*before(part, False), larger)
        done.append(np.concatenate(parts) if parts else empty)

    descending: list[list[np.ndarray]] = [[] for _ in range(size)]
    found: list[np.ndarray] = []
    for symbol in range(size - 1, -1, -1):
        parts, wave = [], np.concatenate(descending[symbol]) if descending[symbol] else empty
        while len(wave):
            parts.append(wave)
            entries, symbols = before(wave, True)
            own = symbols == symbol
            wave = entries[own]
            _deal(entries[~own], symbols[~own], descending)
        _deal(*before(done[symbol][::-1], True), descending)
        found += [*(part[::-1] for part in parts), done[symbol]]
    return np.concatenate([empty, *found[::-1]])


def name_substrings(text: np.ndarray, ordered: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Names of the leftmost-smaller substrings in sorted order: equal substrings share a name."""
    a, b = ordered[:-1], ordered[1:]
    equal = ends[a] - a == ends[b] - b
    left = np.flatnonzero(equal)
    span = (ends[a] - a)[left]
    step = 0
    while len(left):
        same = text[a[left] + step] == text[b[left] + step]
        equal[left[~same]] = False
        go_on = same & (span > step)
        left, span = left[go_on], span[go_on]
        step += 1
    return np.cumsum(np.r_[0, ~equal]).astype(np.int64)


def rank_by_doubling(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a reduced string, at least by their first ``depth`` names."""
    ranks, n, covered = names.astype(np.int64), len(names), 1
    order = np.argsort(ranks, kind="stable")
    while covered < depth and n:
        follow = np.zeros(n, np.int64)
        follow[: max(n - covered, 0)] = ranks[covered:] + 1
        key = ranks * (int(ranks.max()) + 2) + follow
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.cumsum(np.r_[0, sorted_key[1:] != sorted_key[:-1]])
        ranks = np.empty(n, np.int64)
        ranks[order] = new
        covered *= 2
        if new[-1] == n - 1:
            break
    return order


def _scan(text: list[int], is_smaller: bytes, ordered: list[int], sizes: np.ndarray) -> array:
    """``induce`` entry by entry, for alphabets whose buckets hold a few entries each."""
    n, order = len(text), array("i", [-1]) * len(text)
    ends = np.cumsum(sizes)
    tails = ends.tolist()
    for at in reversed(ordered):
        symbol = text[at]
        tails[symbol] -= 1
        order[tails[symbol]] = at
    heads = (ends - sizes).tolist()
    symbol = text[n - 1]
    order[heads[symbol]] = n - 1  # the end of the text induces the last suffix first
    heads[symbol] += 1
    for at in order:
        if at > 0 and not is_smaller[at - 1]:
            symbol = text[at - 1]
            order[heads[symbol]] = at - 1
            heads[symbol] += 1
    tails = ends.tolist()
    for place in range(n - 1, -1, -1):
        at = order[place]
        if at > 0 and is_smaller[at - 1]:
            symbol = text[at - 1]
            tails[symbol] -= 1
            order[tails[symbol]] = at - 1
    return order


def induced_order(text: np.ndarray, size: int) -> np.ndarray:
    """Suffixes of a string over a large alphabet in order, by induction from its recursively sorted leftmost-smaller positions."""
    n = len(text)
    smaller = classify(text)
    leftmost = np.flatnonzero(smaller & ~np.r_[True, smaller[:-1]]) if n else np.empty(0, np.int64)
    symbols, flags, sizes = text.tolist(), smaller.tobytes(), np.bincount(text, minlength=size)
    if len(leftmost) > 1:
        ends = np.zeros(n, np.int64)
        ends[leftmost] = np.r_[leftmost[1:], n - 1]
        first = np.frombuffer(_scan(symbols, flags, leftmost.tolist(), sizes), np.intc)
        is_leftmost = np.zeros(n, bool)
        is_leftmost[leftmost] = True
        ordered = first[is_leftmost[first]].astype(np.int64)
        names = name_substrings(text, ordered, ends)
        if names[-1] + 1 < len(leftmost):
            place = np.empty(n, np.int64)
            place[ordered] = names
            ordered = leftmost[induced_order(place[leftmost], int(names[-1]) + 1)]
        leftmost = ordered
    return np.frombuffer(_scan(symbols, flags, leftmost.tolist(), sizes), np.intc).astype(np.int64) if n else np.empty(0, np.int64)


def suffix_array(text: np.ndarray, size: int, small_alphabet: int = 1024) -> np.ndarray:
    """Suffixes of ``text`` (symbols below ``size``) in order.

    The leftmost-smaller substrings are sorted by induction and named; if names repeat, the reduced string of names is
    sorted the same way, and so on. Over a small alphabet whole buckets are handled in one vector step; over a large one,
    where a bucket holds a few entries, entry by entry.
    """
    if size > small_alphabet:
        return induced_order(text, size)
    n = len(text)
    smaller = classify(text)
    leftmost = np.flatnonzero(smaller & ~np.r_[True, smaller[:-1]]) if n else np.empty(0, np.int64)
    if len(leftmost) > 1:
        ends = np.zeros(n, np.int64)
        ends[leftmost] = np.r_[leftmost[1:], n - 1]
        first = induce(text, smaller, leftmost, size)
        is_leftmost = np.zeros(n, bool)
        is_leftmost[leftmost] = True
        ordered = first[is_leftmost[first]]
        names = name_substrings(text, ordered, ends)
        if names[-1] + 1 < len(leftmost):
            place = np.empty(n, np.int64)
            place[ordered] = names
            ordered = leftmost[suffix_array(place[leftmost], int(names[-1]) + 1, small_alphabet)]
        leftmost = ordered
    return induce(text, smaller, leftmost, size)


def permuted_common_prefixes(text: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(prefix, previous): the common prefix of each suffix with the one before it in the order, by text position.

    Prefixes are measured where the symbols before the two suffixes differ and decrease by one elsewhere. ``text`` holds
    bytes; the first suffix in the order has no previous one (-1) and prefix 0.
    """
    n = len(text)
    previous = np.full(n, -1, np.int64)
    previous[order[1:]] = order[:-1]
    words = np.zeros(n + 16, np.uint64)
    words[:n] = text
    for shift in (1, 2, 4):
        words[:-shift] = (words[:-shift] << np.uint64(8 * shift)) | words[shift:]
    where = np.arange(n)
    measured = (previous <= 0) | (where == 0)
    inner = np.flatnonzero(~measured)
    measured[inner] = text[inner - 1] != text[previous[inner] - 1]
    prefix = np.zeros(n, np.int64)
    at = np.flatnonzero(measured & (previous >= 0))
    length = 0
    while len(at):
        a, b = at + length, previous[at] + length
        inside = np.maximum(a, b) + 8 <= n
        same = inside & (words[np.minimum(a, n)] == words[np.minimum(b, n)])
        rest = at[~same]
        if len(rest):
            a, b, equal = rest + length, previous[rest] + length, np.ones(len(rest), bool)
            total = np.full(len(rest), length)
            for step in range(8):
                equal &= (np.maximum(a, b) + step < n)
                equal &= text[np.minimum(a + step, n - 1)] == text[np.minimum(b + step, n - 1)]
                total += equal
            prefix[rest] = total
        at = at[same]
        length += 8
    last = np.maximum.accumulate(np.where(measured, where, 0))
    return np.maximum(np.where(measured, prefix, prefix[last] - (where - last)), 0), previous

"""Suffix sorting by induction with queues that spill to disk.

S* suffixes (an S-type suffix after an L-type one) are sorted first: their substrings are sorted by an
induction pass and named, and the string of names is sorted by recursion. From them an ascending pass
induces the L-type and a descending pass the S-type suffixes. A priority queue of (first symbol, arrival)
is what both passes need; here it is one queue a symbol, whose blocks go to a scratch file once more than
``memory`` suffixes wait. Positions move in whole blocks. What waits is bounded by ``memory``; the text, its types, the names and the
finished order are arrays in memory, some 20 bytes a symbol, so a shard's size is what bounds a task.

A reduced string of at most ``base`` names is sorted by prefix doubling in memory, which also carries the
common-prefix bound: two suffixes are told apart as far as ``depth`` symbols, which is all the caller asks.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

#: Suffixes that wait in memory, and names sorted by doubling.
MEMORY, BASE = 1 << 24, 1 << 23
BLOCK = 1 << 20


class Spill:
    """Scratch file shared by the queues of one pass; the operating system frees it with the process."""

    def __init__(self, memory: int):
        self.memory, self.held, self.file, self.queues = memory, 0, None, []

    def note(self, n: int) -> None:
        self.held += n
        if self.held > self.memory:
            self.file = self.file or tempfile.TemporaryFile()  # noqa: SIM115
            for q in self.queues:
                q.flush(self.file)
            self.held = 0

    def close(self) -> None:
        if self.file:
            self.file.close()


class Queue:
    """First in, first out, in blocks of positions."""

    __slots__ = ("spill", "parts", "size")

    def __init__(self, spill: Spill):
        self.spill, self.parts, self.size = spill, [], 0
        spill.queues.append(self)

    def put(self, block: np.ndarray) -> None:
        if len(block):
            self.parts.append(block)
            self.size += len(block)
            self.spill.note(len(block))

    def flush(self, file) -> None:
        for i, part in enumerate(self.parts):
            if isinstance(part, np.ndarray):
                at = file.seek(0, 2)
                file.write(part.tobytes())
                self.parts[i] = (at, len(part))

    def blocks(self) -> Iterator[np.ndarray]:
        held: list[np.ndarray] = []
        n = 0
        for part in self.parts:
            if not isinstance(part, np.ndarray):
                at, size = part
                self.spill.file.seek(at)
                part = np.frombuffer(self.spill.file.read(8 * size), dtype=np.int64)
            held.append(part)
            n += len(part)
            if n >= BLOCK:
                yield held[0] if len(held) == 1 else np.concatenate(held)
                held, n = [], 0
        if held:
            yield held[0] if len(held) == 1 else np.concatenate(held)


def suffix_types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is less than the next one; the last symbol is the unique least."""
    n = len(t)
    step = np.flatnonzero(t[1:] != t[:-1])
    where = np.searchsorted(step, np.arange(n - 1))
    stop = step[np.minimum(where, len(step) - 1)]
    out = np.empty(n, dtype=bool)
    out[:-1] = t[stop] < t[stop + 1]
    out[-1] = True
    return out


def _pass(t: np.ndarray, kind: np.ndarray, symbols: np.ndarray, seeds: dict[int, np.ndarray], done: dict[int, Queue] | None, spill: Spill) -> dict[int, Queue]:
    """One induction. Ascending over L-type suffixes from ``seeds`` if ``done`` is None, else descending over S-type ones.

    ``seeds`` are sorted S* suffixes by symbol. The result has the suffixes of the pass by symbol, in
    ascending or descending order.
    """
    up = done is None
    waiting = {int(c): Queue(spill) for c in symbols}
    out = {int(c): Queue(spill) for c in symbols}

    def induce(block: np.ndarray, c: int) -> None:
        before = block[block > 0] - 1
        first = t[before]
        keep = first > c if up else first < c
        before, first = before[keep], first[keep]
        if not len(before):
            return
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        cuts = np.flatnonzero(first[1:] != first[:-1]) + 1
        for at, part in zip(np.r_[0, cuts], np.split(before, cuts), strict=True):
            waiting[int(first[at])].put(part)

    if not up:  # the last suffix precedes all; it is no one's successor
        waiting[int(t[-1])].put(np.array([len(t) - 1]))
    for c in symbols if up else symbols[::-1]:
        c = int(c)
        wave = waiting.pop(c)
        while wave.size:
            following = Queue(spill)
            for block in wave.blocks():
                out[c].put(block)
                before = block[block > 0] - 1
                same = (t[before] == c) & (kind[before] != up)
                following.put(before[same])
            wave = following
        for block in out[c].blocks():
            induce(block, c)
        if up:
            if c in seeds:
                induce(seeds[c], c)
        else:
            for block in reversed(list(done[c].blocks())):
                induce(block[::-1], c)
    return out


def _by_symbol(t: np.ndarray, positions: np.ndarray) -> dict[int, np.ndarray]:
    """Positions by symbol, their order kept."""
    first = t[positions]
    order = np.argsort(first, kind="stable")
    positions, first = positions[order], first[order]
    cuts = np.flatnonzero(first[1:] != first[:-1]) + 1
    return {int(first[at]): part for at, part in zip(np.r_[0, cuts], np.split(positions, cuts), strict=True)}


def _star_order(t: np.ndarray, kind: np.ndarray, symbols: np.ndarray, stars: np.ndarray, star: np.ndarray, memory: int) -> np.ndarray:
    """S* suffixes in the order that an induction from ``stars`` gives them."""
    spill = Spill(memory)
    up = _pass(t, kind, symbols, _by_symbol(t, stars), None, spill)
    down = _pass(t, kind, symbols, {}, up, spill)
    parts = [b[::-1][star[b[::-1]]] for c in symbols for b in reversed(list(down[int(c)].blocks()))]
    spill.close()
    return np.concatenate(parts)


def _names(t: np.ndarray, stars: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Names of the S* substrings, in the order of the text; equal substrings have equal names."""
    n = len(t)
    ends = np.empty(len(stars), dtype=np.int64)
    ends[:-1], ends[-1] = stars[1:], n - 1
    place = np.searchsorted(stars, ordered)
    size = ends[place] - ordered + 1
    same = size[1:] == size[:-1]
    left = np.flatnonzero(same)
    for k in range(int(size.max())):
        alive = left[size[left] > k]
        if not len(alive):
            break
        differ = t[ordered[alive] + k] != t[ordered[alive + 1] + k]
        same[alive[differ]] = False
        left = alive[~differ]
    names = np.empty(len(stars), dtype=np.int64)
    names[place] = np.concatenate([[0], np.cumsum(~same)])
    return names


def doubled_order(names: np.ndarray, depth: int) -> np.ndarray:
    """Suffix order of a string of integers, told apart as far as ``depth`` symbols, by prefix doubling."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    sorted_names = names[order]
    heads = np.r_[True, sorted_names[1:] != sorted_names[:-1]]
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1
    start = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    rank[order] = start
    k = 1
    while k < depth:
        # Only members of groups with more than one suffix are sorted on.
        single = heads & np.r_[heads[1:], True]
        open_ = np.flatnonzero(~single)
        if not len(open_):
            break
        suffix = order[open_]
        second = rank[np.minimum(suffix + k, n)]
        by = np.lexsort((second, start[open_]))
        suffix, second = suffix[by], second[by]
        order[open_] = suffix
        fresh = heads[open_] | np.r_[True, second[1:] != second[:-1]]
        heads[open_] = fresh
        start = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
        rank[suffix] = start[open_]
        k *= 2
    return order


def suffix_array(text: np.ndarray, depth: int, memory: int = MEMORY, base: int = BASE) -> np.ndarray:
    """Suffixes of ``text`` (integers above 0) in ascending order, told apart as far as ``depth`` symbols at least."""
    t = np.concatenate([text, np.zeros(1, dtype=text.dtype)])
    kind = suffix_types(t) if len(t) > 1 else np.ones(1, dtype=bool)
    star = np.zeros(len(t), dtype=bool)
    star[1:] = kind[1:] & ~kind[:-1]
    stars = np.flatnonzero(star)
    if not len(stars):
        return np.zeros(0, dtype=np.int64)
    symbols = np.unique(t)
    names = _names(t, stars, _star_order(t, kind, symbols, stars, star, memory))
    if names.max() + 1 == len(stars):
        ordered = np.empty(len(stars), dtype=np.int64)
        ordered[names] = stars
    elif len(names) <= base:
        ordered = stars[doubled_order(names, depth)]
    else:
        ordered = stars[suffix_array(names + 1, depth, memory, base)]
    spill = Spill(memory)
    up = _pass(t, kind, symbols, _by_symbol(t, ordered), None, spill)
    down = _pass(t, kind, symbols, {}, up, spill)
    parts = []
    for c in symbols:
        parts += up[int(c)].blocks()
        parts += [b[::-1] for b in reversed(list(down[int(c)].blocks()))]
    spill.close()
    out = np.concatenate(parts)
    return out[out < len(text)]

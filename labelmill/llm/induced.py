"""Suffix sorting by induced sorting, with its queues on disk.

The queue of the induction is ordered by first symbol, then by the rank of the rest.
As suffixes are pushed in rank order, it is one file with a first-in-first-out range
for each symbol. It is read in blocks: a block is taken up to the first place that
one of its own pushes fills, so every step works on whole arrays. The string, types,
queue and names of each level of the recursion are memory-mapped files, so the
arrays held at a time are bounded by the block, not by the string.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np

BLOCK = 1 << 17


class Files:
    """Arrays in files of one folder, which the caller removes."""

    def __init__(self, folder: str) -> None:
        self.folder, self.n = Path(folder), 0

    def array(self, n: int, kind: type) -> np.ndarray:
        self.n += 1
        return np.memmap(self.folder / f"{self.n}.bin", kind, "w+", shape=(max(n, 1),)).view(np.ndarray)[:n]


def blocks(n: int, size: int = BLOCK) -> Iterator[slice]:
    for i in range(0, n, size):
        yield slice(i, min(i + size, n))


def _types(text: np.ndarray, files: Files) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last (sentinel) is."""
    n = len(text)
    small = files.array(n, bool)
    small[n - 1] = carry = True
    for b in reversed(list(blocks(n - 1))):
        here, after = text[b].astype(np.int64), text[b.start + 1 : b.stop + 1].astype(np.int64)
        decided = here != after
        # an equal pair takes the type of the next decided one
        at = np.where(decided, np.arange(len(here)), len(here))
        at = np.minimum.accumulate(at[::-1])[::-1]
        less = np.append(here < after, carry)
        small[b] = less[at]
        carry = bool(small[b.start])
    return small


def _heads(text: np.ndarray, symbols: int) -> np.ndarray:
    counts = np.zeros(symbols, np.int64)
    for b in blocks(len(text)):
        counts += np.bincount(text[b], minlength=symbols)
    return np.concatenate(([0], np.cumsum(counts)))


def _ranks_within(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each push how many earlier ones have its symbol; the symbols and their numbers."""
    n = len(symbols)
    order = symbols.argsort(kind="stable")
    ranked = symbols[order]
    new = np.empty(n, bool)
    new[:1] = True
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    first = new.nonzero()[0]
    sizes = np.empty(len(first), np.int64)
    np.subtract(first[1:], first[:-1], out=sizes[:-1])
    sizes[-1:] = n - first[-1:]
    within = np.empty(n, np.int64)
    within[order] = np.arange(n) - first.repeat(sizes)
    return within, ranked[first], sizes


def _pass(queue: np.ndarray, text: np.ndarray, small: np.ndarray, free: np.ndarray, forward: bool) -> None:
    """One induction: larger suffixes from the front, or smaller ones from the back."""
    n, done, size = len(queue), 0, 1 << 10
    while done < n:
        size = min(size, n - done)
        block = queue[done : done + size] if forward else queue[n - done - size : n - done][::-1]
        place = (block > 0).nonzero()[0]
        before = block[place].astype(np.int64) - 1
        push = small[before] != forward
        place, before = place[push], before[push]
        taken = size
        if len(before):
            symbols = text[before]
            goal = free[symbols]
            # the first push of a symbol goes to its first free place: nothing comes nearer
            ahead = int(goal.min()) - done if forward else n - int(goal.max()) - done
            if ahead < size:
                taken = ahead
                some = int(place.searchsorted(taken))
                before, symbols, goal = before[:some], symbols[:some], goal[:some]
            within, kinds, sizes = _ranks_within(symbols)
            queue[goal + within if forward else goal - 1 - within] = before
            free[kinds] += sizes if forward else -sizes
        done += taken
        size = min(BLOCK, max(256, 3 * taken // 2))


def _induce(queue: np.ndarray, text: np.ndarray, small: np.ndarray, heads: np.ndarray, seeds: np.ndarray) -> None:
    """Fill the queue from the sampled suffixes ``seeds``, given in the order of their suffixes."""
    for b in blocks(len(queue)):
        queue[b] = -1
    tails = heads[1:].copy()
    for b in reversed(list(blocks(len(seeds)))):
        part = np.asarray(seeds[b])[::-1].astype(np.int64)
        symbols = text[part]
        within, kinds, sizes = _ranks_within(symbols)
        queue[tails[symbols] - 1 - within] = part
        tails[kinds] -= sizes
    _pass(queue, text, small, heads[:-1].copy(), True)
    # the smaller ones are induced anew, from the larger ones alone
    _pass(queue, text, small, heads[1:].copy(), False)


def suffix_order(text: np.ndarray, symbols: int, files: Files) -> np.ndarray:
    """Suffixes of ``text`` in order. Its last symbol is 0 and occurs only there."""
    n = len(text)
    place = np.int32 if n < 1 << 31 else np.int64
    queue = files.array(n, place)
    if n == 1:
        queue[0] = 0
        return queue
    small, heads = _types(text, files), _heads(text, symbols)
    sampled = files.array(n // 2 + 1, place)
    m = 0
    for b in blocks(n):
        prior = small[max(b.start - 1, 0) : b.stop - 1] if b.start else np.concatenate(([True], small[: b.stop - 1]))
        found = np.flatnonzero(small[b] & ~prior) + b.start
        sampled[m : m + len(found)] = found
        m += len(found)
    sampled = sampled[:m]
    _induce(queue, text, small, heads, sampled)
    # sampled substrings now stand in order in the queue; equal ones get one name
    rank = files.array(n // 2 + 1, place)
    sorted_ones = files.array(m, place)
    k = 0
    for b in blocks(n):
        part = queue[b].astype(np.int64)
        found = part[small[part] & (part > 0) & ~small[np.maximum(part - 1, 0)]]
        sorted_ones[k : k + len(found)] = found
        k += len(found)
    name, last = 0, -1
    for b in blocks(m):
        part = sorted_ones[b].astype(np.int64)
        differs = ~_same_substrings(text, small, np.concatenate(([last], part[:-1])), part)
        names = name + np.cumsum(differs)
        rank[part // 2] = names
        name, last = int(names[-1]), int(part[-1])
    if name == m:
        order = sorted_ones
    else:
        reduced = files.array(m, np.uint16 if name <= 1 << 16 else place)
        for b in blocks(m):
            reduced[b] = rank[sampled[b].astype(np.int64) // 2] - 1
        inner = suffix_order(reduced, name, files)
        order = files.array(m, place)
        for b in blocks(m):
            order[b] = sampled[inner[b]]
    _induce(queue, text, small, heads, order)
    return queue


def _same_substrings(text: np.ndarray, small: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the sampled substrings at a and b (up to the next sampled place) are equal."""
    n = len(text)
    same = np.zeros(len(a), bool)
    live = np.flatnonzero((a >= 0) & (np.maximum(a, b) < n - 1))
    step = 0
    while len(live):
        x, y = a[live] + step, b[live] + step
        inside = np.maximum(x, y) < n
        live, x, y = live[inside], x[inside], y[inside]
        alike = (text[x] == text[y]) & (small[x] == small[y])
        live, x, y = live[alike], x[alike], y[alike]
        if step:
            end_x, end_y = small[x] & ~small[x - 1], small[y] & ~small[y - 1]
            same[live[end_x & end_y]] = True
            live = live[~(end_x | end_y)]
        step += 1
    return same


def repeats(text: np.ndarray, order: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Places in ``order`` whose suffix shares ``length`` bytes with the one before it.

    ``starts`` marks the places where ``length`` bytes follow inside one string.
    Neighbours are compared eight bytes at a time while they agree.
    """
    width = 8 if length >= 8 else 1
    words = np.ndarray((len(text) - width + 1,), "<u8" if width == 8 else np.uint8, np.ascontiguousarray(text), strides=(1,))
    found = []
    steps = [*range(0, length - width + 1, width)]
    if steps[-1] != length - width:
        steps.append(length - width)
    last = -1
    for b in blocks(len(order)):
        part = order[b].astype(np.int64)
        prior = np.concatenate(([last], part[:-1]))
        last = int(part[-1])
        live = np.flatnonzero((prior >= 0) & starts[part] & starts[np.maximum(prior, 0)])
        for step in steps:
            if not len(live):
                break
            live = live[words[part[live] + step] == words[prior[live] + step]]
        found.append(live + b.start)
    return np.concatenate(found) if found else np.zeros(0, np.int64)

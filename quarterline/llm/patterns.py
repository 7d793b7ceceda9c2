"""Packing of a length histogram into containers of one capacity. Works on counts per length, never on items.

Patterns are combinations of lengths that fill a container. There are far too many to list, so those that a fit needs
are generated: a knapsack over the capacity, its values what the fit so far leaves over of each length, yields for every
length the best pattern that contains it. Each time the lengths are dealt anew into small groups with a knapsack each, so
that patterns differ and every length is in some. Repeat counts are fitted to the histogram by non-negative least squares over
the patterns generated so far, rounded to what is there, and taken off; the rest is fitted again until no pattern is
left. What remains then is packed largest first, each container topped up with the largest lengths that still fit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Cells of a container's room in the search for patterns. Up to this capacity it is exact; beyond, lengths are rounded
#: up to whole cells, which leaves at most a cell for each item unused.
CELLS = 8192
#: Generations of patterns per fit, and lengths per knapsack.
GENERATIONS, GROUP = 12, 64
#: A fit has converged when a step changes the repeats by less than this share; the steps that it may take until then.
TOLERANCE, STEPS = 1e-3, 400
#: Part of what is left that rounded-down repeats have to use to be enough.
SHARE = 0.25
#: Part of all that is left to the residual packing, which needs some choice.
REST = 0.05


@dataclass(frozen=True)
class Pattern:
    """Lengths of one container (with multiplicity) and the number of containers filled that way; whether it was fitted."""

    lengths: tuple[tuple[int, int], ...]
    repeats: int
    fitted: bool = False


@dataclass
class Patterns:
    """Sparse columns: pattern `column` holds length `length` `times` times; sorted by column."""

    column: np.ndarray
    length: np.ndarray
    times: np.ndarray
    size: int

    def __add__(self, other: Patterns) -> Patterns:
        parts = (np.concatenate(p) for p in ((self.column, other.column + self.size), (self.length, other.length), (self.times, other.times)))
        return Patterns(*parts, self.size + other.size)

    def used(self, x: np.ndarray, width: int) -> np.ndarray:
        """How often each length is used by so many repeats."""
        return np.bincount(self.length, weights=self.times * x[self.column], minlength=width)

    def gained(self, value: np.ndarray) -> np.ndarray:
        """Sum of a value per length over each pattern."""
        return np.bincount(self.column, weights=self.times * value[self.length], minlength=self.size)


def _none() -> Patterns:
    return Patterns(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), 0)


def generate(value: np.ndarray, counts: np.ndarray, capacity: int, most_times: int | None = None) -> Patterns:
    """For every length that occurs, the full pattern of greatest value that holds it, no length more often than it
    occurs (and besides the first one not more than `most_times`). Lengths without a positive value are used as the first of a pattern only."""
    unit = -(-capacity // CELLS)
    room = capacity // unit
    cells = -(-np.arange(len(counts)) // unit)
    # Bounded numbers of a length as chunks of 1, 2, 4 ... pieces, each taken or not.
    chunks = []
    for length in np.flatnonzero((counts > 0) & (value > 0)).tolist():
        most, k = min(int(counts[length]), room // int(cells[length]), most_times or room), 1
        while most > 0:
            chunks.append((length, min(k, most)))
            most -= k
            k *= 2
    best = np.full(room + 1, -np.inf)
    best[0] = 0.0
    taken = np.zeros((len(chunks), room // 8 + 1), np.uint8)
    for i, (length, k) in enumerate(chunks):
        w = int(cells[length]) * k
        with_it = best[: room + 1 - w] + k * value[length]
        better = np.zeros(room + 1, bool)
        np.greater(with_it, best[w:], out=better[w:])
        np.maximum(best[w:], with_it, out=best[w:])
        taken[i] = np.packbits(better)
    first = np.flatnonzero(counts > 0)
    left = room - cells[first]
    reachable = (left >= 0) & (best[np.maximum(left, 0)] > -np.inf)
    first, left = first[reachable], left[reachable]
    columns, lengths, times = [np.arange(len(first))], [first], [np.ones(len(first), np.int64)]
    for i in range(len(chunks) - 1, -1, -1):
        length, k = chunks[i]
        hit = np.flatnonzero(taken[i][left >> 3] >> (7 - (left & 7)) & 1)
        if len(hit):
            columns.append(hit)
            lengths.append(np.full(len(hit), length))
            times.append(np.full(len(hit), k))
            left[hit] -= int(cells[length]) * k
    # Chunks of one length, and the first piece of it, become one entry.
    key, place = np.unique(np.concatenate(columns) * len(counts) + np.concatenate(lengths), return_inverse=True)
    n = np.bincount(place, weights=np.concatenate(times)).astype(np.int64) if len(key) else np.zeros(0, np.int64)
    column, length = key // len(counts), key % len(counts)
    possible = np.ones(len(first), bool)
    possible[column[n > counts[length]]] = False
    keep = possible[column]
    return Patterns(np.cumsum(possible)[column[keep]] - 1, length[keep], n[keep], int(possible.sum()))


def fit_repeats(patterns: Patterns, counts: np.ndarray, x: np.ndarray | None = None) -> np.ndarray:
    """x >= 0 that minimises the sum over lengths l of l (A x - counts)^2, A holding how often each pattern uses each
    length; long items, which are harder to place, count more: accelerated projected gradient steps, each pattern with a step of its own, until
    they hardly change anything."""
    weight, target = np.arange(len(counts), dtype=float), counts.astype(float)
    # Steps by the row sums of A'LA never overshoot.
    step = 1.0 / np.maximum(patterns.gained(weight * patterns.used(np.ones(patterns.size), len(counts))), 1e-9)
    x = np.zeros(patterns.size) if x is None else x
    y, t = x, 1.0
    for _ in range(STEPS):
        new = np.maximum(y + step * patterns.gained(weight * (target - patterns.used(y, len(counts)))), 0.0)
        moved = np.abs(new - x).sum()
        if (y - new) @ ((new - x) / step) > 0:
            t = 1.0  # the momentum points uphill
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = np.maximum(new + (t - 1) / t_new * (new - x), 0.0)
        x, t = new, t_new
        if moved <= TOLERANCE * max(x.sum(), 1e-9):
            break
    return x


def _fitted(left: np.ndarray, capacity: int) -> list[Pattern]:
    """One fit to what is left, rounded and taken off `left`."""
    patterns, x = _none(), np.zeros(0)
    over = left.astype(float)
    rng, lengths = np.random.default_rng(0), np.flatnonzero(left)
    several = capacity * left.sum() >= 4 * (left @ np.arange(len(left)))
    for k in range(GENERATIONS):
        value, new = np.arange(len(left)) * np.maximum(over, 0.0), _none()
        # Containers of few items need the whole choice; for others all lengths stay together every third time.
        groups = -(-len(lengths) // GROUP) if k % 3 and several else 1
        for group in np.array_split(rng.permutation(lengths), groups):
            among = np.zeros_like(left)
            among[group] = left[group]
            new += generate(value, among, capacity, 3 if groups > 1 else None)
        if not new.size:
            break
        patterns, x = patterns + new, np.concatenate([x, np.zeros(new.size)])
        x = fit_repeats(patterns, left, x)
        over = left - patterns.used(x, len(left))
    out: list[Pattern] = []
    begin = np.searchsorted(patterns.column, np.arange(patterns.size + 1))
    # Rounded down, where that uses a good part; else patterns that are wanted at all are used once.
    whole = np.floor(x).sum() * capacity >= SHARE * (left @ np.arange(len(left)))
    for least in (1.0 if whole else TOLERANCE,):
        for k in np.argsort(-x, kind="stable").tolist():
            if x[k] < least:
                break
            lengths, times = (a[begin[k] : begin[k + 1]] for a in (patterns.length, patterns.times))
            repeats = min(max(int(x[k]), 1), int((left[lengths] // times).min()))
            if repeats > 0:
                left[lengths] -= times * repeats
                out.append(Pattern(tuple(zip(lengths.tolist(), times.tolist(), strict=True)), repeats, True))
        if out:
            break
    return out


def _residual(left: np.ndarray, capacity: int) -> list[Pattern]:
    """Largest first, each container topped up with the largest lengths that fit."""
    below = np.concatenate([[0], np.maximum.accumulate(np.where(left > 0, np.arange(len(left)), 0))])[1:]
    out = []

    def largest(limit: int) -> int:
        """Largest length up to the limit with a count; shortens the path it walks."""
        at = int(below[limit])
        while at > 0 and left[at] == 0:
            at = int(below[at - 1])
        below[limit] = at
        return at

    top = largest(capacity)
    while top:
        room, used = capacity, {}
        while room:
            length = largest(room)
            # Lengths may be used up by this very container.
            while length and left[length] - used.get(length, 0) <= 0:
                length = largest(length - 1) if length > 1 else 0
            if not length:
                break
            n = int(min(room // length, left[length] - used.get(length, 0)))
            used[length] = used.get(length, 0) + n
            room -= n * length
        repeats = int(min(left[k] // n for k, n in used.items()))
        for k, n in used.items():
            left[k] -= n * repeats
        out.append(Pattern(tuple(used.items()), repeats))
        top = largest(top)
    return out


def pack(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """counts[l] items of length l, 0 < l <= capacity; every item is used exactly once."""
    left = np.array(counts, dtype=np.int64)
    left[0] = 0
    out: list[Pattern] = []
    tokens = left @ np.arange(len(left))
    while left @ np.arange(len(left)) > REST * tokens:
        fitted = _fitted(left, capacity)
        out += fitted
        # A fit that fills hardly any of the containers that the rest needs is the last one.
        if 100 * sum(p.repeats for p in fitted) * capacity <= left @ np.arange(len(left)):
            break
    return out + _residual(left, capacity)

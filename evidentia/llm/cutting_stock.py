"""Cutting-stock plans by column generation: which patterns of piece lengths fill sequences with the least padding.

The linear program has a row for each piece length and a column for each pattern (a multiset of lengths that fits in one
sequence); a column costs the sequence's padded length, which is the capacity, or the filled length itself where that
is a power of two. Columns are priced by an exact-fill knapsack over the duals. The fractional solution is rounded
down, and what it leaves is packed by best fit, longest first. Sizes depend on the capacity only, not on the corpus.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np

#: The program ends when padding is proven within this share of the optimum, or after this many pivots.
TOLERANCE = 0.002
MOST_PIVOTS = 4000


@dataclass(frozen=True)
class Plan:
    """Slots for the pieces of each length, in rank order. Row k of the arrays: pieces of `length[k]` ranked from
    `first[k]` on go `copies[k]` to a sequence, at `offset[k]`, into the sequences from `sequence[k]` on."""

    length: np.ndarray
    first: np.ndarray
    copies: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int
    pivots: int

    def place(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces of these lengths and ranks within their length."""
        key = lambda length, rank: (length.astype(np.int64) << 48) | rank
        row = np.searchsorted(key(self.length, self.first), key(lengths, ranks), side="right") - 1
        k = ranks - self.first[row]
        return self.sequence[row] + k // self.copies[row], self.offset[row] + k % self.copies[row] * lengths


def padded(filled: int, capacity: int) -> int:
    return filled if filled & (filled - 1) == 0 else capacity


def _price(duals: np.ndarray, lengths: np.ndarray, costs: np.ndarray, capacity: int) -> tuple[float, list[np.ndarray]]:
    """Best value over cost of any pattern; and patterns worth more than they cost, the best first: the best of all,
    and for each length the best full sequence that has it (counts by row)."""
    best = np.full(capacity + 1, -np.inf)
    best[0] = 0.0
    last = np.zeros(capacity + 1, np.int64)
    used = duals > 1e-12
    items, values, rows = lengths[used], duals[used], used.nonzero()[0]
    fits = np.searchsorted(items, np.arange(capacity + 1), side="right")
    for filled in range(1, capacity + 1):
        if k := fits[filled]:
            got = best[filled - items[:k]] + values[:k]
            at = int(got.argmax())
            best[filled], last[filled] = got[at], at
    ratio, above = best[1:] / costs[1:], best[1:] - costs[1:]

    def trace(filled: int, first: int | None = None) -> np.ndarray:
        pattern = np.zeros(len(lengths))
        if first is not None:
            pattern[rows[first]] += 1
            filled -= items[first]
        while filled > 0:
            pattern[rows[last[filled]]] += 1
            filled -= items[last[filled]]
        return pattern

    found = [trace(int(above.argmax()) + 1)]
    with_item = best[capacity - items] + values - capacity
    for k in np.argsort(-with_item):
        if with_item[k] <= 1e-6 * capacity:
            break
        found.append(trace(capacity, int(k)))
    return float(ratio.max()), found


def _start(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> np.ndarray:
    """A feasible basis: two lengths that fill a sequence share a column where the rarer one lasts; else one length by itself."""
    columns = np.diag(capacity // lengths).astype(float)
    row = {int(n): k for k, n in enumerate(lengths)}
    for n, k in row.items():
        other = row.get(capacity - n)
        if other is not None and other != k and (demand[k], k) < (demand[other], other):
            columns[:, k] = 0
            columns[[k, other], k] = 1
    return columns


def _solve(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[list[tuple[np.ndarray, int]], int]:
    """Whole-number uses of patterns that stay within demand, and the pivots made."""
    costs = np.array([padded(k, capacity) for k in range(capacity + 1)], float)
    price_of = lambda pattern: costs[int(round(float(pattern @ lengths)))]
    columns = _start(lengths, demand, capacity)
    cost = np.array([price_of(columns[:, k]) for k in range(len(lengths))])
    inverse = np.linalg.inv(columns)
    amount, duals = inverse @ demand, cost @ inverse
    pivots, bound = 0, 0.0
    while pivots < MOST_PIVOTS:
        ratio, patterns = _price(duals, lengths, costs, capacity)
        total = float(cost @ amount)
        bound = max(bound, float(duals @ demand) / max(ratio, 1.0))
        if ratio <= 1 + 1e-9 or total - bound <= TOLERANCE * bound:
            break
        for pattern in patterns:
            reduced = price_of(pattern) - float(duals @ pattern)
            if reduced > -1e-6 * capacity:
                continue
            step = inverse @ pattern
            ahead = step > 1e-9
            share = np.full(len(lengths), np.inf)
            share[ahead] = amount[ahead] / step[ahead]
            out = int(share.argmin())
            moved = share[out]
            row = inverse[out] / step[out]
            duals = duals + reduced * row
            inverse -= np.outer(step, row)
            inverse[out] = row
            amount = np.maximum(amount - moved * step, 0.0)
            amount[out] = moved
            columns[:, out], cost[out] = pattern, price_of(pattern)
            pivots += 1
    uses, left = [], demand.astype(np.int64).copy()
    for k in np.argsort(-amount):
        pattern = columns[:, k].astype(np.int64)
        some = pattern > 0
        whole = min(int(amount[k] + 1e-6), int((left[some] // pattern[some]).min()))
        if whole > 0:
            uses.append((pattern, whole))
            left -= whole * pattern
    return [*uses, *_best_fit(lengths, left, capacity)], pivots


def _best_fit(lengths: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """What the rounding left, longest first, each into the fullest sequence that takes it."""
    spaces: list[int] = []
    room: dict[int, list[list[int]]] = defaultdict(list)
    for row in range(len(lengths) - 1, -1, -1):
        length = int(lengths[row])
        for _ in range(int(left[row])):
            at = bisect_left(spaces, length)
            space = spaces.pop(at) if at < len(spaces) else capacity
            bin_ = room[space].pop() if space < capacity else []
            bin_.append(row)
            insort(spaces, space - length)
            room[space - length].append(bin_)
    room = list(room.values())
    found = Counter(tuple(b) for bins in room for b in bins)
    out = []
    for rows, uses in sorted(found.items()):
        pattern = np.zeros(len(lengths), np.int64)
        np.add.at(pattern, list(rows), 1)
        out.append((pattern, uses))
    return out


def plan(histogram: dict[int, int], capacity: int) -> Plan:
    """A plan for so many pieces of each length from 1 to the capacity."""
    lengths = np.array(sorted(k for k, n in histogram.items() if n > 0), np.int64)
    demand = np.array([histogram[int(k)] for k in lengths], np.int64)
    uses, pivots = _solve(lengths, demand, capacity) if len(lengths) else ([], 0)
    given, rows, sequence = np.zeros(len(lengths), np.int64), [], 0
    for pattern, n in uses:
        offset = 0
        for k in pattern.nonzero()[0]:
            rows.append((int(lengths[k]), int(given[k]), int(pattern[k]), sequence, offset))
            given[k] += n * pattern[k]
            offset += int(pattern[k] * lengths[k])
        sequence += n
    if (given != demand).any():
        raise AssertionError("the plan misses pieces")
    table = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return Plan(*table, sequence, pivots)

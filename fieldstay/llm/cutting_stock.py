"""The cutting-stock problem over a length histogram, by column generation. Runs on the driver: its input has at
most ``capacity`` distinct lengths whatever the number of pieces."""

from __future__ import annotations

import numpy as np


def best_pattern(values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable pattern; ``values[l - 1]`` is the price of a piece of length l."""
    best = np.zeros(capacity + 1)
    took = np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        gain = values[:c] + best[c - 1 :: -1][:c] if c > 1 else values[:1] + best[0]
        k = int(np.argmax(gain))
        if gain[k] > best[c - 1] + 1e-12:
            best[c], took[c] = gain[k], k + 1
        else:
            best[c] = best[c - 1]
    pattern, c = np.zeros(capacity, np.int64), capacity
    while c > 0:
        if took[c]:
            pattern[took[c] - 1] += 1
            c -= took[c]
        else:
            c -= 1
    return float(best[capacity]), pattern


def inverse_of(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan with row exchanges."""
    n = len(matrix)
    work = np.hstack([matrix.astype(float), np.eye(n)])
    for k in range(n):
        top = k + int(np.argmax(np.abs(work[k:, k])))
        work[[k, top]] = work[[top, k]]
        work[k] /= work[k, k]
        rest = work[:, k].copy()
        rest[k] = 0
        work -= np.outer(rest, work[k])
    return work[:, n:]


def column_generation(demand: np.ndarray, *, gap: float = 2e-4, rounds: int = 20_000) -> list[tuple[np.ndarray, float]]:
    """Solve the linear program: fewest bins that hold ``demand[l - 1]`` pieces of each length l.

    The basis starts with one pattern a length; the knapsack prices a new column with the duals until the bound of
    the duals (objective over best price) shows that at most the share ``gap`` could still be saved.
    """
    capacity = len(demand)
    lengths = np.flatnonzero(demand) + 1
    m = len(lengths)
    if not m:
        return []
    need = demand[lengths - 1].astype(float)
    columns = np.diag((capacity // lengths).astype(float))
    inverse = np.diag(1.0 / np.diag(columns))
    x = inverse @ need
    values = np.zeros(capacity)
    for step in range(rounds):
        duals = inverse.sum(axis=0)
        values[:] = -1.0
        values[lengths - 1] = duals
        best, pattern = best_pattern(values, capacity)
        total = x.sum()
        if best <= 1 + 1e-7 or total - total / best <= gap * total:
            break
        entering = pattern[lengths - 1].astype(float)
        direction = inverse @ entering
        up = direction > 1e-9
        if not up.any():
            break
        ratio = np.full(m, np.inf)
        ratio[up] = np.maximum(x[up], 0) / direction[up]
        out = int(np.argmin(ratio))
        columns[:, out] = entering
        if step % 200 == 199:
            inverse = inverse_of(columns)
            x = inverse @ need
        else:
            row = inverse[out] / direction[out]
            inverse -= np.outer(direction, row)
            inverse[out] = row
            x = x - ratio[out] * direction
            x[out] = ratio[out]
    patterns = []
    for j in range(m):
        if x[j] > 1e-9:
            whole = np.zeros(capacity, np.int64)
            whole[lengths - 1] = np.rint(columns[:, j]).astype(np.int64)
            patterns.append((whole, float(x[j])))
    return patterns


def rounded(demand: np.ndarray, patterns: list[tuple[np.ndarray, float]]) -> list[tuple[np.ndarray, int]]:
    """Whole numbers of bins that hold exactly ``demand``: patterns are rounded down, what is left is packed by
    first fit, longest first."""
    left = demand.astype(np.int64).copy()
    out: list[tuple[np.ndarray, int]] = []
    for pattern, amount in sorted(patterns, key=lambda p: -p[1]):
        used = pattern > 0
        bins = min(int(amount + 1e-6), int((left[used] // pattern[used]).min()))
        if bins > 0:
            out.append((pattern, bins))
            left -= bins * pattern
    capacity = len(demand)
    room: list[int] = []
    open_bins: list[np.ndarray] = []
    for length in range(capacity, 0, -1):
        for _ in range(int(left[length - 1])):
            k = next((i for i, r in enumerate(room) if r >= length), None)
            if k is None:
                room.append(capacity)
                open_bins.append(np.zeros(capacity, np.int64))
                k = len(room) - 1
            room[k] -= length
            open_bins[k][length - 1] += 1
    return out + [(pattern, 1) for pattern in open_bins]

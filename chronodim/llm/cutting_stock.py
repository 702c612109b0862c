"""Cutting stock by column generation, over a histogram of lengths.

The linear program has one row per length class (how many pieces of it must be placed) and
one column per pattern (how many pieces of each class fill one sequence).  Columns are priced
by a knapsack dynamic program over the duals; the best column enters the basis until no
pattern improves the program by more than ``gap``.  Patterns are used a whole number of
times (rounded down); the pieces left over, less than one use of each pattern, are the
caller's to place.

The size of all this depends on the number of classes and the capacity only, not on how many
documents there are.
"""

from __future__ import annotations

import numpy as np


def best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable pattern and its value."""
    best = np.zeros(capacity + 1)
    choice = np.zeros(capacity + 1, dtype=np.int64)
    value_of = np.full(capacity + 1, -np.inf)            # by size: its most valuable class
    class_of = np.zeros(capacity + 1, dtype=np.int64)
    order = np.argsort(values, kind="stable")
    value_of[sizes[order]], class_of[sizes[order]] = values[order], order
    for c in range(1, capacity + 1):
        total = value_of[1:c + 1] + best[c - 1::-1]      # last piece of length 1 .. c
        at = int(total.argmax())
        if total[at] > best[c - 1]:
            best[c], choice[c] = total[at], at + 1
        else:
            best[c] = best[c - 1]                        # one unit stays empty
    pattern = np.zeros(len(sizes), dtype=np.int64)
    c = capacity
    while c > 0:
        if choice[c]:
            pattern[class_of[choice[c]]] += 1
            c -= choice[c]
        else:
            c -= 1
    return float(best[capacity]), pattern


def relaxed(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float, max_columns: int) -> tuple[np.ndarray, np.ndarray]:
    """Basic patterns (one per row) and how often the linear program uses each.  Rounding
    errors can only cost some sequences: uses are checked against the demand afterwards."""
    m = len(sizes)
    patterns = np.diag(capacity // sizes).astype(float)  # one class alone
    inverse = np.diag(1.0 / np.diag(patterns))
    x = demand / np.diag(patterns)
    for _ in range(max_columns):
        duals = inverse.sum(axis=0)                      # every column costs one sequence
        value, new = best_pattern(sizes, duals, capacity)
        if value <= 1 + 1e-9 or 1 - 1 / value < gap:     # lower bound: the objective over ``value``
            break
        direction = (inverse * new).sum(axis=1)
        up = direction > 1e-9
        if not up.any():
            break
        ratio = np.where(up, x / np.where(up, direction, 1.0), np.inf)
        out = int(ratio.argmin())
        patterns[out] = new
        pivot = inverse[out] / direction[out]
        inverse -= np.outer(direction, pivot)
        inverse[out] = pivot
        x = np.maximum(x - ratio[out] * direction, 0.0)
        x[out] = ratio[out] if np.isfinite(ratio[out]) else 0.0
    return patterns.astype(np.int64), x


def cutting_plan(items: list[tuple[int, int]], capacity: int, gap: float = 1e-3,
                 max_columns: int = 4000) -> list[tuple[dict[int, int], int]]:
    """``items``: (size, demand) of each class.  Patterns {class: pieces} and how often to use
    each; no class is used beyond its demand, a few pieces of each pattern stay over."""
    items = [(i, size, n) for i, (size, n) in enumerate(items) if n > 0]
    if not items:
        return []
    names, sizes, demand = (np.array(x, dtype=np.int64) for x in zip(*items))
    patterns, x = relaxed(sizes, demand.astype(float), capacity, gap, max_columns)
    used, left = [], demand.copy()
    for p, times in zip(patterns, np.floor(x + 1e-6).astype(np.int64)):
        hit = p > 0
        times = min(int(times), int((left[hit] // p[hit]).min()))
        if times > 0:
            left -= times * p
            used.append(({int(names[i]): int(p[i]) for i in np.nonzero(hit)[0]}, times))
    return used

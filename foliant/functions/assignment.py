"""Minimum-cost assignment."""

from __future__ import annotations

import numpy as np


def assign(cost: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (row, column) of least total cost, min(rows, columns) of them, by row. Shortest augmenting paths with potentials."""
    cost = np.asarray(cost, dtype=float)
    if cost.size == 0:
        return []
    if cost.shape[0] > cost.shape[1]:
        return sorted((r, c) for c, r in assign(cost.T))
    n, m = cost.shape
    row_price, col_price, owner = np.zeros(n), np.zeros(m), np.full(m, -1)
    for new in range(n):
        reach, back, done = np.full(m, np.inf), np.full(m, -1), np.zeros(m, dtype=bool)
        row, col, base = new, -1, 0.0
        while True:
            slack = base + cost[row] - row_price[row] - col_price
            better = ~done & (slack < reach)
            reach[better], back[better] = slack[better], col
            col = int(np.argmin(np.where(done, np.inf, reach)))
            base = reach[col]
            done[col] = True
            if owner[col] < 0:
                break
            row = owner[col]
        row_price[new] += base
        for j in np.flatnonzero(done):
            if owner[j] >= 0:
                row_price[owner[j]] += base - reach[j]
            col_price[j] -= base - reach[j]
        while back[col] >= 0:
            owner[col] = owner[back[col]]
            col = back[col]
        owner[col] = new
    return sorted((int(owner[j]), j) for j in range(m) if owner[j] >= 0)

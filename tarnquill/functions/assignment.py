"""Optimal assignment on the driver or inside a task, for small cost matrices."""

from __future__ import annotations


def least_cost(cost: list[list[float]]) -> list[int]:
    """For each row its own column so that the total cost is least; there are at least as many columns as rows.

    Shortest augmenting paths with potentials (Hungarian method), cubic time.
    """
    n, m = len(cost), len(cost[0]) if cost else 0
    if n > m:
        raise ValueError("more rows than columns")
    u, v, owner, way = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        owner[0], at = i, 0
        least, used = [float("inf")] * (m + 1), [False] * (m + 1)
        while True:
            used[at] = True
            row, delta, following = owner[at], float("inf"), 0
            for j in range(1, m + 1):
                if not used[j]:
                    reduced = cost[row - 1][j - 1] - u[row] - v[j]
                    if reduced < least[j]:
                        least[j], way[j] = reduced, at
                    if least[j] < delta:
                        delta, following = least[j], j
            for j in range(m + 1):
                if used[j]:
                    u[owner[j]] += delta
                    v[j] -= delta
                else:
                    least[j] -= delta
            at = following
            if not owner[at]:
                break
        while at:
            owner[at], at = owner[way[at]], way[at]
    columns = [0] * n
    for j in range(1, m + 1):
        if owner[j]:
            columns[owner[j] - 1] = j - 1
    return columns

"""Distances and nearest-mean assignment for the integer k-means.

The distance of the original jobs is the *squared* distance: the integer
difference is taken first and then multiplied as a double.  Means are bigints
so differences cannot overflow.

Vectors stand on lines: x takes one value per keyword.  On a line the squared
distance to a mean is ``y * y`` plus a linear function of y, so the nearest
mean follows the lower envelope of k straight lines: a step function with at
most k steps, found in exact integers.  Where the lines are known, a point's
mean is looked up in the steps of its line by binary search, unrolled into
nested conditions; else the distances to all means are compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ident(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def steps(x: int, means: Sequence[tuple[int, int]]) -> list[tuple[int | None, int]]:
    """The nearest mean on the line at ``x``: ``(first integer y, mean index)``, ascending from ``None`` (no end).

    The lower envelope of ``-2 * my * y + my * my + (x - mx) ** 2`` over all
    means; at equal distance the lowest index is nearest.  Along y a mean with
    a larger ``my`` beats one with a smaller from some score on, so one sweep
    over the means by ``my`` keeps a stack of those that are nearest anywhere.
    """
    if not means:
        raise ValueError("at least one mean is required")
    best: dict[int, tuple[int, int]] = {}                   # of equal slopes the nearest
    for i, (mx, my) in enumerate(means):
        shift = int(my) * int(my) + (int(x) - int(mx)) ** 2
        best[int(my)] = min(best.get(int(my), (shift, i)), (shift, i))
    stack: list[tuple[int | None, int, int, int]] = []      # from, index, slope, shift
    for my in sorted(best):
        shift, i = best[my]
        start = None
        while stack:
            since, j, slope, other = stack[-1]
            twice = 2 * (my - slope)                         # i beats j where twice * y > shift - other, or at a tie if i < j
            start = -((other - shift) // twice) if i < j else (shift - other) // twice + 1
            if since is not None and start <= since:
                stack.pop()
                continue
            break
        stack.append((start if stack else None, i, my, shift))
    return [(since, i) for since, i, _, _ in stack]


def _search_sql(y: str, found: list[tuple[int | None, int]]) -> str:
    """Nested conditions that find y's step by binary search."""
    if len(found) == 1:
        return str(found[0][1])
    middle = len(found) // 2
    return f"if({y} < {found[middle][0]}L, {_search_sql(y, found[:middle])}, {_search_sql(y, found[middle:])})"


def nearest_on_lines_sql(x: str, y: str, means: Sequence[tuple[int, int]], lines: Sequence[int]) -> str:
    """SQL for the index of the nearest mean of points whose x is one of ``lines``; another x raises."""
    branches = "".join(f" WHEN {int(line)}L THEN {_search_sql(f'CAST({_ident(y)} AS BIGINT)', steps(line, means))}" for line in lines)
    other = f"CAST(raise_error(concat('no line at x = ', CAST({_ident(x)} AS STRING))) AS INT)"
    return f"coalesce(CASE CAST({_ident(x)} AS BIGINT){branches} ELSE {other} END, 0)"


def nearest_sql(x: str, y: str, means: Sequence[tuple[int, int]], lines: Sequence[int] | None = None) -> str:
    """SQL for the index of the nearest mean; ties go to the lowest index.

    With ``lines`` the steps of the point's line are searched.  Without, for
    any x, it is the least ``(distance, index)`` over the constant array of
    means.  The index is non-nullable, so a join on it infers no filter that
    would be pushed below the projection.
    """
    if not means:
        raise ValueError("at least one mean is required")
    if lines:
        return nearest_on_lines_sql(x, y, means, lines)
    xs = ", ".join(f"{int(a)}L" for a, _ in means)
    ys = ", ".join(f"{int(b)}L" for _, b in means)
    dx = f"CAST(CAST({_ident(x)} AS BIGINT) - mx AS DOUBLE)"
    dy = f"CAST(CAST({_ident(y)} AS BIGINT) - my AS DOUBLE)"
    far = f"zip_with(array({xs}), array({ys}), (mx, my) -> {dx} * {dx} + {dy} * {dy})"
    return f"coalesce(array_min(transform({far}, (d, i) -> named_struct('d', d, 'i', i))).i, 0)"


def nearest_index(x: str, y: str, means: Sequence[tuple[int, int]], lines: Sequence[int] | None = None) -> Column:
    """:func:`nearest_sql` as a column."""
    return F.expr(nearest_sql(x, y, means, lines))


def assign_nearest(df: DataFrame, means: Sequence[tuple[int, int]], column: str = "cluster",
                   x: str = "x", y: str = "y", lines: Sequence[int] | None = None) -> DataFrame:
    """Add the index of the nearest mean (lowest index on ties) as ``column``."""
    return df.withColumn(column, nearest_index(x, y, means, lines))


def point_distance(a: tuple[int, int], b: tuple[int, int]) -> float:
    """Squared distance of two points, on the driver (k rows at most)."""
    dx = float(a[0] - b[0])
    dy = float(a[1] - b[1])
    return dx * dx + dy * dy


def means_moves(a: Sequence[tuple[int, int]], b: Sequence[tuple[int, int]]) -> tuple[list[float], float]:
    """Squared move of every mean, and their sum in index order."""
    if len(a) != len(b):
        raise ValueError(f"mean lists differ in length: {len(a)} != {len(b)}")
    moves = [point_distance(p, q) for p, q in zip(a, b)]
    total = 0.0
    for m in moves:
        total += m
    return moves, total

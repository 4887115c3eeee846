"""Averages of doubles that do not depend on the order of their partial sums.

A double is cut into a whole part and three pieces of 26 bits behind the
point.  All are summed as 64-bit integers, exactly, in whatever order tasks and
shuffles bring them, and put together once per group.  The aggregate buffers
are primitive, so it stays a hash aggregate with partial sums.

The pieces hold every bit of a value from 2^-25 on; of a smaller one, what
lies behind 2^-78 is rounded.  Sums cannot overflow below 2^36 rows a group.  A
group with a value that is not finite or at least 2^26 in size gets the plain
average.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PIECE = 1 << 26
PIECES = 3


def exact_avg_sql(column: str) -> str:
    """SQL for the average of a double column (given as SQL), equal for every order and partitioning."""
    inside, rest, parts = f"abs({column}) < {PIECE}D", f"({column})", [f"floor({column})"]
    for k in range(PIECES):
        rest = f"(({rest} - floor({rest})) * {PIECE}D)"
        parts.append(f"floor({rest})" if k < PIECES - 1 else f"floor({rest} + 0.5D)")
    total = ""
    for part in reversed(parts):
        summed = f"CAST(coalesce(sum(CASE WHEN {inside} THEN {part} END), 0) AS DOUBLE)"
        total = f"({summed} + {total} / {PIECE}D)" if total else summed
    return f"CASE WHEN count({column}) = count_if({inside}) THEN try_divide({total}, count({column})) ELSE avg({column}) END"


def exact_avg(column: str) -> Column:
    """:func:`exact_avg_sql` of a named column."""
    return F.expr(exact_avg_sql("`" + column.replace("`", "``") + "`"))

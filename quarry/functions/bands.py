"""Demographic bands and row-wise sums of the time diary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.fixed import (
    ACTIVE_AGE_MAX,
    ACTIVE_AGE_MIN,
    ACTIVE_LABEL,
    ELDER_LABEL,
    FEMALE_LABEL,
    MALE_LABEL,
    NOT_WORKING_LABEL,
    WORKING_LABEL,
    YOUNG_LABEL,
    MALE_TESEX,
    MINUTES_PER_HOUR,
    WORKING_TELFS_BELOW,
    WORKING_TELFS_MIN,
    YOUNG_AGE_MAX,
    YOUNG_AGE_MIN,
)


def working_band(telfs: Column | str = "telfs") -> Column:
    c = F.col(telfs) if isinstance(telfs, str) else telfs
    return F.when((c >= WORKING_TELFS_MIN) & (c < WORKING_TELFS_BELOW), WORKING_LABEL).otherwise(NOT_WORKING_LABEL)


def sex_band(tesex: Column | str = "tesex") -> Column:
    c = F.col(tesex) if isinstance(tesex, str) else tesex
    return F.when(c == MALE_TESEX, MALE_LABEL).otherwise(FEMALE_LABEL)


def age_band(teage: Column | str = "teage") -> Column:
    """Ages are doubles: 22.5 and anything under 15 fall into "elder"."""
    c = F.col(teage) if isinstance(teage, str) else teage
    return (
        F.when((c >= YOUNG_AGE_MIN) & (c <= YOUNG_AGE_MAX), YOUNG_LABEL)
        .when((c >= ACTIVE_AGE_MIN) & (c <= ACTIVE_AGE_MAX), ACTIVE_LABEL)
        .otherwise(ELDER_LABEL)
    )


def row_sum_hours(columns: Sequence[str], group: str) -> Column:
    """Left-to-right sum of minute columns, converted to hours."""
    if not columns:
        raise ValueError(f"no column is classified as {group!r}; cannot sum an empty group")
    # One SQL expression (a + b + c ...) / 60: a single JVM call for hundreds of columns.
    total = " + ".join("`" + c.replace("`", "``") + "`" for c in columns)
    return F.expr(f"({total}) / {MINUTES_PER_HOUR}")

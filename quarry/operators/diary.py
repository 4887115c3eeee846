"""Time-diary summaries: column classes, per-person hours, grouped averages.

Column classification is metadata work on the header names (driver side, no
job); everything else is one projection + filter and one aggregation, which
Spark partially aggregates per task (12 groups at most), so the shuffle stays
tiny however many respondents there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.fixed import (
    EMPLOYABLE_TELFS_MAX,
    GROUPED_SCALE,
    MINUTES_PER_HOUR,
    OTHER_PREFIXES,
    PRIMARY_NEEDS_PREFIXES,
    SUMMARY_COLUMNS,
    WORK_PREFIXES,
)
from quarry.functions.bands import age_band, row_sum_hours, sex_band, working_band
from quarry.functions.exact import exact_avg, exact_avg_sql

GROUP_KEYS = SUMMARY_COLUMNS[:3]
MEASURES = SUMMARY_COLUMNS[3:]

SUMMARY_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in GROUP_KEYS]
    + [T.StructField(c, T.DoubleType(), True) for c in MEASURES]
)

COLUMN_HOURS_SCHEMA = "name string, class string, position int, hours double"


def column_class(name: str) -> str | None:
    """``primary``, ``work``, ``other`` or None, checked in that priority order."""
    if any(name.startswith(p) for p in PRIMARY_NEEDS_PREFIXES):
        return "primary"
    if any(name.startswith(p) for p in WORK_PREFIXES):
        return "work"
    if any(name.startswith(p) for p in OTHER_PREFIXES):
        return "other"
    return None


def classify_columns(names: list[str]) -> tuple[list[str], list[str], list[str]]:
    """Split column names into (primary needs, work, other), input order kept."""
    groups: dict[str, list[str]] = {"primary": [], "work": [], "other": []}
    for n in names:
        c = column_class(n)
        if c is not None:
            groups[c].append(n)
    return groups["primary"], groups["work"], groups["other"]


def column_hours(names: list[str], df: DataFrame) -> DataFrame:
    """One row per classified column: ``(name, class, position, hours)``, hours summed over the diary.

    All sums are made in one pass with one row per task; the wide row of sums
    is then turned into rows.
    """
    classed = [(n, column_class(n), i) for i, n in enumerate(names) if column_class(n)]
    if not classed:
        return df.sparkSession.createDataFrame([], COLUMN_HOURS_SCHEMA)
    total = df.agg(*[F.sum(F.col(f"`{n}`")).alias(f"s{i}") for n, _, i in classed])
    rows = F.array(*[
        F.struct(F.lit(n).alias("name"), F.lit(c).alias("class"), F.lit(i).alias("position"),
                 (F.coalesce(F.col(f"s{i}"), F.lit(0.0)) / MINUTES_PER_HOUR).alias("hours"))
        for n, c, i in classed
    ])
    return total.select(F.inline(rows))


def summary(primary: list[str], work: list[str], other: list[str], df: DataFrame) -> DataFrame:
    """Per-person bands and hours for the employable (``telfs <= 4``).

    Columns ``working, sex, age, primaryNeeds, work, other``.  The filter is
    applied before the projection, so it reaches the scan when the source
    supports push-down.
    """
    bands = [working_band("telfs"), sex_band("tesex"), age_band("teage")]
    hours = [row_sum_hours(primary, "primary needs"), row_sum_hours(work, "work"), row_sum_hours(other, "other")]
    return df.where(F.col("telfs") <= EMPLOYABLE_TELFS_MAX).select(
        *[c.alias(name) for c, name in zip(bands + hours, SUMMARY_COLUMNS)]
    )


def summary_from(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Classify ``names`` (default: the frame's columns) and summarise ``df``."""
    p, w, o = classify_columns(names if names is not None else df.columns)
    return summary(p, w, o, df)


def summary_typed(df: DataFrame) -> DataFrame:
    """Conform a summary to the typed row layout by *name*.

    ``DataFrame.to`` reorders by name, casts, and fails on a missing column
    or an impossible cast.
    """
    return df.to(SUMMARY_SCHEMA)


def summary_typed_by_position(df: DataFrame) -> DataFrame:
    """Conform the first six columns to the typed row layout by *position*."""
    if len(df.columns) < len(SUMMARY_SCHEMA.fields):
        raise ValueError(f"expected at least {len(SUMMARY_SCHEMA.fields)} columns, got {df.columns}")
    first = df.select(*df.columns[: len(SUMMARY_SCHEMA.fields)])
    return first.toDF(*SUMMARY_SCHEMA.fieldNames()).to(SUMMARY_SCHEMA)


def grouped(summed: DataFrame) -> DataFrame:
    """Average hours per (working, sex, age), rounded to 1 decimal, sorted.

    Sums are exact (see ``quarry.functions.exact``), so a tie in rounding
    falls the same way however the rows are partitioned.
    Columns keep their plain names (``primaryNeeds``, ``work``, ``other``).
    """
    aggs = [F.round(exact_avg(m), GROUPED_SCALE).alias(m) for m in MEASURES]
    # At most 2 x 2 x 3 groups: move them to one partition and sort there.
    return summed.groupBy(*GROUP_KEYS).agg(*aggs).repartition(1).orderBy(*GROUP_KEYS)


def grouped_sql_query(view_name: str) -> str:
    """The SQL text of :func:`grouped` over a registered view.

    The ``REPARTITION(1)`` hint moves the (at most 12) groups to one partition
    before ORDER BY, as the DataFrame form does, instead of a sampled range
    shuffle.
    """
    keys = ", ".join(GROUP_KEYS)
    measures = ",\n  ".join(f"round({exact_avg_sql(m)}, {GROUPED_SCALE}) AS {m}" for m in MEASURES)
    return (f"SELECT /*+ REPARTITION(1) */ {keys},\n  {measures}\nFROM {view_name}\n"
            f"GROUP BY {keys}\nORDER BY {keys}")


def grouped_sql(summed: DataFrame, view_name: str = "summed") -> DataFrame:
    """Register ``summed`` as a temp view (replacing one of the same name) and
    run the grouped query in SQL (A13, K4)."""
    summed.createOrReplaceTempView(view_name)
    return summed.sparkSession.sql(grouped_sql_query(view_name))


def grouped_typed(typed: DataFrame) -> DataFrame:
    """Grouped averages over the typed layout.

    Spark's ``round`` is HALF_UP on the decimal form of the double, the rule
    the typed original applies by hand.
    """
    conformed = typed.to(SUMMARY_SCHEMA)
    aggs = [F.round(exact_avg(m), GROUPED_SCALE).alias(m) for m in MEASURES]
    out = conformed.groupBy(*GROUP_KEYS).agg(*aggs).repartition(1).orderBy(*GROUP_KEYS)
    return out.to(SUMMARY_SCHEMA)

"""Emit parsed records so that no later predicate or pruning gets around their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def emit_checked_sql(fields: DataFrame, record_sql: str, bad_sql: str, message_sql: str) -> DataFrame:
    """One record per row of ``fields``, or a job failure where ``bad_sql`` holds.

    ``record_sql`` is a ``named_struct``.  The check is part of the generator's
    input, not a filter above it: Spark may reorder filters and infer ``IS NOT
    NULL`` conditions that drop a malformed row before a check, but it cannot
    move a condition on a generator's output below the generator, nor leave
    the generator out.  The line is split once, whatever a query reads.
    """
    checked = f"CASE WHEN {bad_sql} THEN raise_error({message_sql}) ELSE {record_sql} END"
    return fields.selectExpr(f"inline(array({checked}))")

"""Posting lines: headerless, unquoted comma-separated records.

Fields: ``type,id,acceptedAnswer?,parentId?,score[,tag]``.  Fields 0, 1 and 4
are required integers; 2 and 3 are empty when absent; the tag exists only
when the line has a sixth field; extra fields are ignored.  Trailing empty
fields do not count (a line ending in ``,`` has no tag), while ``…,,x`` has
an empty-string tag.  A malformed integer fails the job.

Ids are read as ``bigint`` (the original used 32-bit ints): a deliberate
widening so keys beyond 2^31 at large scale parse instead of failing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quarry.fixed import POSTING_FIELD_SEPARATOR, POSTING_REQUIRED_FIELDS, POSTING_TAG_FIELD
from quarry.functions.strict import sql_ident, sql_string
from quarry.sources.rows import emit_checked_sql

POSTING_SCHEMA = T.StructType([
    T.StructField("postingType", T.IntegerType(), False),
    T.StructField("id", T.LongType(), False),
    T.StructField("acceptedAnswer", T.LongType(), True),
    T.StructField("parentId", T.LongType(), True),
    T.StructField("score", T.IntegerType(), False),
    T.StructField("tags", T.StringType(), True),
])


def parse_posting_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Posting lines -> typed postings (see the module docstring).

    Each line is split once (after dropping trailing separators).  The check
    and the record stand in one generator: a line with fewer than the required
    fields or any malformed number raises while its row is made.  A filter of
    a later query, on whatever column, only sees rows that were made, so it
    cannot drop a malformed line, and ``count()`` makes every row as well.
    """
    sep = sql_string(POSTING_FIELD_SEPARATOR)
    split = lines.selectExpr(
        f"split(trim(TRAILING {sep} FROM {sql_ident(column)}), {sep}) AS f", f"{sql_ident(column)} AS line"
    )

    def number(i: int, kind: str) -> str:
        return f"try_cast(get(f, {i}) AS {kind})"

    def optional(i: int) -> str:
        return f"CASE WHEN get(f, {i}) <> '' THEN {number(i, 'BIGINT')} END"

    def malformed(i: int) -> str:
        return f"(get(f, {i}) <> '' AND {number(i, 'BIGINT')} IS NULL)"

    record = (
        "named_struct("
        f"'postingType', {number(0, 'INT')}, 'id', {number(1, 'BIGINT')}, "
        f"'acceptedAnswer', {optional(2)}, 'parentId', {optional(3)}, 'score', {number(4, 'INT')}, "
        f"'tags', CASE WHEN size(f) > {POSTING_TAG_FIELD} THEN get(f, {POSTING_TAG_FIELD}) END)"
    )
    bad = (
        f"line IS NULL OR size(f) < {POSTING_REQUIRED_FIELDS} OR {number(0, 'INT')} IS NULL OR {number(1, 'BIGINT')} IS NULL "
        f"OR {number(4, 'INT')} IS NULL OR {malformed(2)} OR {malformed(3)}"
    )
    return emit_checked_sql(split, record, bad, "concat('malformed posting line: ', line)")


def read_postings(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Scan posting lines and parse them."""
    return parse_posting_lines(spark.read.text(path))

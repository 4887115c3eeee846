"""Text-line scan, tagged article lines and literal article rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quarry.fixed import TAGGED_PREFIX_CHARS, TAGGED_SUFFIX_CHARS, TITLE_TEXT_SEPARATOR
from quarry.functions.strict import sql_ident, sql_string
from quarry.sources.rows import emit_checked_sql

ARTICLE_SCHEMA = T.StructType([
    T.StructField("title", T.StringType(), True),
    T.StructField("text", T.StringType(), True),
])


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line (``value``); splittable and partitioned by the file source."""
    return spark.read.text(path)


def parse_tagged_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Tagged lines -> ``(title, text)``.

    Layout: a 14-character prefix, the title, ``</title><text>``, the text and a
    16-character suffix.  A line without the separator, or too short to hold
    the suffix after it, fails the job while its row is made, also under
    ``count()`` (the original parser throws).
    """
    sep, line = sql_string(TITLE_TEXT_SEPARATOR), sql_ident(column)
    places = lines.selectExpr(f"{line} AS line", f"instr({line}, {sep}) AS p", f"length({line}) AS n")
    start = f"p + {len(TITLE_TEXT_SEPARATOR)}"                  # 1-based start of the text
    title = f"substring(line, {TAGGED_PREFIX_CHARS + 1}, p - {TAGGED_PREFIX_CHARS + 1})"
    text = f"substring(line, {start}, n - {TAGGED_SUFFIX_CHARS} - ({start}) + 1)"
    bad = f"line IS NULL OR p <= {TAGGED_PREFIX_CHARS} OR n - {TAGGED_SUFFIX_CHARS} < {start} - 1"
    record = f"named_struct('title', {title}, 'text', {text})"
    return emit_checked_sql(places, record, bad, "concat('malformed tagged line: ', substring(line, 1, 80))")


def read_articles(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Scan a tagged-line file and parse every line into an article."""
    return parse_tagged_lines(read_lines(spark, path))


def articles_from_rows(spark: SparkSession, rows: Iterable[tuple[str, str]]) -> DataFrame:
    """Literal ``(title, text)`` rows, as used by unit tests."""
    return spark.createDataFrame(list(rows), ARTICLE_SCHEMA)

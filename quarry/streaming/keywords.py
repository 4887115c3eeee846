"""Keyword counts over a stream of article files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quarry.operators.keywords import COUNT_COLUMN, keyword_hits
from quarry.sources.text import ARTICLE_SCHEMA, parse_tagged_lines


def read_article_stream(spark: SparkSession, path: str, schema: StructType = ARTICLE_SCHEMA,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet article files arriving in ``path`` as a streaming DataFrame."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def read_tagged_line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Tagged-line text files arriving in ``path``, parsed into ``(title, text)``."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_tagged_lines(reader.text(path))


def keyword_counts(articles: DataFrame, keywords: Iterable[str]) -> DataFrame:
    """Running number of articles per keyword (the combined ranking, A5).

    Per micro-batch the counts are partially aggregated in every task and
    merged into the state store, which holds one row per keyword.
    """
    return keyword_hits(articles, keywords).groupBy("keyword").agg(F.count(F.lit(1)).alias(COUNT_COLUMN))


def start_keyword_counts(articles: DataFrame, keywords: Iterable[str], query_name: str,
                         checkpoint_location: str, sink: str = "memory") -> StreamingQuery:
    """Start the running counts in complete mode.

    State and progress live at ``checkpoint_location``, a folder on shared
    storage; a restarted query with the same location resumes there.
    """
    return (
        keyword_counts(articles, keywords)
        .writeStream.outputMode("complete")
        .format(sink)
        .queryName(query_name)
        .option("checkpointLocation", checkpoint_location)
        .start()
    )

"""Input shapes of the three jobs, derived from the driver's parquet tables.

Everything here is a lazy DataFrame over the given tables (except the diary
CSV and the posting-line text file, which are written once to shared storage
for the file-scan queries), so the work of every query grows with the tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.fixed import LANGUAGES, TITLE_TEXT_SEPARATOR
from quarry.operators.kmeans import ClusterParams
from quarry.session import scratch_path

# Fixture parameters (chosen for the driver tables, not reference values).
ARTICLE_KEYWORDS = ["the", "and", "of", "that", "in", "en", "la", "them", "zzz"]
SINGLE_KEYWORD = "the"
CONJUNCTION_KEYWORDS = ["the", "of", "in"]
INDEX_BLOCK_SIZE = 128
ANSWER_BLOCK_SIZE = 2
CLUSTER_KEYWORDS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
CLUSTER_SPREAD = 50000
SUMMARY_SPREAD = 5000
SIMPLE_SAMPLE_SPREAD = 100
CLUSTER_KERNELS = 12
FIXED_PASSES = 4
UNLISTED_TAGS = ["Fortran-77", "Ada"]      # tags of questions besides the keyword list

NEWLINE_MARK = "~"               # no blank, so it joins two lines' words as a newline does

TAG_OPEN = "<page><title> "      # 14 characters
TAG_CLOSE = "</text></page>  "    # 16 characters

# l_linenumber -> diary activity column; t500101 counts the lines.
DIARY_ACTIVITY_COLUMNS = [
    (1, "t010101"), (2, "t030101"), (3, "t050101"), (4, "t180101"),
    (5, "t180501"), (6, "t020101"), (7, "t189999"),
]
DIARY_COUNT_COLUMN = "t500101"


def cluster_params(**overrides) -> ClusterParams:
    base = dict(keywords=CLUSTER_KEYWORDS, spread=CLUSTER_SPREAD, kernels=CLUSTER_KERNELS)
    base.update(overrides)
    return ClusterParams(**base)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, title, text)`` with ``title = cast(doc_id as string)``."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.col("doc_id").cast("string").alias("title"), "text"
    )


def tagged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tagged line per document in column ``value``, newlines as they are."""
    docs = table(spark, sf_dir, "documents")
    line = F.concat(
        F.lit(TAG_OPEN), F.col("doc_id").cast("string"), F.lit(TITLE_TEXT_SEPARATOR), F.col("text"), F.lit(TAG_CLOSE)
    )
    return docs.select(line.alias("value"))


def write_tagged_lines(spark: SparkSession, sf_dir: str) -> str:
    """Write the tagged lines as a text file folder, newlines inside texts replaced
    by ``NEWLINE_MARK`` so that each article stays one line; returns the folder."""
    path = scratch_path(spark, "tagged-lines")
    tagged_lines(spark, sf_dir).select(F.translate("value", "\n\r", NEWLINE_MARK * 2)).write.text(path)
    return path


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions from ``orders``, answers from ``lineitem`` (POSTING_SCHEMA).

    Written as SQL text: one JVM call per projection instead of one per
    Column operation, which keeps the driver-side cost of building a query low.
    """
    q = table(spark, sf_dir, "orders").selectExpr(
        "1 AS postingType",
        "CAST(o_orderkey AS BIGINT) AS id",
        "CAST(NULL AS BIGINT) AS acceptedAnswer",
        "CAST(NULL AS BIGINT) AS parentId",
        "0 AS score",
        "o_orderpriority AS tags",
    )
    a = table(spark, sf_dir, "lineitem").selectExpr(
        "2 AS postingType",
        "CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS id",
        "CAST(NULL AS BIGINT) AS acceptedAnswer",
        "CAST(l_orderkey AS BIGINT) AS parentId",
        "CAST(floor(l_extendedprice) AS INT) - 30000 AS score",
        "CAST(NULL AS STRING) AS tags",
    )
    return q.unionByName(a)


def keyword_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`postings` whose questions are tagged with the clustering program's own keywords (and two others)."""
    tags = ", ".join(f"'{t}'" for t in LANGUAGES + UNLISTED_TAGS)
    tag = f"get(array({tags}), CAST(id % {len(LANGUAGES) + len(UNLISTED_TAGS)} AS INT))"
    return postings(spark, sf_dir).withColumn("tags", F.expr(f"CASE WHEN postingType = 1 THEN {tag} END"))


def posting_lines(spark: SparkSession, sf_dir: str, source=postings) -> DataFrame:
    """Postings rendered as lines in column ``value`` (empty fields for NULLs,
    no sixth field when there is no tag)."""
    fields = ", ".join(
        f"coalesce(CAST({c} AS STRING), '')" for c in ("postingType", "id", "acceptedAnswer", "parentId", "score")
    )
    return source(spark, sf_dir).selectExpr(
        f"CASE WHEN tags IS NULL THEN concat_ws(',', {fields}) ELSE concat_ws(',', {fields}, tags) END AS value"
    )


def write_posting_lines(spark: SparkSession, sf_dir: str, source=postings) -> str:
    """Write the posting lines as a text file folder under the checkpoint
    folder (shared storage on a cluster); returns the folder."""
    path = scratch_path(spark, "posting-lines")
    posting_lines(spark, sf_dir, source).write.text(path)
    return path


def diary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One diary row per order: demographics from the order, activity minutes
    from the order's line quantities (0 when absent).

    Line quantities are reduced per order (partial sums in every task) before
    the join with the orders, so an order with very many lines costs one row
    per task in the shuffle.
    """
    sums = [
        f"sum(CASE WHEN l_linenumber = {n} THEN l_quantity ELSE 0.0 END) AS {name}"
        for n, name in DIARY_ACTIVITY_COLUMNS
    ]
    per_order = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(*[F.expr(e) for e in sums], F.count(F.lit(1)).alias("_lines"))
    )
    o = table(spark, sf_dir, "orders")
    joined = o.join(per_order, o["o_orderkey"] == per_order["l_orderkey"], "left")
    return joined.selectExpr(
        "CAST(o_orderkey AS STRING) AS tucaseid",
        "CAST(1 + o_orderkey % 5 AS DOUBLE) AS telfs",
        "CAST(1 + o_custkey % 2 AS DOUBLE) AS tesex",
        "CAST(10 + o_orderkey % 70 AS DOUBLE) AS teage",
        *[f"coalesce({name}, 0.0D) AS {name}" for _, name in DIARY_ACTIVITY_COLUMNS],
        f"CAST(coalesce(_lines, 0) AS DOUBLE) AS {DIARY_COUNT_COLUMN}",
    )


def write_diary_csv(spark: SparkSession, sf_dir: str) -> str:
    """Write the diary as CSV with a header into a fresh folder under the
    checkpoint folder (shared storage on a cluster); returns the folder."""
    path = scratch_path(spark, "diary-csv")
    diary(spark, sf_dir).write.option("header", True).csv(path)
    return path

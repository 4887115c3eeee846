"""A training-corpus pipeline of five operators: rules, line dedup, near-dedup, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table; ``run`` writes
it as Parquet into the shared checkpoint folder and hands what it reads back to
the next stage.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import lines, mixing, packing, quality, simhash
from quarry.llm.common import read_table, write_shared
from quarry.llm.queries import BYTE_FALLBACK, OTHER_WEIGHT, SOURCE_WEIGHTS, WORD_BPE


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fertility rules keep."""
    return quality.keep_good(docs, public_tokenizers.path(BYTE_FALLBACK))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stood earlier; their lengths follow the texts."""
    return lines.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_first(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights, in a global random order."""
    return mixing.mix(docs, SOURCE_WEIGHTS, OTHER_WEIGHT, copy_col=None, copies_col=None, order_col=None)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents by sequence."""
    return packing.packing_digest(packing.pack(docs, public_tokenizers.path(WORD_BPE)))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("source_mixing", source_mixing),
    ("packing", packed),
]

#: Tokenisation and the near-duplicate groups have no SQL form; each stage is tested against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's table, from ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_shared(stage(spark, docs, sf_dir), name)
    return docs

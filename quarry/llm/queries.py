"""Registered queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (
    alignment, capfilters, chat, hmm, lines, mixing, multiindex, packing, quality, secrets, simhash, suffixes, whitening,
)
from quarry.llm.common import read_table

WORD_BPE = "word_bpe_49k.json"
CONVERSATION_COLUMNS = "conv_id long, turn long, role string, text string"
BYTE_FALLBACK = "piece_bpe_32k.model"
BYTE_BPE = "byte_bpe_50k.json"

#: Target weights of the mix: the share of the bytes each source is to have, and of all others together.
SOURCE_WEIGHTS = {"src0": 0.05, "src1": 0.10, "src2": 0.10, "src3": 0.08}
OTHER_WEIGHT = 0.67


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"), SOURCE_WEIGHTS, OTHER_WEIGHT)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = suffixes.remove_repeats(read_table(spark, sf_dir, "documents"), with_text=False)
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(read_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(read_table(spark, sf_dir, "documents"), lines_col="n_lines", removed_col="n_removed")
    return kept.select("doc_id", "n_lines", "n_removed", "text")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return packing.packing_digest(pieces)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.measure(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_FALLBACK))
    return judged.select(F.col("doc_id").cast("long").alias("doc_id"), "quality.*")


def op8_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.search(read_table(spark, sf_dir, "embeddings"), F.expr("vec_id % 20 = 0"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets_digest(secrets.scan(read_table(spark, sf_dir, "documents")))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], CONVERSATION_COLUMNS)
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat.chat_digest(chat.format_chats(turns))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op12_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capfilters.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path(BYTE_BPE), public_tokenizers.path(BYTE_FALLBACK)
    return alignment.align(read_table(spark, sf_dir, "documents"), *paths)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_hmm_score": op3_hmm_score,
    "op4_line_dedup": op4_line_dedup,
    "op5_simhash": op5_simhash,
    "op6_packing": op6_packing,
    "op7_quality": op7_quality,
    "op8_multi_index": op8_multi_index,
    "op9_secrets": op9_secrets,
    "op10_chat_format": op10_chat_format,
    "op11_whitening": op11_whitening,
    "op12_cap_filters": op12_cap_filters,
    "op13_alignment": op13_alignment,
}

ORACLES: dict[str, str] = {
    "op1_mixing": mixing.mix_sql(SOURCE_WEIGHTS, OTHER_WEIGHT),
}

"""End-to-end pipelines of the three original programs.

Each returns DataFrames (bounded ones may be collected by the caller):

* :func:`keyword_rankings` - the three rankings of a tagged-line article file;
* :func:`cluster_postings` - postings file -> k-means means, trace and cluster summary;
* :func:`diary_forms` - diary CSV -> summary and its grouped forms.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quarry.fixed import LANGUAGES
from quarry.operators import clusters, diary, keywords, kmeans, qa
from quarry.operators.kmeans import ClusterParams, KMeansResult
from quarry.sources.diary import read_diary
from quarry.sources.postings import read_postings
from quarry.sources.text import read_articles


def keyword_rankings(articles: DataFrame, langs: Iterable[str] = LANGUAGES) -> dict[str, DataFrame]:
    """The scan ranking (zeros kept), the ranking from the index, and the combined one."""
    langs = list(langs)
    index = keywords.inverted_index(articles, langs, keep=())
    return {
        "scan": keywords.rank_by_scan(articles, langs),
        "index": keywords.rank_from_index(index),
        "combined": keywords.rank_combined(articles, langs),
    }


def keyword_rankings_from_file(spark: SparkSession, path: str, langs: Iterable[str] = LANGUAGES) -> dict[str, DataFrame]:
    return keyword_rankings(read_articles(spark, path), langs)


@dataclass
class ClusteringRun:
    result: KMeansResult
    summary: DataFrame
    report: DataFrame


def cluster_postings(postings: DataFrame, params: ClusterParams | None = None, state_folder: str | None = None) -> ClusteringRun:
    """Scores, vectors, sampled means, k-means and the cluster summary; ``state_folder`` as in ``kmeans.cluster``."""
    params = params or ClusterParams()
    vecs = qa.vectors(qa.high_scores(postings), params.keywords, params.spread)
    result, points = kmeans.cluster(vecs, params, state_folder=state_folder)
    summary = clusters.cluster_summary(points, result.means, params)
    return ClusteringRun(result, summary, clusters.cluster_report(summary))


def cluster_postings_file(
    spark: SparkSession, path: str, params: ClusterParams | None = None, state_folder: str | None = None
) -> ClusteringRun:
    return cluster_postings(read_postings(spark, path), params, state_folder)


def diary_forms(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Read the diary CSV, classify its columns and build every summary form."""
    names, df = read_diary(spark, path)
    primary, work, other = diary.classify_columns(names)
    summary = diary.summary(primary, work, other, df)
    return {
        "summary": summary,
        "grouped": diary.grouped(summary),
        "grouped_sql": diary.grouped_sql(summary),
        "grouped_typed": diary.grouped_typed(diary.summary_typed(summary)),
    }

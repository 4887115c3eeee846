"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads whole driver tables (through ``quarry.plans.fixtures``).
The names match the SQL oracles in ``quarry.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry import jobs
from quarry.operators import clusters, diary, keywords, kmeans, qa
from quarry.plans import fixtures as fx
from quarry.sources.diary import read_diary
from quarry.sources.postings import parse_posting_lines, read_postings
from quarry.sources.text import parse_tagged_lines

Query = Callable[[SparkSession, str], DataFrame]


# ----------------------------------------------------------------- keywords


def keyword_occurrences(spark, sf_dir):
    return keywords.keyword_occurrences(fx.articles(spark, sf_dir), fx.SINGLE_KEYWORD)


def keyword_rank_scan(spark, sf_dir):
    return keywords.rank_by_scan(fx.articles(spark, sf_dir), fx.ARTICLE_KEYWORDS)


def keyword_index(spark, sf_dir):
    return keywords.inverted_index(fx.articles(spark, sf_dir), fx.ARTICLE_KEYWORDS, keep=("title", "text"))


def keyword_index_grouped(spark, sf_dir):
    index = keywords.inverted_index(fx.articles(spark, sf_dir), fx.ARTICLE_KEYWORDS, keep=("doc_id", "title"))
    return keywords.index_blocks(index, "doc_id", fx.INDEX_BLOCK_SIZE)


def keyword_rank_index(spark, sf_dir):
    index = keywords.inverted_index(fx.articles(spark, sf_dir), fx.ARTICLE_KEYWORDS, keep=())
    return keywords.rank_from_index(index)


def keyword_rank_combined(spark, sf_dir):
    return keywords.rank_combined(fx.articles(spark, sf_dir), fx.ARTICLE_KEYWORDS)


def keyword_rank_bitmaps(spark, sf_dir):
    return keywords.rank_from_bitmaps(keywords.index_bitmaps(keywords.numbered_hits(fx.articles(spark, sf_dir), fx.ARTICLE_KEYWORDS)))


def keyword_pair_counts(spark, sf_dir):
    hits = keywords.numbered_hits(fx.articles(spark, sf_dir), fx.ARTICLE_KEYWORDS)
    return keywords.keyword_pairs(keywords.index_bitmaps(hits), fx.ARTICLE_KEYWORDS)


def keyword_conjunction(spark, sf_dir):
    hits = keywords.numbered_hits(fx.articles(spark, sf_dir), fx.ARTICLE_KEYWORDS)
    found = keywords.articles_with_all(hits, keywords.index_bitmaps(hits), fx.CONJUNCTION_KEYWORDS)
    return found.select("title")


def tagged_line_parse(spark, sf_dir):
    return parse_tagged_lines(fx.tagged_lines(spark, sf_dir))


# ----------------------------------------------------------------- postings


def parsed_postings(spark, sf_dir):
    return parse_posting_lines(fx.posting_lines(spark, sf_dir))


def postings_parse(spark, sf_dir):
    return parsed_postings(spark, sf_dir)


def postings_file_scan(spark, sf_dir):
    return read_postings(spark, fx.write_posting_lines(spark, sf_dir))


def question_answer_pairs(spark, sf_dir):
    return qa.question_answer_pairs(parsed_postings(spark, sf_dir))


def question_answer_spread(spark, sf_dir):
    return qa.spread_pairs(parsed_postings(spark, sf_dir))


def question_answer_blocks(spark, sf_dir):
    parsed = parsed_postings(spark, sf_dir)
    return qa.answer_blocks(qa.question_answer_pairs(parsed), fx.ANSWER_BLOCK_SIZE, qa.pair_counts(parsed))


def question_high_scores(spark, sf_dir):
    return qa.high_scores(parsed_postings(spark, sf_dir))


def _vectors(spark, sf_dir, spread):
    scored = qa.high_scores(parsed_postings(spark, sf_dir))
    return qa.vectors(scored, fx.CLUSTER_KEYWORDS, spread)


def tag_vectors(spark, sf_dir):
    return _vectors(spark, sf_dir, fx.CLUSTER_SPREAD)


# ----------------------------------------------------------------- clustering


def stratified_sample(spark, sf_dir):
    return kmeans.stratified_sample(kmeans.materialize(_vectors(spark, sf_dir, fx.CLUSTER_SPREAD)), fx.cluster_params())


def simple_sample(spark, sf_dir):
    params = fx.cluster_params(spread=fx.SIMPLE_SAMPLE_SPREAD)
    return kmeans.simple_sample(_vectors(spark, sf_dir, params.spread), params)


def nearest_assignment(spark, sf_dir):
    params = fx.cluster_params()
    vecs = kmeans.materialize(_vectors(spark, sf_dir, params.spread))
    means = kmeans.initial_means(vecs, params)
    return kmeans.assign_clusters(vecs, means, lines=params.lines)


def _run(spark, sf_dir, params):
    return kmeans.cluster(_vectors(spark, sf_dir, params.spread), params)


def kmeans_fixed(spark, sf_dir):
    params = fx.cluster_params(eta=0.0, max_iterations=fx.FIXED_PASSES)
    result, _ = _run(spark, sf_dir, params)
    return result.means_frame(spark)


def kmeans_converged(spark, sf_dir):
    result, _ = _run(spark, sf_dir, fx.cluster_params())
    return result.means_frame(spark)


def kmeans_trace(spark, sf_dir):
    result, _ = _run(spark, sf_dir, fx.cluster_params())
    return result.trace_frame(spark)


def _summary(spark, sf_dir):
    params = fx.cluster_params(spread=fx.SUMMARY_SPREAD, eta=0.0, max_iterations=fx.FIXED_PASSES)
    result, points = _run(spark, sf_dir, params)
    return clusters.cluster_summary(points, result.means, params)


def cluster_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


def cluster_report(spark, sf_dir):
    return clusters.cluster_report(_summary(spark, sf_dir))


# ----------------------------------------------------------------- diary


def diary_read(spark, sf_dir):
    _, df = read_diary(spark, fx.write_diary_csv(spark, sf_dir))
    return df


def diary_column_hours(spark, sf_dir):
    names, df = read_diary(spark, fx.write_diary_csv(spark, sf_dir))
    return diary.column_hours(names, df)


def diary_summary(spark, sf_dir):
    return diary.summary_from(fx.diary(spark, sf_dir))


def diary_summary_typed(spark, sf_dir):
    return diary.summary_typed_by_position(diary.summary_typed(diary_summary(spark, sf_dir)))


def diary_grouped(spark, sf_dir):
    return diary.grouped(diary_summary(spark, sf_dir))


def diary_grouped_sql(spark, sf_dir):
    return diary.grouped_sql(diary_summary(spark, sf_dir))


def diary_grouped_typed(spark, sf_dir):
    return diary.grouped_typed(diary.summary_typed(diary_summary(spark, sf_dir)))


# ----------------------------------------------------------------- programs, from files


def program_keywords(spark, sf_dir):
    return jobs.keyword_rankings_from_file(spark, fx.write_tagged_lines(spark, sf_dir), fx.ARTICLE_KEYWORDS)["combined"]


def program_clusters(spark, sf_dir):
    """From a file to the stop rule: default eta and pass limit."""
    params = fx.cluster_params(spread=fx.SUMMARY_SPREAD)
    return jobs.cluster_postings_file(spark, fx.write_posting_lines(spark, sf_dir), params).summary


def program_clusters_default(spark, sf_dir):
    """From a file, with all of the program's own parameters: 15 keywords, 45 kernels, eta 20, 120 passes."""
    return jobs.cluster_postings_file(spark, fx.write_posting_lines(spark, sf_dir, fx.keyword_postings)).summary


def program_diary(spark, sf_dir):
    return jobs.diary_forms(spark, fx.write_diary_csv(spark, sf_dir))["grouped"]


QUERIES: dict[str, Query] = {
    "keyword_occurrences": keyword_occurrences,
    "keyword_rank_scan": keyword_rank_scan,
    "keyword_index": keyword_index,
    "keyword_index_grouped": keyword_index_grouped,
    "keyword_rank_index": keyword_rank_index,
    "keyword_rank_combined": keyword_rank_combined,
    "keyword_rank_bitmaps": keyword_rank_bitmaps,
    "keyword_pair_counts": keyword_pair_counts,
    "keyword_conjunction": keyword_conjunction,
    "tagged_line_parse": tagged_line_parse,
    "postings_parse": postings_parse,
    "postings_file_scan": postings_file_scan,
    "question_answer_pairs": question_answer_pairs,
    "question_answer_spread": question_answer_spread,
    "question_answer_blocks": question_answer_blocks,
    "question_high_scores": question_high_scores,
    "tag_vectors": tag_vectors,
    "stratified_sample": stratified_sample,
    "simple_sample": simple_sample,
    "nearest_assignment": nearest_assignment,
    "kmeans_fixed": kmeans_fixed,
    "kmeans_converged": kmeans_converged,
    "kmeans_trace": kmeans_trace,
    "cluster_summary": cluster_summary,
    "cluster_report": cluster_report,
    "diary_read": diary_read,
    "diary_column_hours": diary_column_hours,
    "diary_summary": diary_summary,
    "diary_summary_typed": diary_summary_typed,
    "diary_grouped": diary_grouped,
    "diary_grouped_sql": diary_grouped_sql,
    "diary_grouped_typed": diary_grouped_typed,
    "program_keywords": program_keywords,
    "program_clusters": program_clusters,
    "program_clusters_default": program_clusters_default,
    "program_diary": program_diary,
}

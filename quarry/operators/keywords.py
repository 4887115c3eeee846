"""Keyword ranking over an article table ``(title, text, ...)``.

The keyword predicate is a whole blank-separated token match (see
``quarry.functions.text``); titles are never searched.  Keyword lists are
de-duplicated in order everywhere, so a keyword repeated in the list is
counted once.

Plan shape (all variants): one scan that reads only ``text`` (plus the
columns an index keeps), the text split once per row, and counts that are
partially aggregated in every task before the shuffle, so a shuffle carries at
most one row per keyword per task whatever the data size or skew.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import dedup, has_token, present_keywords
from quarry.session import scratch_path

COUNT_COLUMN = "n_articles"


def ranked(counts: DataFrame) -> DataFrame:
    """Order a ``(keyword, n_articles)`` table by count, descending.

    Ties are broken by keyword so the order is deterministic.  The table holds
    at most one row per keyword of a caller-given list: the final counts are
    computed in parallel, then those few rows move to one partition
    (``repartition(1)``, not ``coalesce(1)``, which would pull the final
    aggregation itself into one task) and are sorted there without a sampled
    range shuffle.
    """
    return counts.repartition(1).orderBy(F.col(COUNT_COLUMN).desc(), F.col("keyword").asc())


def ranking_list(ranking: DataFrame) -> list[tuple[str, int]]:
    """A ranking as a local ``[(keyword, count), ...]`` list, in rank order.

    Bounded by the keyword list, so collecting it is safe.
    """
    return [(r["keyword"], int(r[COUNT_COLUMN])) for r in ranking.collect()]


def keyword_occurrences(articles: DataFrame, keyword: str) -> DataFrame:
    """Number of articles whose text contains ``keyword`` as a token (A1).

    One row ``(keyword, n_articles)``; 0 when no article matches.
    """
    return articles.agg(F.count_if(has_token("text", keyword)).alias(COUNT_COLUMN)).select(
        F.lit(keyword).alias("keyword"), F.col(COUNT_COLUMN)
    )


def count_articles(articles: DataFrame, keyword: str) -> int:
    """Eager form of :func:`keyword_occurrences`: returns the count itself."""
    return int(keyword_occurrences(articles, keyword).first()[COUNT_COLUMN])


def keyword_hits(articles: DataFrame, keywords: Iterable[str], keep: Iterable[str] = ()) -> DataFrame:
    """One row per (keyword present, article).

    ``keep`` names the article columns carried along with ``keyword``.
    """
    keep = list(keep)
    return articles.select(
        F.explode(present_keywords("text", keywords)).alias("keyword"), *[F.col(c) for c in keep]
    )


def rank_by_scan(articles: DataFrame, keywords: Iterable[str]) -> DataFrame:
    """Ranking in which every listed keyword appears, zero counts included (A2).

    The original scans the articles once per keyword; here one scan computes
    all counts (``count_if`` per keyword over the per-row hit array) into a
    single row that is then unpivoted.
    """
    kws = dedup(keywords)
    if not kws:  # nothing to rank: an empty ranking with the usual columns
        return articles.limit(0).select(
            F.lit(None).cast("string").alias("keyword"), F.lit(0).cast("bigint").alias(COUNT_COLUMN)
        )
    hits = articles.select(present_keywords("text", kws).alias("hits"))
    counts = hits.agg(*[
        F.count_if(F.array_contains("hits", F.lit(k))).alias(f"c{i}") for i, k in enumerate(kws)
    ])
    pairs = F.array(*[
        F.struct(F.lit(k).alias("keyword"), F.col(f"c{i}").alias(COUNT_COLUMN)) for i, k in enumerate(kws)
    ])
    # The global aggregate already yields a single partition: sort it in place.
    return counts.select(F.inline(pairs)).orderBy(F.col(COUNT_COLUMN).desc(), F.col("keyword").asc())


def inverted_index(articles: DataFrame, keywords: Iterable[str], keep: Iterable[str] = ("title", "text")) -> DataFrame:
    """Keyword -> every article mentioning it, in long form (A3).

    Columns ``keyword`` plus the ``keep`` columns (the whole article by
    default, as the original index held articles).  Keywords no article
    mentions have no row.  The index is built without a shuffle; grouping it
    per keyword would put every article of a frequent keyword into one
    record, so grouped views are bounded blocks (:func:`index_blocks`).

    Keeping the text copies each article once per keyword it mentions; on a
    large corpus keep only an id (``keep=("doc_id",)``) and join back to the
    articles where the text is needed.
    """
    return keyword_hits(articles, keywords, keep)


def index_blocks(index: DataFrame, id_column: str, block_size: int = 1024, title_column: str = "title") -> DataFrame:
    """Grouped view of an inverted index in bounded posting blocks (A3).

    One row per ``(keyword, block)`` where ``block = id div block_size``: the
    number of articles and their titles joined by ``,`` in id order.  A row
    never holds more than ``block_size`` articles (ids are unique per
    article), however many articles a keyword has.
    """
    if block_size <= 0:
        raise ValueError("block_size must be positive")
    entries = F.array_sort(F.collect_list(F.struct(F.col(id_column).alias("id"), F.col(title_column).alias("t"))))
    ident = f"CAST(`{id_column}` AS BIGINT)"
    block = F.expr(f"({ident} - pmod({ident}, {int(block_size)})) div {int(block_size)}")  # exact floor
    return (
        index.groupBy(F.col("keyword"), block.alias("block"))
        .agg(F.count(F.lit(1)).alias(COUNT_COLUMN), entries.alias("entries"))
        .select(
            "keyword",
            "block",
            COUNT_COLUMN,
            F.array_join(F.transform("entries", lambda e: e.getField("t")), ",").alias("titles"),
        )
    )


def numbered_hits(articles: DataFrame, keywords: Iterable[str], keep: Iterable[str] = ("title",)) -> DataFrame:
    """Articles with a number, the ``keep`` columns and the keywords they mention, written once to shared storage.

    ``(number, ..., hits)``.  Numbers count up without gaps within each input
    partition, whatever the articles' ids are, so blocks of numbers are full
    but for the last one of a partition.  This table is the one scan of the
    texts, and maps numbers back to articles.
    """
    spark = articles.sparkSession
    rows = articles.select(
        (F.monotonically_increasing_id() + 1).alias("number"), *[F.col(c) for c in keep], present_keywords("text", keywords).alias("hits"))
    path = scratch_path(spark, "numbered-hits")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def index_bitmaps(hits: DataFrame) -> DataFrame:
    """The inverted index as bitmaps: ``(keyword, block, articles)``, at most 32,768 article numbers a block (A3).

    A block is 4 KiB whatever the ids look like, and is built by a partial
    aggregate: what crosses the shuffle is bitmaps, not postings.
    """
    numbered = hits.select(F.explode("hits").alias("keyword"), "number")
    return numbered.groupBy("keyword", F.bitmap_bucket_number("number").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("articles"))


def rank_from_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """Ranking by the bits set; keywords without articles are absent (A4)."""
    return ranked(bitmaps.groupBy("keyword").agg(F.sum(F.bitmap_count("articles")).alias(COUNT_COLUMN)))


def keyword_pairs(bitmaps: DataFrame, keywords: Iterable[str]) -> DataFrame:
    """``(keyword, other, n_articles)``: articles that mention both, for listed pairs with any, by conjunction of bitmaps.

    A block's bitmaps meet in the pairs of the caller's list: each is sent to
    the pairs its keyword is part of, and the two of a pair are ANDed.
    """
    kws = dedup(keywords)
    pairs = [(a, b) for i, a in enumerate(kws) for b in kws[i + 1:]]
    partners = [(k, a, b) for a, b in pairs for k in (a, b)]
    named = bitmaps.sparkSession.createDataFrame(partners, "keyword string, first string, other string")
    met = bitmaps.join(named, "keyword").groupBy("block", "first", "other").agg(
        F.count(F.lit(1)).alias("sides"), F.bitmap_and_agg("articles").alias("both"))
    counted = met.where("sides = 2").groupBy("first", "other").agg(F.sum(F.bitmap_count("both")).alias(COUNT_COLUMN))
    return counted.where(F.col(COUNT_COLUMN) > 0).select(F.col("first").alias("keyword"), "other", COUNT_COLUMN)


def articles_with_all(hits: DataFrame, bitmaps: DataFrame, keywords: Iterable[str]) -> DataFrame:
    """The rows of :func:`numbered_hits` whose article mentions every listed keyword, found by their bits."""
    kws = dedup(keywords)
    if not kws:
        return hits
    every = bitmaps.where(F.col("keyword").isin(kws)).groupBy("block").agg(
        F.count(F.lit(1)).alias("sides"), F.bitmap_and_agg("articles").alias("all_of")).where(F.col("sides") == len(kws))
    at = hits.withColumn("block", F.bitmap_bucket_number("number")).withColumn("bit", F.bitmap_bit_position("number"))
    byte = F.conv(F.hex(F.substring("all_of", F.expr("int(bit div 8) + 1"), F.lit(1))), 16, 10).cast("int")
    found = at.join(every, "block").where(F.getbit(byte, F.expr("int(bit % 8)")) == 1)
    return found.select(*hits.columns)


def rank_from_index(index: DataFrame) -> DataFrame:
    """Ranking by index group size; keywords without articles are absent (A4)."""
    return ranked(index.groupBy("keyword").agg(F.count(F.lit(1)).alias(COUNT_COLUMN)))


def rank_combined(articles: DataFrame, keywords: Iterable[str]) -> DataFrame:
    """Index and ranking in one pass with map-side combine (A5).

    Plan: scan(text) -> explode hits -> partial count -> exchange(keyword) ->
    final count -> sort.  Zero-count keywords are absent.
    """
    hits = keyword_hits(articles, keywords)
    return ranked(hits.groupBy("keyword").agg(F.count(F.lit(1)).alias(COUNT_COLUMN)))

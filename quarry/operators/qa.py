"""Questions, answers, best answer scores and keyword vectors.

Input is a postings table with ``POSTING_SCHEMA`` columns (type 1 question,
type 2 answer with ``parentId``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.fixed import ANSWER_TYPE, QUESTION_TYPE
from quarry.session import scratch_path


def questions(postings: DataFrame) -> DataFrame:
    """Postings of type 1."""
    return postings.where(F.col("postingType") == QUESTION_TYPE)


def answers(postings: DataFrame) -> DataFrame:
    """Postings of type 2 that name a parent."""
    return postings.where((F.col("postingType") == ANSWER_TYPE) & F.col("parentId").isNotNull())


def question_answer_pairs(postings: DataFrame) -> DataFrame:
    """Every (question, answer) pair with ``question.id = answer.parentId``.

    Inner join: unanswered questions and orphan answers drop, duplicate
    question ids multiply.  The pairs stay in long form keyed by
    ``question_id``; a per-question collection is never materialised, because
    one question may own an unbounded number of answers.  At scale this is a
    sort-merge join; a question with a huge answer list is a skewed partition
    that AQE splits (``spark.sql.adaptive.skewJoin.enabled``).
    """
    q = questions(postings).select(
        F.col("id").alias("question_id"),
        F.col("acceptedAnswer").alias("question_accepted_answer"),
        F.col("score").alias("question_score"),
        F.col("tags").alias("question_tags"),
    )
    a = answers(postings).select(
        F.col("parentId").alias("parent_id"),
        F.col("id").alias("answer_id"),
        F.col("score").alias("answer_score"),
    )
    joined = a.join(q, a["parent_id"] == q["question_id"], "inner")
    return joined.select(
        "question_id", "question_accepted_answer", "question_score", "question_tags", "answer_id", "answer_score"
    )


# A question owning more than this share of all answers is hot (one over it; at most as many can be).
HOT_SHARES = 1024


def hot_questions(answers: DataFrame, column: str = "key", shares: int = HOT_SHARES) -> list[tuple[int, int]]:
    """``(question id, parts)`` of the questions that own over ``1 / shares`` of the answers.

    One frequent-items sketch (merged from the tasks' own) over the parent ids.
    It tracks ``4 * shares`` ids, so its error is less than a share of the rows
    and no hot question is missed; at most ``shares`` rows reach the driver.
    A question gets a part for each share it owns, by the sketch's estimate.
    """
    found = answers.agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k(`{column}`, {int(shares)}, {4 * int(shares)})").alias("top"),
    ).first()
    share = found["n"] / shares
    return [(r["item"], -int(-r["count"] // share)) for r in found["top"] or () if r["count"] > share]


def spread_pairs(postings: DataFrame, shares: int = HOT_SHARES) -> DataFrame:
    """The rows of :func:`question_answer_pairs`, from one parse, with hot questions spread.

    The postings are written once, keyed by question, so that lines are parsed
    once however often the rows are read.  A sketch over the written parent ids
    finds the hot questions.  The answers of each are dealt to parts in turn by
    the number of their written row, copies of one answer too, and its question
    is copied to every part; other questions have the one part 0.  Both sides
    are then joined on question and part: a task receives about a share of a
    hot question, whatever AQE's thresholds are.  Only the hot ids, at most
    ``shares`` of them, are broadcast.
    """
    if shares < 1:
        raise ValueError("shares must be positive")
    spark = postings.sparkSession
    question = F.col("postingType") == QUESTION_TYPE
    wanted = question | ((F.col("postingType") == ANSWER_TYPE) & F.col("parentId").isNotNull())
    keyed = postings.where(wanted).select(
        question.alias("question"), F.when(question, F.col("id")).otherwise(F.col("parentId")).alias("key"),
        "id", "acceptedAnswer", "score", "tags", F.monotonically_increasing_id().alias("row"),
    )
    path = scratch_path(spark, "postings")
    keyed.write.parquet(path)
    written = spark.read.schema(keyed.schema).parquet(path)
    replies, asked = written.where("NOT question"), written.where("question")
    hot = F.broadcast(spark.createDataFrame(hot_questions(replies, "key", shares), "key long, parts int"))
    parts = F.coalesce("parts", F.lit(1))
    a = replies.join(hot, "key", "left").select(
        "key", F.pmod("row", parts).cast("int").alias("part"), F.col("id").alias("answer_id"), F.col("score").alias("answer_score"))
    q = asked.join(hot, "key", "left").select(
        "key", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.col("acceptedAnswer").alias("question_accepted_answer"),
        F.col("score").alias("question_score"), F.col("tags").alias("question_tags"))
    return a.join(q, ["key", "part"]).select(
        F.col("key").alias("question_id"), "question_accepted_answer", "question_score", "question_tags", "answer_id", "answer_score"
    )


def pair_counts(postings: DataFrame) -> DataFrame:
    """``(question_id, n)``: how many rows :func:`question_answer_pairs` has of each question, from two counts and no pairs.

    Copies of a question multiply its answers.  Both sides are reduced to a row for each question before they meet.
    """
    asked = questions(postings).groupBy(F.col("id").alias("question_id")).agg(F.count(F.lit(1)).alias("copies"))
    replies = answers(postings).groupBy(F.col("parentId").alias("question_id")).agg(F.count(F.lit(1)).alias("n"))
    return replies.join(asked, "question_id").select("question_id", (F.col("n") * F.col("copies")).alias("n"))


# Blocks that one part of a question's answers fills, on average.
BLOCKS_PER_PART = 8


def answer_blocks(pairs: DataFrame, block_size: int = 1024, counts: DataFrame | None = None) -> DataFrame:
    """The pairs per question in bounded blocks (A6): ``(question_id, part, block, n_answers, answers, best)``.

    The original gathers all pairs of a question in one collection.  Here a
    block holds at most ``block_size`` answers, their ids joined by ``,`` in
    order, and ``best`` is their highest score.  Blocks are numbered by two
    counts: the pairs of a question (partial in every task) set its number of
    parts, answers are dealt to parts by a hash of their id, and a row number
    within the part gives the block.  The dealt answers are shuffled by
    question and part, so no task sorts or holds a whole question, however
    many answers it owns.  Counts are a stage of their own and keep only
    questions of several parts; the join, the counts and the blocks thus never
    hold their sorted rows in one task together.  ``counts`` are those of
    :func:`pair_counts`; without them the pairs are counted.
    """
    if block_size <= 0:
        raise ValueError("block_size must be positive")
    if counts is None:
        counts = pairs.groupBy("question_id").agg(F.count(F.lit(1)).alias("n"))
    many = counts.select("question_id", F.ceil(F.col("n") / (block_size * BLOCKS_PER_PART)).alias("parts"))
    many = many.where("parts > 1").repartition(F.hash("question_id"))     # by the id alone Spark would leave the shuffle out
    hashed = F.conv(F.substring(F.md5(F.col("answer_id").cast("string")), 1, 8), 16, 10).cast("bigint")
    dealt = pairs.join(many, "question_id", "left").select(
        "question_id", F.pmod(hashed, F.coalesce("parts", F.lit(1))).alias("part"), "answer_id", "answer_score")
    dealt = dealt.repartition("question_id", "part")
    place = F.row_number().over(Window.partitionBy("question_id", "part").orderBy("answer_id", "answer_score"))
    blocks = dealt.withColumn("place", place).withColumn("block", F.expr(f"CAST((place - 1) div {int(block_size)} AS INT)"))
    return blocks.groupBy("question_id", "part", "block").agg(
        F.count(F.lit(1)).alias("n_answers"),
        F.array_join(F.sort_array(F.collect_list("answer_id")).cast("array<string>"), ",").alias("answers"),
        F.max("answer_score").alias("best"),
    )


def high_scores(postings: DataFrame) -> DataFrame:
    """Best answer score per answered question, floored at 0.

    ``(id, tags, score, high_score)``: one row per question id that has at
    least one answer.  The maximum starts from 0, so a question whose answers
    are all negative scores 0.  Duplicate question ids (the original keeps an
    arbitrary one) keep the least ``(tags, score)``.

    Answers, by far the larger side, are reduced by a hash aggregate with a
    primitive buffer (the maximum) in every task, so a question owning a third
    of all answers is one row per task in the shuffle and no answer is sorted.
    The fewer questions are reduced apart; only these carry tags, whose string
    buffer needs a sort-based aggregate.  Both sides leave their aggregates
    partitioned by question, so the join adds no shuffle.
    """
    best = (
        answers(postings).groupBy(F.col("parentId").alias("id")).agg(F.max("score").alias("best"))
        .where(F.col("best").isNotNull())
    )
    least = questions(postings).groupBy("id").agg(F.min(F.struct("tags", "score")).alias("q"))
    return least.join(best, "id").select(
        "id",
        F.col("q.tags").alias("tags"),
        F.col("q.score").alias("score"),
        F.greatest(F.col("best"), F.lit(0)).alias("high_score"),
    )


def keyword_index(tags: Column | str, keywords: Sequence[str]) -> Column:
    """0-based index of the first keyword equal to the whole tag; NULL if none."""
    if not keywords:
        return F.lit(None).cast("int")
    tag = F.col(tags) if isinstance(tags, str) else tags
    pos = F.array_position(F.array(*[F.lit(k) for k in keywords]), tag)
    return F.when(pos > 0, (pos - 1).cast("int"))


def keyword_of(x: Column | str, keywords: Sequence[str], spread: int) -> Column:
    """Keyword encoded in a vector's x: ``keywords[x div spread]``."""
    xc = F.col(x) if isinstance(x, str) else x
    kws = F.array(*[F.lit(k) for k in keywords])
    return F.element_at(kws, (F.floor(xc.cast("bigint") / F.lit(int(spread))).cast("int") + F.lit(1)))


def vectors(scored: DataFrame, keywords: Sequence[str], spread: int) -> DataFrame:
    """``(id, x, y)`` with ``x = keyword index * spread`` and ``y = high_score``.

    Questions whose tag is not a listed keyword are dropped.  The question id
    is kept so sampling can be deterministic.
    """
    if spread <= 0:
        raise ValueError("spread must be positive, or the keyword cannot be recovered from x")
    idx = keyword_index("tags", keywords)
    return (
        scored.select(F.col("id"), idx.alias("kw"), F.col("high_score"))
        .where(F.col("kw").isNotNull())
        .select(
            "id",
            (F.col("kw").cast("bigint") * F.lit(spread)).cast("int").alias("x"),
            F.col("high_score").cast("int").alias("y"),
        )
    )

"""Cluster summary and report over weighted points ``(x, y, w)`` and final means.

Per non-empty cluster:

* ``lang_label``: the keyword with the most vectors (ties: earliest keyword);
* ``lang_percent``: its share of the cluster in percent (true ratio);
* ``lang_percent_int``: the original job's value, ``(dominant div size) * 100.0``,
  which integer division makes 0.0 or 100.0;
* ``cluster_size``: number of vectors;
* ``median_score``: median of the scores, the mean of the two middle scores
  truncated toward zero when the size is even.

The points are assigned once and summed to ``(cluster, x, y, w)``, which is
kept as a table.  The median needs no list and no map of a cluster's scores:
scores are first counted by blocks of ``SCORE_BLOCK``, a running sum over the
few blocks of a cluster finds the blocks of the two middle scores, and only
these blocks are looked at score by score.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.fixed import REPORT_LINE_FORMAT
from quarry.operators.kmeans import ClusterParams, assign_clusters, materialize
from quarry.operators.qa import keyword_of

# Columns of the cluster summary, in output order.
CLUSTER_SUMMARY_COLUMNS = ["lang_label", "lang_percent", "lang_percent_int", "cluster_size", "median_score"]


# Scores counted together in the first step of the median.
SCORE_BLOCK = 1024


def _running(frame: DataFrame, by: list[str], order: str) -> DataFrame:
    """Weights before (``low``) and up to (``high``) each row of its group."""
    upto = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return frame.withColumn("high", F.sum("n").over(upto)).withColumn("low", F.col("high") - F.col("n"))


def weighted_medians(scores: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(cluster, median)`` of ``scores(cluster, y, w)``: the mean of the two middle scores."""
    block = F.floor(F.col("y") / SCORE_BLOCK).alias("block")
    middles = sizes.select("cluster", F.explode(F.array(
        F.expr("(cluster_size - 1) div 2"), F.expr("cluster_size div 2"))).alias("at"))
    blocks = _running(scores.groupBy("cluster", block).agg(F.sum("w").alias("n")), ["cluster"], "block")
    found = blocks.join(middles, "cluster").where("at >= low AND at < high").select("cluster", "block", "at", F.col("low").alias("before"))
    inside = scores.select("cluster", block, "y", "w").join(found.select("cluster", "block").distinct(), ["cluster", "block"])
    each = _running(inside.groupBy("cluster", "block", "y").agg(F.sum("w").alias("n")), ["cluster", "block"], "y")
    hits = each.join(found, ["cluster", "block"]).where("at - before >= low AND at - before < high")
    return hits.groupBy("cluster").agg(F.avg("y").alias("median"))


def cluster_summary(points: DataFrame, means: list[tuple[int, int]], params: ClusterParams) -> DataFrame:
    """Summary rows ordered by median score."""
    if "w" not in points.columns:
        points = points.withColumn("w", F.lit(1).cast("bigint"))
    near = assign_clusters(points.select("x", "y", "w"), means, lines=params.lines)
    assigned = materialize(near.groupBy("cluster", "x", "y").agg(F.sum("w").alias("w")), "assigned")

    per_keyword = assigned.groupBy("cluster", "x").agg(F.sum("w").alias("n"))
    dominance = per_keyword.groupBy("cluster").agg(
        F.max_by("x", F.struct(F.col("n"), -F.col("x"))).alias("dom_x"),
        F.max("n").alias("dom_n"),
        F.sum("n").alias("cluster_size"),
    )
    medians = weighted_medians(assigned, dominance.select("cluster", "cluster_size"))

    summary = dominance.join(medians, "cluster").select(
        keyword_of("dom_x", params.keywords, params.spread).alias("lang_label"),
        (F.col("dom_n").cast("double") * F.lit(100.0) / F.col("cluster_size").cast("double")).alias("lang_percent"),
        (F.expr("dom_n div cluster_size").cast("double") * F.lit(100.0)).alias("lang_percent_int"),
        F.col("cluster_size"),
        F.col("median").cast("int").alias("median_score"),
    )
    # At most k rows: move them to one partition and sort there (no sampled range shuffle).
    return summary.repartition(1).orderBy("median_score", "lang_label", "cluster_size")


def cluster_report(summary: DataFrame) -> DataFrame:
    """One formatted line per cluster: score, keyword, percent, size (K3), in the summary's order.

    The percent printed is the original job's integer-division value.
    """
    return summary.select(
        F.format_string(
            REPORT_LINE_FORMAT, "median_score", "lang_label", "lang_percent_int", "cluster_size"
        ).alias("line"),
        "median_score",
    )

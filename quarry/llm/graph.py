"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import write_shared


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the smallest node reachable.

    Each round hangs every node's larger neighbours under its smallest one
    (large star), then its smaller neighbours (small star).  A node's
    neighbours are never gathered: minima are aggregated, written, and joined
    back in a join whose skewed partitions Spark can split, so a hub's edges
    stay spread.  Every round is written to the shared folder,
    which ends its lineage; the driver only compares counts.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    current = write_shared(pairs, "edges")
    state = _state(current)
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = current.unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = write_shared(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        large = write_shared(large, "large")
        low = write_shared(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        joined = large.join(low, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(low.select("a", F.col("m").alias("b")))
        current = write_shared(small.where("a != b").distinct(), "edges")
        before, state = state, _state(current)
        if before == state:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = current.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)

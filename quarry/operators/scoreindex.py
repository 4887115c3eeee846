"""Sums over score ranges of keyword vectors, looked up instead of scanned.

Vectors ``(x, y)`` stand on lines: x takes one value per keyword.  On a line
each mean owns one range of scores (see ``quarry.functions.geometry.steps``),
so a k-means pass needs no more than the number of vectors, and the sum of
their scores, below the ends of those ranges.

Scores are counted once, in a tree: the points are sorted by line and score
and written with their weights; each level above adds up ``FAN`` neighbouring
keys of the one below.  The top level, at most ``FAN`` rows a line, is held by
the driver.  A lookup walks down: whole keys below the end come from running
sums of a node, the key that holds it is the next node.  Nodes are read from
the written levels when they are first needed (one job a level for all lookups
of a pass), have at most ``FAN`` rows, and no more than ``NODES_KEPT`` stay.
Passes move the ends less and less, so most passes read nothing.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import scratch_path

FAN_BITS = 11
FAN = 1 << FAN_BITS
NODES_KEPT = 1024
NODES_READ = 256          # nodes read by one job at most


@dataclass
class _Node:
    keys: np.ndarray          # ascending
    weights: np.ndarray       # running sums, one longer than keys
    scores: np.ndarray

    def below(self, key: int) -> tuple[int, int]:
        at = int(np.searchsorted(self.keys, key))
        return int(self.weights[at]), int(self.scores[at])


def _node(keys: np.ndarray, weights: np.ndarray, scores: np.ndarray) -> _Node:
    order = np.argsort(keys, kind="stable")
    return _Node(keys[order], np.concatenate([[0], weights[order].cumsum()]), np.concatenate([[0], scores[order].cumsum()]))


def _write(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class ScoreIndex:
    """Numbers of vectors and sums of scores by line and score range, from points ``(x, y, w)``.

    ``lines`` are the values of x that occur.  Points may repeat an ``(x, y)``.
    Their number is not bounded, that of their lines is (one per keyword).
    """

    def __init__(self, points: DataFrame):
        spark = points.sparkSession
        ends = points.agg(F.min("y").alias("low"), F.max("y").alias("high")).first()
        self.spark, self.low = spark, int(ends["low"] or 0)
        bits = max(1, (int(ends["high"] or 0) - self.low).bit_length())
        self.depth = -(-bits // FAN_BITS)
        self.top_key = (1 << (FAN_BITS * self.depth)) - 1
        at = (F.col("y").cast("bigint") - F.lit(self.low)).alias("at")
        each = points.select(F.col("x").cast("bigint").alias("x"), at, F.col("w").cast("bigint").alias("w"),
                             (F.col("y").cast("bigint") * F.col("w")).alias("s"))
        self.levels: list[DataFrame] = []
        for level in range(self.depth):
            key = F.col("at") if level == 0 else F.shiftright("at", FAN_BITS).alias("at")
            summed = (each if level == 0 else self.levels[-1]).groupBy("x", key).agg(F.sum("w").alias("w"), F.sum("s").alias("s"))
            self.levels.append(_write(summed.orderBy("x", "at"), f"scores-{level}"))
        self._nodes: OrderedDict[tuple[int, int, int], _Node] = OrderedDict()
        self._top: dict[int, _Node] = {}
        rows = self.levels[-1].toArrow()
        for x, part in self._split(rows, "x"):
            self._top[x] = part
        self.lines = sorted(self._top)

    @staticmethod
    def _split(table, column: str):
        """The rows of an Arrow table by ``column``, as nodes."""
        by = table[column].to_numpy()
        keys, weights, scores = (table[c].to_numpy() for c in ("at", "w", "s"))
        for value in np.unique(by).tolist():
            rows = by == value
            yield value, _node(keys[rows], weights[rows], scores[rows])

    def total(self, x: int) -> tuple[int, int]:
        """Number of vectors and sum of scores of a line."""
        node = self._top[x]
        return int(node.weights[-1]), int(node.scores[-1])

    def below(self, ends: Iterable[tuple[int, int]]) -> dict[tuple[int, int], tuple[int, int]]:
        """For each ``(x, y)`` the number of the line's vectors with a score below y, and the sum of their scores."""
        found: dict[tuple[int, int], tuple[int, int]] = {}
        deeper: dict[tuple[int, int], int] = {}
        for x, y in set(ends):
            key = y - self.low
            if x not in self._top or key <= 0:
                found[x, y] = (0, 0)
            elif key > self.top_key:
                found[x, y] = self.total(x)
            else:
                found[x, y] = self._top[x].below(key >> (FAN_BITS * (self.depth - 1)))
                deeper[x, y] = key
        for level in reversed(range(self.depth - 1)):
            by_node: dict[tuple[int, int], list[tuple[int, int]]] = {}
            for (x, y), key in deeper.items():
                by_node.setdefault((x, key >> (FAN_BITS * (level + 1))), []).append((x, y))
            wanted = list(by_node)
            for first in range(0, len(wanted), NODES_READ):
                part = wanted[first:first + NODES_READ]
                nodes = self._read(level, part)
                for at in part:
                    for end in by_node[at]:
                        n, s = nodes[at].below(deeper[end] >> (FAN_BITS * level))
                        found[end] = (found[end][0] + n, found[end][1] + s)
        return found

    def _read(self, level: int, wanted: list[tuple[int, int]]) -> dict[tuple[int, int], _Node]:
        """Nodes of a level by ``(x, parent key)``; those not kept are read in one job."""
        out, missing = {}, []
        for x, parent in wanted:
            node = self._nodes.pop((level, x, parent), None)
            if node is None:
                missing.append((x, parent))
            else:
                out[x, parent] = self._nodes[level, x, parent] = node
        if missing:
            asked = self.spark.createDataFrame([(x, parent, i) for i, (x, parent) in enumerate(missing)], "x long, parent long, node int")
            parents = [parent for _, parent in missing]
            near = self.levels[level].where(F.col("at").between(min(parents) << FAN_BITS, ((max(parents) + 1) << FAN_BITS) - 1))
            # At most NODES_READ rows are broadcast, and at most FAN rows come back for each.
            rows = near.withColumn("parent", F.shiftright("at", FAN_BITS)).join(F.broadcast(asked), ["x", "parent"]).select("node", "at", "w", "s").toArrow()
            read = dict(self._split(rows, "node"))
            empty = np.zeros(0, np.int64)
            for i, at in enumerate(missing):
                out[at] = self._nodes[(level, *at)] = read.get(i) or _node(empty, empty, empty)
            while len(self._nodes) > NODES_KEPT:
                self._nodes.popitem(last=False)
        return out

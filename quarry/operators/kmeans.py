"""Integer k-means over keyword vectors ``(id, x, y)``.

Semantics kept from the original job:

* assignment to the mean with the least squared distance, ties to the lowest
  mean index;
* new mean = (sum x div n, sum y div n) with 64-bit sums and division that
  truncates toward zero; a mean that receives no point keeps its position;
* after each pass the total squared move of all means is compared with
  ``eta`` (strictly less stops); at most ``max_iterations`` passes; the means
  of the last pass are returned.

Execution: vectors are materialised once as Parquet in the shared checkpoint
folder, compacted to distinct weighted points ``(x, y, w)`` (integer-exact, and
far fewer rows: x takes one value per keyword), and counted once in a
``ScoreIndex``.  On the line of a keyword each mean owns one range of scores,
so a pass is at most k lookups on each line, in exact integers, however many
points there are.  The plan does not grow with the pass count, and a lost
executor only costs a re-read of the written files.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.fixed import (
    KMEANS_ETA,
    KMEANS_KERNELS,
    KMEANS_MAX_ITERATIONS,
    LANG_SPREAD,
    LANGUAGES,
    SIMPLE_SAMPLE_SEED,
    STRATIFIED_SAMPLE_MIN_SPREAD,
)
from quarry.functions.geometry import assign_nearest, means_moves, steps
from quarry.operators.scoreindex import ScoreIndex
from quarry.session import exists, read_text, scratch_path, write_text

# Hash parts of a stratum that are sampled on their own first.
SAMPLE_SALTS = 64

MEANS_SCHEMA = T.StructType([
    T.StructField("idx", T.IntegerType(), False),
    T.StructField("x", T.LongType(), False),
    T.StructField("y", T.LongType(), False),
])

TRACE_SCHEMA = T.StructType([
    T.StructField("iteration", T.IntegerType(), False),
    T.StructField("idx", T.IntegerType(), False),
    T.StructField("old_x", T.LongType(), False),
    T.StructField("old_y", T.LongType(), False),
    T.StructField("new_x", T.LongType(), False),
    T.StructField("new_y", T.LongType(), False),
    T.StructField("move", T.DoubleType(), False),
    T.StructField("total", T.DoubleType(), False),
])


@dataclass(frozen=True)
class ClusterParams:
    """Clustering parameters (I7); every field can be overridden."""

    keywords: tuple[str, ...] = tuple(LANGUAGES)
    spread: int = LANG_SPREAD
    kernels: int = KMEANS_KERNELS
    eta: float = KMEANS_ETA
    max_iterations: int = KMEANS_MAX_ITERATIONS
    seed: int = SIMPLE_SAMPLE_SEED

    def __post_init__(self):
        object.__setattr__(self, "keywords", tuple(self.keywords))
        if self.spread <= 0:
            raise ValueError("spread must be positive, or the keyword cannot be recovered from x")
        if self.kernels <= 0:
            raise ValueError("kernels must be positive")
        if self.max_iterations < 1:
            raise ValueError("max_iterations must be at least 1")

    @property
    def lines(self) -> list[int]:
        """The values that x takes, one per keyword."""
        return [i * self.spread for i in range(len(self.keywords))]

    @property
    def stratified(self) -> bool:
        return self.spread >= STRATIFIED_SAMPLE_MIN_SPREAD

    @property
    def per_keyword(self) -> int:
        n = len(self.keywords)
        if n == 0 or self.kernels % n != 0:
            raise ValueError(
                f"kernels ({self.kernels}) must be a multiple of the number of keywords ({n})"
            )
        return self.kernels // n


# --------------------------------------------------------------------------- sampling


def sample_order(id_column: str, seed: int) -> Column:
    """Deterministic pseudo-random order key: md5 of seed followed by the id."""
    return F.md5(F.concat(F.lit(str(seed)), F.col(id_column).cast("string")))


def _step(key: Column) -> Column:
    """A logarithmic step of an md5 key, 8 to a doubling, that never falls as the key rises (at most 423)."""
    v = F.conv(F.substring(key, 1, 13), 16, 10).cast("bigint")
    bits = F.length(F.bin(v))
    return bits * 8 + F.call_function("shiftright", v, F.greatest(bits - 4, F.lit(0))).bitwiseAND(F.lit(7)).cast("int")


def sample_cuts(vectors: DataFrame, per: int, seed: int) -> dict[int, int]:
    """For each x the least step of the md5 key up to which at least ``per`` vectors lie (all, if there are fewer).

    One hash aggregate counts vectors by x and step; its few hundred rows per
    keyword come to the driver.
    """
    counts = vectors.groupBy("x", _step(sample_order("id", seed)).alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    cuts: dict[int, int] = {}
    held: dict[int, int] = {}
    for r in sorted(counts, key=lambda r: r["step"]):
        if held.get(r["x"], 0) < per:
            cuts[r["x"]] = r["step"]
            held[r["x"]] = held.get(r["x"], 0) + r["n"]
    return cuts


def stratified_sample(vectors: DataFrame, params: ClusterParams) -> DataFrame:
    """Uniform sample of ``kernels / #keywords`` vectors per keyword (M1).

    Vectors are counted by logarithmic steps of their md5 key first
    (:func:`sample_cuts`), which gives each stratum a threshold that the ``k``
    wanted vectors and few others pass, whatever its size; only those are
    sorted.  They are ranked on two levels, the same for every sample size: the
    first ``k`` by the md5 key within each of ``SAMPLE_SALTS`` hash parts of a
    stratum, then the first ``k`` of what is left of it.  ``vectors`` are read
    twice, so give written ones.  Columns: ``id, x, y, rank``.
    """
    per = params.per_keyword
    cuts = sample_cuts(vectors, per, params.seed)
    branches = "".join(f" WHEN {int(x)} THEN {cut}" for x, cut in sorted(cuts.items()))
    cut = F.expr(f"CASE x{branches} END") if cuts else F.lit(0)
    vectors = vectors.where(_step(sample_order("id", params.seed)) <= cut)
    order = (sample_order("id", params.seed), F.col("id"))
    part = F.pmod(F.xxhash64("id"), F.lit(SAMPLE_SALTS))
    within = Window.partitionBy("x", "part").orderBy(*order)
    first = (
        vectors.select("id", "x", "y").withColumn("part", part)
        .withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= per)
    )
    whole = Window.partitionBy("x").orderBy(*order)
    return first.select("id", "x", "y", F.row_number().over(whole).alias("rank")).where(F.col("rank") <= per)


def simple_sample(vectors: DataFrame, params: ClusterParams) -> DataFrame:
    """``kernels`` vectors regardless of keyword, fixed seed (M2).

    A top-k by the md5 key (TakeOrderedAndProject: bounded per task).
    Columns: ``id, x, y, rank``.
    """
    ordered = vectors.select("id", "x", "y", sample_order("id", params.seed).alias("_o"))
    top = ordered.orderBy("_o", "id").limit(params.kernels)
    w = Window.orderBy("_o", "id")  # at most `kernels` rows
    return top.withColumn("rank", F.row_number().over(w)).drop("_o")


def initial_means(vectors: DataFrame, params: ClusterParams) -> list[tuple[int, int]]:
    """Sample the starting means and check the sample (k rows reach the driver).

    Stratified when ``spread >= 500``, else a simple sample.  Means are ordered
    by (x, rank) for the stratified sample and by rank for the simple one; the
    order fixes the mean indices and so the tie rule.
    """
    if params.stratified:
        per = params.per_keyword
        rows = stratified_sample(vectors, params).collect()
        counts: dict[int, int] = {}
        for r in rows:
            counts[r["x"]] = counts.get(r["x"], 0) + 1
        short = {x: n for x, n in counts.items() if n < per}
        if short:
            raise ValueError(f"keyword strata with fewer than {per} vectors: {short}")
        rows.sort(key=lambda r: (r["x"], r["rank"]))
    else:
        rows = simple_sample(vectors, params).collect()
        rows.sort(key=lambda r: r["rank"])
    if len(rows) != params.kernels:
        raise ValueError(f"sampled {len(rows)} means, expected {params.kernels}")
    return [(int(r["x"]), int(r["y"])) for r in rows]


# --------------------------------------------------------------------------- k-means


def weighted_points(vectors: DataFrame) -> DataFrame:
    """Distinct ``(x, y)`` with their multiplicity ``w`` (partial count per task)."""
    return vectors.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w"))


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    This cuts the lineage like a reliable ``checkpoint()``, but computes the
    plan only once (a checkpoint recomputes an unpersisted plan to write it)
    and stores compressed columns that later scans can prune.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@dataclass
class KMeansResult:
    means: list[tuple[int, int]]
    passes: int
    converged: bool
    history: list[tuple] = field(default_factory=list)

    def means_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, int(x), int(y)) for i, (x, y) in enumerate(self.means)]
        return spark.createDataFrame(rows, MEANS_SCHEMA)

    def trace_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.history, TRACE_SCHEMA)


def _toward_zero(total: int, n: int) -> int:
    return abs(total) // n * (1 if total >= 0 else -1)


def kmeans_pass(points: DataFrame | ScoreIndex, means: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """One Lloyd pass over weighted points or their index; returns the new means.

    On each line the means' ranges of scores are the steps of the lower
    envelope; the numbers and sums below their ends give those of the ranges.
    """
    index = points if isinstance(points, ScoreIndex) else ScoreIndex(points)
    owned = {x: steps(x, means) for x in index.lines}
    below = index.below((x, start) for x, found in owned.items() for start, _ in found if start is not None)
    sums = [[0, 0, 0] for _ in means]
    for x, found in owned.items():
        ends = [(0, 0), *[below[x, start] for start, _ in found[1:]], index.total(x)]
        for (_, i), (n0, s0), (n1, s1) in zip(found, ends, ends[1:]):
            sums[i][0] += n1 - n0
            sums[i][1] += x * (n1 - n0)
            sums[i][2] += s1 - s0
    return [(_toward_zero(sx, n), _toward_zero(sy, n)) if n else (int(old[0]), int(old[1])) for (n, sx, sy), old in zip(sums, means)]


def kmeans(
    points: DataFrame | ScoreIndex,
    means: list[tuple[int, int]],
    params: ClusterParams,
    trace: bool = True,
    resume: LoopState | None = None,
) -> KMeansResult:
    """Run Lloyd passes from ``means`` over weighted points ``(x, y, w)``.

    Points are indexed once (see ``quarry.operators.scoreindex``); an index
    made before can be given instead.  With ``resume`` the means and the pass
    number are kept there, and a loop that was broken off goes on behind its
    last kept pass.
    """
    current = [(int(x), int(y)) for x, y in means]
    history: list[tuple] = []
    done = 0
    if resume is not None and (kept := resume.load()) is not None:
        current, done, history = kept
        if done and resume.total < params.eta:
            return KMeansResult(current, done, True, history)
    index = points if isinstance(points, ScoreIndex) else ScoreIndex(points)
    for it in range(done + 1, params.max_iterations + 1):
        new = kmeans_pass(index, current)
        moves, total = means_moves(current, new)
        if trace:
            history += [
                (it, i, a[0], a[1], b[0], b[1], mv, total)
                for i, (a, b, mv) in enumerate(zip(current, new, moves))
            ]
        current = new
        if resume is not None:
            resume.store(current, it, total, history)
        if total < params.eta:
            return KMeansResult(current, it, True, history)
    return KMeansResult(current, params.max_iterations, False, history)


class LoopState:
    """Where a clustering run keeps its tables, its means and its pass number: a folder that the caller names.

    ``params`` must be those the folder was begun with.  The written tables
    count when they are complete; the loop's state is a small text file, put in
    place by a rename, so a crash leaves the old one or the new one.
    """

    def __init__(self, spark: SparkSession, folder: str, params: ClusterParams):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.params = json.loads(json.dumps(asdict(params)))
        self.total = float("inf")
        saved = self._read("params")
        if saved is None:
            write_text(spark, f"{self.folder}/params", json.dumps(self.params))
        elif saved != self.params:
            raise ValueError(f"{folder} was begun with other parameters: {saved}")

    def _read(self, name: str):
        text = read_text(self.spark, f"{self.folder}/{name}")
        return None if text is None else json.loads(text)

    def table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table ``name`` of the folder; ``make()`` is written there first unless it is complete."""
        path = f"{self.folder}/{name}"
        if not exists(self.spark, f"{path}/_SUCCESS"):
            make().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def load(self) -> tuple[list[tuple[int, int]], int, list[tuple]] | None:
        """Means, number of passes and trace as kept last."""
        kept = self._read("loop")
        if kept is None:
            return None
        self.total = kept["total"]
        return [tuple(m) for m in kept["means"]], kept["passes"], [tuple(h) for h in kept["history"]]

    def store(self, means: list[tuple[int, int]], passes: int, total: float, history: list[tuple]) -> None:
        self.total = total
        write_text(self.spark, f"{self.folder}/loop", json.dumps({"means": means, "passes": passes, "total": total, "history": history}))


def prepare_points(vectors: DataFrame, state: LoopState | None = None) -> tuple[DataFrame, DataFrame]:
    """Materialise the vectors once and derive the weighted points from them.

    Returns ``(vectors, points)``, both written to the checkpoint folder, or
    to that of ``state``, where complete tables are kept.
    """
    def write(name, make):
        return state.table(name, make) if state is not None else materialize(make(), name)

    vecs = write("vectors", lambda: vectors.select("id", "x", "y"))
    return vecs, write("points", lambda: weighted_points(vecs))


def cluster(vectors: DataFrame, params: ClusterParams, trace: bool = True, state_folder: str | None = None) -> tuple[KMeansResult, DataFrame]:
    """Sample, then iterate: the whole clustering.  Returns the result and the points.

    With ``state_folder`` (shared storage) a run that a crashed driver left is
    taken up: its tables are not made again, its loop goes on.  The input must
    be the same; delete the folder to begin anew.
    """
    state = LoopState(vectors.sparkSession, state_folder, params) if state_folder else None
    vecs, points = prepare_points(vectors, state)
    if state is not None and state.load() is None:
        state.store(initial_means(vecs, params), 0, float("inf"), [])
    means = state.load()[0] if state is not None else initial_means(vecs, params)
    return kmeans(points, means, params, trace, state), points


def assign_clusters(df: DataFrame, means: list[tuple[int, int]], column: str = "cluster", lines: list[int] | None = None) -> DataFrame:
    """Add the index of the nearest mean, lowest index on ties.

    ``lines``: the values that x takes (``ClusterParams.lines``); a point's
    mean is then found by binary search in its line's steps.
    """
    return assign_nearest(df, means, column, lines=lines)

"""Approximate nearest neighbours by largest inner product: an inverted multi-index.

Every vector is cut into two halves; each half is quantised by its own
codebook, so a vector lies in the cell of a pair of centroids.  A query visits
centroid pairs in the order of their summed distance (the negative inner
product with the query's halves): both centroid lists are sorted, and a heap
gives the next pair.  It stops when the visited cells hold enough entries.
How many are enough is measured on the table itself, by one rule at every size:
the true nearest rows of at most ``PROBE_QUERIES`` rows that are not queries
(chosen by hash; queries only if there are no others) are found by comparing
them with every row, and the least number of entries with which the traversal
reaches ``TARGET_RECALL`` of them holds for all queries.
All entries of the visited cells are reranked by the exact inner product in
double precision, summed in one fixed order, so equal vectors get equal scores.

The codebooks are trained by k-means on at most ``SAMPLE_ROWS`` rows, chosen
by a hash of the row number; every row is indexed.  Counts by cell (at most
``MAX_CENTROIDS`` squared) are the only table on the driver.  Entries meet
queries by the first centroid: a centroid's entries are split into blocks and
its queries into shards by hash, so no task holds more than a block and a
shard however many rows share a cell, and each block returns its best rows of
each query.

Defined results: vectors that are null, empty, zero, of another length than
the commonest (the shortest of these at a tie), or that hold null or non-finite components take no part;
rows are told apart by number, so repeated ids are separate rows; an id of null can
be found but is no query; ties go to the smaller id; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import arrow_schema, batches_of, ddl, write_shared

NEIGHBOURS = 20
SAMPLE_ROWS = 8192
MAX_CENTROIDS = 256
ENTRIES_PER_CELL = 16
ROUNDS = 12
MIN_CANDIDATES = 512
PROBE_QUERIES = 512           # rows whose true neighbours set the stop, at most
TARGET_RECALL = 0.95          # on those rows
PROBE_ROWS = 2048             # rows compared with them at a time
BLOCK_ENTRIES = 4096
SHARD_QUERIES = 1024


def kmeans(points: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 0) -> np.ndarray:
    """Centroids of ``points``; those that lose all their points stay where they are."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    centroids = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)]
    for _ in range(rounds):
        nearest = assign(points, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(centroids))
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


def assign(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (2 * points @ centroids.T - (centroids * centroids).sum(axis=1)).argmax(axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    """Equally long vectors as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def traverse(query: np.ndarray, books: tuple[np.ndarray, np.ndarray], counts: np.ndarray, need: int) -> list[tuple[int, int]]:
    """Centroid pairs by summed distance until their cells hold ``need`` entries."""
    half = books[0].shape[1]
    far1, far2 = -(books[0] @ query[:half]), -(books[1] @ query[half:])
    order1, order2 = far1.argsort(kind="stable"), far2.argsort(kind="stable")
    far1, far2 = far1[order1].tolist(), far2[order2].tolist()
    sizes = counts[order1][:, order2].tolist()
    order1, order2 = order1.tolist(), order2.tolist()
    heap, found, out = [(far1[0] + far2[0], 0, 0)], 0, []
    # Each open row i waits with its next column; row i + 1 opens with the visit of (i, 0).
    while heap and found < need:
        _, i, j = heapq.heappop(heap)
        if sizes[i][j]:
            found += sizes[i][j]
            out.append((order1[i], order2[j]))
        if j + 1 < len(far2):
            heapq.heappush(heap, (far1[i] + far2[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(far1):
            heapq.heappush(heap, (far1[i + 1] + far2[0], i + 1, 0))
    return out


def entries_before(query: np.ndarray, books: tuple[np.ndarray, np.ndarray], counts: np.ndarray) -> np.ndarray:
    """For each cell, how many entries the cells hold that :func:`traverse` visits before it."""
    half = books[0].shape[1]
    far = (-(books[0] @ query[:half])[:, None] - (books[1] @ query[half:])[None, :]).ravel()
    order = far.argsort(kind="stable")
    sizes = counts.ravel()[order]
    before = np.empty_like(sizes)
    before[order] = sizes.cumsum() - sizes
    return before


def measured_need(entries: DataFrame, probed: DataFrame, books: tuple[np.ndarray, np.ndarray], counts: np.ndarray, k: int) -> int:
    """The least number of entries with which rows of ``probed`` find ``TARGET_RECALL`` of their true ``k`` nearest rows."""
    asked = probed.orderBy(F.xxhash64("row"), "row").limit(PROBE_QUERIES).collect()
    if not asked:
        return 0
    matrix = np.array([r["vector"] for r in asked], dtype=np.float64)
    asked_rows = np.array([r["row"] for r in asked], dtype=np.int64)
    columns = counts.shape[1]
    nearest_type = ddl("query:int score:double cell:int")

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = np.full((len(matrix), 0), -np.inf)
        cells = np.zeros((len(matrix), 0), dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, PROBE_ROWS):
                part = batch.slice(at, PROBE_ROWS)
                here = matrix @ _matrix(part.column(1)).T
                here[asked_rows[:, None] == part.column(0).to_numpy()[None, :]] = -np.inf
                cell = part.column(2).to_numpy().astype(np.int64) * columns + part.column(3).to_numpy()
                scores = np.concatenate([scores, here], axis=1)
                cells = np.concatenate([cells, np.broadcast_to(cell, here.shape)], axis=1)
                if scores.shape[1] > k:
                    best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
                    scores, cells = np.take_along_axis(scores, best, axis=1), np.take_along_axis(cells, best, axis=1)
        q, at = np.nonzero(scores > -np.inf)
        yield from batches_of(arrow_schema(nearest_type), {"query": pa.array(q, pa.int32()), "score": pa.array(scores[q, at]),
                                                           "cell": pa.array(cells[q, at], pa.int32())})

    best = entries.select("row", "vector", "first", "second").mapInArrow(nearest, nearest_type)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "cell")
    wanted: dict[int, list[int]] = {}
    for r in best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).collect():
        wanted.setdefault(r["query"], []).append(r["cell"])
    needs = np.sort(np.concatenate([entries_before(matrix[q], books, counts)[cells] for q, cells in wanted.items()] or [np.zeros(1, np.int64)])) + 1
    return int(needs[math.ceil(TARGET_RECALL * len(needs)) - 1])


def best_of_block(queries: np.ndarray, masks: np.ndarray, query_rows: np.ndarray, entries: np.ndarray, second: np.ndarray,
                  ids: np.ndarray, rows: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its best entries of the block: its index, entry indices, exact scores."""
    rough = queries @ entries.T
    for q in range(len(queries)):
        open_to = np.flatnonzero(masks[q][second] & (rows != query_rows[q]))
        if not len(open_to):
            continue
        scores = rough[q, open_to]
        if len(open_to) > k:
            # Rough scores may differ in the last digits between equal rows; a margin keeps all ties.
            floor = np.partition(scores, len(scores) - k)[len(scores) - k]
            margin = 1e-9 * max(1.0, float(np.abs(scores).max()))
            open_to = open_to[scores >= floor - margin]
        exact = (entries[open_to] * queries[q]).sum(axis=1)
        top = np.lexsort((ids[open_to], -exact))[:k]
        yield q, open_to[top], exact[top]


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def search(vectors: DataFrame, is_query: Column, k: int = NEIGHBOURS, id_col: str = "vec_id", vector_col: str = "embedding",
           min_candidates: int = MIN_CANDIDATES, candidate_share: float | None = None) -> DataFrame:
    """The ``k`` best rows found for every query row: ``(query_id, rank, vec_id, score)``.

    ``is_query`` is a condition on a column ``vec_id``.  A query's visited cells
    hold at least ``min_candidates`` entries and ``candidate_share`` of all; without
    a share, as many as reach ``TARGET_RECALL`` on the probed rows.
    """
    source = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    numbered = write_shared(source.where(F.coalesce(usable(F.col("vector")), F.lit(False)))
                            .withColumn("row", F.monotonically_increasing_id()), "vectors")
    # The commonest width, from all rows; one row is kept.
    common = numbered.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()
    result = ddl("query_id:long query_row:long vec_id:long score:double")
    if common is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, total = common
    numbered = numbered.where(F.size("vector") == width)

    # Codebooks from a bounded sample.
    share = min(1.0, 2 * SAMPLE_ROWS / total)
    hashed = F.pmod(F.xxhash64("row"), F.lit(1 << 30))
    rows = numbered.where(hashed < int(share * (1 << 30))).select(hashed.alias("h"), "row", "vector").collect() or numbered.take(1)
    rows = sorted(rows, key=lambda r: r[:2])[:SAMPLE_ROWS]
    sample = np.array([r["vector"] for r in rows])
    half = (width + 1) // 2
    centroids = max(1, min(MAX_CENTROIDS, math.ceil(math.sqrt(total / ENTRIES_PER_CELL))))
    books = (kmeans(sample[:, :half], centroids), kmeans(sample[:, half:], centroids) if width > 1 else np.zeros((1, 0)))
    shape = (len(books[0]), len(books[1]))

    indexed_type = ddl("vec_id:long row:long vector:doubles first:int second:int")

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(indexed_type)
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _matrix(batch.column(1))
            first = assign(m[:, :half], books[0])
            second = assign(m[:, half:], books[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(1).cast(schema.field("vector").type),
                                              pa.array(first, pa.int32()), pa.array(second, pa.int32())], schema=schema)

    entries = write_shared(numbered.mapInArrow(quantise, indexed_type), "entries")
    counts = np.zeros(shape, dtype=np.int64)
    for r in entries.groupBy("first", "second").count().collect():
        counts[r["first"], r["second"]] = r["count"]
    queries = entries.where(is_query).select("vec_id", "row", "vector")
    if candidate_share is None:
        others = entries.where(~F.coalesce(is_query, F.lit(False))).select("vec_id", "row", "vector")
        enough = measured_need(entries, others if others.take(1) else queries, books, counts, k)
    else:
        enough = math.ceil(candidate_share * int(counts.sum()))
    need = max(min_candidates, enough, k) + 1

    probe_type = ddl("query_id:long query_row:long query:doubles first:int mask:binary")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(probe_type)
        for batch in batches:
            if not batch.num_rows:
                continue
            columns: dict[str, list] = {f.name: [] for f in schema}
            for vec_id, row, query in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _matrix(batch.column(2))):
                cells = np.array(traverse(query, books, counts, need), dtype=np.int64).reshape(-1, 2)
                for first in np.unique(cells[:, 0]).tolist():
                    mask = np.zeros(shape[1], dtype=np.uint8)
                    mask[cells[cells[:, 0] == first, 1]] = 1
                    values = (vec_id, row, query.tolist(), first, np.packbits(mask).tobytes())
                    for name, value in zip(columns, values):
                        columns[name].append(value)
            yield from batches_of(schema, columns)

    probes = write_shared(queries.mapInArrow(probe, probe_type), "probes")

    # Blocks and shards by first centroid.
    by_first = counts.sum(axis=1)
    asked = {r["first"]: r["count"] for r in probes.groupBy("first").count().collect()}
    plan = [(f, max(1, math.ceil(int(by_first[f]) / BLOCK_ENTRIES)), max(1, math.ceil(asked[f] / SHARD_QUERIES)))
            for f in range(shape[0]) if f in asked]
    if not plan:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    cuts = F.broadcast(vectors.sparkSession.createDataFrame(plan, "first int, blocks int, shards int"))
    left = entries.join(cuts, "first").select(
        "first", F.pmod(F.xxhash64("row"), F.col("blocks")).alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "second", "vec_id", "row", "vector")
    right = probes.join(cuts, "first").select(
        "first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)).alias("block"),
        F.pmod(F.xxhash64("query_row"), F.col("shards")).cast("int").alias("shard"), "query_id", "query_row", "query", "mask")

    def rerank(_key: tuple, block: pa.Table, asking: pa.Table) -> pa.Table:
        schema = arrow_schema(result)
        out: dict[str, list] = {f.name: [] for f in schema}
        if block.num_rows and asking.num_rows:
            block, asking = block.combine_chunks(), asking.combine_chunks()
            ids = block["vec_id"].fill_null(np.iinfo(np.int64).max).to_numpy()
            given = block["vec_id"].to_pylist()
            masks = np.unpackbits(np.stack([np.frombuffer(m.as_py(), np.uint8) for m in asking["mask"]]), axis=1).astype(bool)
            query_ids, query_rows = asking["query_id"].to_pylist(), asking["query_row"].to_numpy()
            found = best_of_block(_matrix(asking["query"].combine_chunks()), masks, query_rows,
                                  _matrix(block["vector"].combine_chunks()), block["second"].to_numpy(), ids, block["row"].to_numpy(), k)
            for q, at, scores in found:
                out["query_id"] += [query_ids[q]] * len(at)
                out["query_row"] += [int(query_rows[q])] * len(at)
                out["vec_id"] += [given[i] for i in at.tolist()]
                out["score"] += scores.tolist()
        return pa.table({n: pa.array(v, schema.field(n).type) for n, v in out.items()}, schema=schema)

    slot = ("first", "block", "shard")
    best = left.groupBy(*slot).cogroup(right.groupBy(*slot)).applyInArrow(rerank, result)
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

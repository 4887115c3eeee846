"""Packing token sequences by multiway differencing.

Each document's ids (those of a public tokenizer and one end id) are cut into
full windows and a rest.  Rests are collected into a block of at least
``block_windows`` windows' tokens.  Karmarkar-Karp differencing deals the
block's rests, whole, to windows: every rest starts as a partial partition of
loads ``(length, 0, 0, ...)``; the two partial partitions with the largest
spread are merged, the fullest window of one with the emptiest of the other,
until one partition is left.  Its windows are nearly equal.  While one exceeds
the capacity, the window count rises by as many as the excess fills, and the
rests are dealt anew.  Only then is anything cut: the emptiest windows are
taken apart to fill the others up, and what is left goes to the next block.
At the end of a Spark partition the last tokens fill windows of a power of
two, which need no padding.

Blocks never leave their task, so nothing is shuffled; a lost task is repeated
with the same result because it depends on its input partition alone.

Defined results: a null or empty text holds the end id only; repeated rows are
packed each on their own; an empty table gives no pieces; other columns are
not read.  Memory per task is one Arrow batch and one block.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_schema, batches_of, chunk_ends, ddl, utf8
from quarry.llm.wordcache import word_end_ids

CAPACITY = 2048
END_ID = 1
BLOCK_WINDOWS = 64
CHUNK_BYTES = 4 << 20         # text whose distinct words are looked up together
BUNDLE_TOKENS = 128           # shorter pieces are bundled before differencing
PIECES = ddl("doc_id:long start:long length:long ids:binary doc_tokens:long sequence_id:long offset:long")


def difference(lengths: list[int], windows: int) -> list[list[int]]:
    """Deal pieces to ``windows`` windows by Karmarkar-Karp differencing; indices by window."""
    # A partial partition holds its loaded windows only, fullest first; the others are empty.
    heap = [(-n, k, [(n, [k])]) for k, n in enumerate(lengths)]
    heapq.heapify(heap)
    count = len(heap)
    while len(heap) > 1:
        _, _, loaded = heapq.heappop(heap)
        _, _, other = heapq.heappop(heap)
        met = max(0, len(loaded) + len(other) - windows)     # windows that both load: the emptiest ones of either
        apart = len(loaded) - met
        both = [(n + m, held + more) for (n, held), (m, more) in zip(loaded[apart:], reversed(other[len(other) - met:]))]
        merged = loaded[:apart] + both + other[:len(other) - met][::-1]
        merged.sort(key=itemgetter(0), reverse=True)
        spread = merged[0][0] - (merged[-1][0] if len(merged) == windows else 0)
        heapq.heappush(heap, (-spread, count, merged))
        count += 1
    dealt = [held for _, held in heap[0][2]] if heap else []
    return dealt + [[] for _ in range(windows - len(dealt))]


def _bundles(lengths: list[int], bound: int) -> list[list[int]]:
    """Indices of consecutive pieces under ``bound`` together, up to less than twice the bound; long ones alone."""
    out, short, size = [], [], 0
    for k, n in enumerate(lengths):
        if n >= bound:
            out.append([k])
            continue
        short.append(k)
        size += n
        if size >= bound:
            out.append(short)
            short, size = [], 0
    return out + [short] if short else out


def deal_whole(pieces: list[tuple[int, int, int]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Uncut pieces ``(key, start, length)`` in windows of at most ``capacity``; the count rises while one exceeds it."""
    lengths = [n for _, _, n in pieces]
    groups = _bundles(lengths, min(BUNDLE_TOKENS, capacity // 2))
    sizes = [sum(lengths[k] for k in g) for g in groups]
    windows = -(-sum(lengths) // capacity)
    while True:
        dealt = difference(sizes, windows)
        over = sum(max(0, sum(sizes[g] for g in held) - capacity) for held in dealt)
        if not over:
            return [[pieces[k] for g in held for k in groups[g]] for held in dealt]
        windows += -(-over // capacity)


def fill_windows(pieces: list[tuple[int, int, int]], capacity: int) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """As many full windows as the pieces fill, and the pieces that are left, less than a window.

    Of the windows with whole pieces the emptiest are cut up to fill the others.
    """
    loaded = sorted(((sum(n for _, _, n in w), w) for w in deal_whole(pieces, capacity)), key=lambda x: -x[0])
    whole = sum(n for n, _ in loaded) // capacity
    spare = [piece for _, w in loaded[whole:] for piece in w]
    out = []
    for n, window in loaded[:whole]:
        if n < capacity:
            head, spare = _cut_front(spare, capacity - n)
            window = window + head
        out.append(window)
    return out, spare


def _cut_front(pieces: list, tokens: int) -> tuple[list, list]:
    """Split a list of pieces after ``tokens`` tokens."""
    head, k = [], 0
    while k < len(pieces) and tokens:
        key, start, n = pieces[k]
        if n > tokens:
            head.append((key, start, tokens))
            return head, [(key, start + tokens, n - tokens), *pieces[k + 1:]]
        head.append(pieces[k])
        tokens -= n
        k += 1
    return head, pieces[k:]


class Packer:
    """Collects documents' ids and gives finished windows, lists of ``(key, start, length)``."""

    def __init__(self, capacity: int, block_windows: int):
        self.capacity, self.block = capacity, capacity * block_windows
        self.pool: list[tuple[int, int, int]] = []
        self.held = 0

    def add(self, key: int, n: int) -> Iterator[list]:
        full = n // self.capacity * self.capacity
        for start in range(0, full, self.capacity):
            yield [(key, start, self.capacity)]
        if n > full:
            self.pool.append((key, full, n - full))
            self.held += n - full
        if self.held >= self.block:
            yield from self._fill()

    def _fill(self) -> Iterator[list]:
        windows, self.pool = fill_windows(self.pool, self.capacity)
        self.held -= self.capacity * len(windows)
        yield from windows

    def finish(self) -> Iterator[list]:
        if self.held >= self.capacity:
            yield from self._fill()
        left, rest = self.held, self.pool
        while left:
            size = 1 << (left.bit_length() - 1)
            window, rest = _cut_front(rest, size)
            yield window
            left -= size


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Pieces of ``docs`` by sequence: ids of each piece, where it stands in its document and sequence.

    ``tokenizer_path`` names a word-end BPE file that every executor can read
    (it comes with an installed package).  ``capacity`` is a power of two.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    schema = arrow_schema(PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_end_ids(tokenizer_path)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        packer = Packer(capacity, block_windows)
        sequence = TaskContext.get().partitionId() << 40
        open_docs: dict[int, tuple[object, bytes, int]] = {}
        left: dict[int, int] = {}
        rows: dict[str, list] = {f.name: [] for f in schema}
        key = 0

        def put(window: list) -> None:
            nonlocal sequence
            offset = 0
            for k, start, n in window:
                doc_id, ids, total = open_docs[k]
                for name, value in (("doc_id", doc_id), ("start", start), ("length", n),
                                    ("ids", ids[4 * start:4 * (start + n)]), ("doc_tokens", total),
                                    ("sequence_id", sequence), ("offset", offset)):
                    rows[name].append(value)
                offset += n
                left[k] -= n
                if not left[k]:
                    del left[k], open_docs[k]
            sequence += 1

        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            done = 0
            for stop in chunk_ends(texts, CHUNK_BYTES):
                counts, words, place = cache.distinct(texts.slice(done, stop - done))
                values = pa.array(cache.values(words), pa.large_binary())
                taken = values.take(pa.array(place)).buffers()[2]
                sizes = np.append(0, np.cumsum(pc.binary_length(values).to_numpy()[place]))
                cuts = sizes[np.append(0, np.cumsum(counts))].tolist()
                for doc_id, a, b in zip(doc_ids[done:stop], cuts, cuts[1:]):
                    ids = (taken[a:b].to_pybytes() if b > a else b"") + end
                    n = len(ids) // 4
                    open_docs[key], left[key] = (doc_id, ids, n), n
                    for window in packer.add(key, n):
                        put(window)
                    key += 1
                done = stop
                yield from batches_of(schema, rows)
                rows = {f.name: [] for f in schema}
        for window in packer.finish():
            put(window)
        yield from batches_of(schema, rows)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"))
    return source.mapInArrow(run, PIECES)


def packing_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

"""Suffix-array dedup: every byte of a repeated 200-byte string is removed.

All documents are searched at once, without one suffix array of the corpus.

Anchors.  Every 200-byte window has an anchor: the 40-byte gram inside it with
the smallest hash, the first of equal ones.  Equal windows have equal anchors
at equal places, so windows are compared only with windows of the same anchor.
Neighbouring windows with one anchor form a piece, about one for 81 bytes, and
each window lies in exactly one piece.

Candidates.  Pieces are aggregated by the anchor's hash.  An anchor that occurs
once has no repeated window.  If all pieces of an anchor are equal, all their
windows are repeated.  All other pieces, each different one once and with its
number of occurrences, go to the suffix array.

Suffix array.  Pieces of the same anchors meet in one task and are sorted in
blocks of whole anchor groups by two-stage sorting: only suffixes smaller than
their successors are sorted directly; all others are induced by scanning the
buckets of first bytes in order, each sorted suffix placing its predecessor.
Adjacent common prefixes, up to 200 bytes, then mark the windows that occur at
least twice.

An anchor with more than ``GROUP_LIMIT`` different pieces is not brought
together: its pieces are cut into parts of a few windows, equal parts are
aggregated, and the windows of the different parts are spread by their own
hash and counted.  Copies are
aggregated before every shuffle, so a passage in a third of all documents is
one piece with a count.

Texts are compared as UTF-8 bytes; matches never cross documents.  Defined
results: null and empty texts have zero bytes and the digest of nothing; rows
with equal id and text get equal results; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_schema, batches_of, ddl, return_memory, utf8, write_shared

MIN_BYTES = 200
GRAM_BYTES = 40
GROUP_LIMIT = 2048
BLOCK_BYTES = 1 << 18
CHUNK_BYTES = 1 << 19         # half the bytes hashed at a time; longer texts are cut into overlapping segments
PART_WINDOWS = 8              # windows of a part, in large anchor groups
PLACE_BITS = 23               # of a place in a chunk; the rest of the key orders by hash

_RNG = np.random.default_rng(20)
BYTE_VALUES = _RNG.integers(1, 1 << 63, size=256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)                     # odd, so it has an inverse
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Hashes:
    """Hashes of any substring of ``data``."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        with np.errstate(over="ignore"):
            power = np.full(n, BASE, dtype=np.uint64)
            self.inverse = np.full(n + 1, BASE_INVERSE, dtype=np.uint64)
            power[:1], self.inverse[0] = 1, 1
            np.cumprod(self.inverse, out=self.inverse)
            np.cumprod(power, out=power)
            power *= BYTE_VALUES[data]
            self.sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(power, out=self.sums[1:])

    def of(self, start, end) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mixed((self.sums[end] - self.sums[start]) * self.inverse[start])


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:len(values) - (width - size)], values[width - size:]) if width > size else values


def pieces_of(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, min_bytes: int = MIN_BYTES, gram: int = GRAM_BYTES):
    """Pieces of texts laid end to end: text number, first window, windows, anchor hash, piece hash."""
    width = min_bytes - gram + 1
    hashes = Hashes(data)
    grams = hashes.of(np.arange(len(data) - gram + 1), np.arange(gram, len(data) + 1))
    mask = np.uint64((1 << PLACE_BITS) - 1)
    least = sliding_minimum((grams & ~mask) | np.arange(len(grams), dtype=np.uint64), width)
    anchor = (least & mask).astype(np.int64)
    # Window starts of all texts; those of different texts never touch.
    change = np.zeros(len(anchor) + 1, dtype=np.int8)
    windows = lengths - min_bytes + 1
    has = windows > 0
    change[starts[has]] += 1
    change[starts[has] + windows[has]] -= 1
    valid = np.cumsum(change[:-1], dtype=np.int8).astype(bool)
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    first = np.flatnonzero(new)
    last = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], True))
    count = last - first + 1
    own = hashes.of(first, last + min_bytes)
    text = np.searchsorted(starts, first, side="right") - 1
    return text, first - starts[text], count, grams[anchor[first]], _mixed(own + count.astype(np.uint64))


def _segments(text: bytes, min_bytes: int) -> Iterator[tuple[int, bytes]]:
    step = CHUNK_BYTES - min_bytes
    for at in range(0, max(1, len(text) - min_bytes + 1), step):
        yield at, text[at:at + step + min_bytes - 1]


PIECES = ddl("doc_id:long text_hash:long start:long windows:int anchor:long piece:long")


def _pieces(min_bytes: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(PIECES)
        held: list[tuple] = []
        size = 0

        def emit() -> Iterator[pa.RecordBatch]:
            lengths = np.array([len(t) for *_, t in held], dtype=np.int64)
            data = np.frombuffer(b"".join(t for *_, t in held), dtype=np.uint8)
            starts = np.cumsum(lengths) - lengths
            text, first, count, anchor, piece = pieces_of(data, starts, lengths, min_bytes, gram)
            ids = pa.array([d for d, *_ in held], pa.int64()).take(pa.array(text))
            hashes = np.array([h for _, h, *_ in held], dtype=np.int64)[text]
            base = np.array([b for _, _, b, _ in held], dtype=np.int64)[text]
            yield from batches_of(schema, {
                "doc_id": ids, "text_hash": pa.array(hashes), "start": pa.array(base + first), "windows": pa.array(count, pa.int32()),
                "anchor": pa.array(anchor.view(np.int64)), "piece": pa.array(piece.view(np.int64))})

        for batch in batches:
            for doc_id, text_hash, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                for at, part in _segments(text.as_py(), min_bytes):
                    if len(part) < min_bytes:
                        continue
                    if size + len(part) > 2 * CHUNK_BYTES:
                        yield from emit()
                        held, size = [], 0
                    held.append((doc_id, text_hash, at, part))
                    size += len(part)
        if held:
            yield from emit()
        return_memory()

    return run


# ------------------------------------------------------------------ suffix array


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``data`` by their first ``depth`` bytes (zeros follow the end), by two-stage sorting."""
    n = len(data)
    padded = np.append(data, np.zeros(depth, dtype=np.uint8))
    # A suffix is smaller than its successor if the byte behind its first run is larger.
    turns = np.flatnonzero(data[:-1] != data[1:])
    run_end = np.append(turns, n - 1)[np.searchsorted(turns, np.arange(n))]
    smaller = (run_end < n - 1) & (data[run_end] < data[np.minimum(run_end + 1, n - 1)])
    direct = np.flatnonzero(smaller)
    keys = np.lib.stride_tricks.sliding_window_view(padded, depth)[direct]
    direct = direct[np.argsort(np.ascontiguousarray(keys).view(f"S{depth}").ravel(), kind="stable")]
    # Buckets by first byte: induced suffixes fill them from the front, the sorted ones stand at their end.
    sizes = np.bincount(data, minlength=256)
    ends = np.cumsum(sizes)
    heads = ends - sizes
    sorted_sizes = np.bincount(data[direct], minlength=256)
    order = np.empty(n, dtype=np.int64)
    first = data[direct].astype(np.int64)
    order[ends[first] - sorted_sizes[first] + np.arange(len(direct)) - (np.cumsum(sorted_sizes) - sorted_sizes)[first]] = direct

    def induce(scanned: np.ndarray) -> None:
        before = scanned[scanned > 0] - 1
        before = before[~smaller[before]]
        if len(before):
            bucket = data[before].astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            bucket, counts = bucket[by], np.bincount(bucket, minlength=256)
            order[heads[bucket] + np.arange(len(by)) - (np.cumsum(counts) - counts)[bucket]] = before[by]
            heads[:] += counts

    induce(np.array([n]))                                # the empty suffix comes before all
    for byte in np.flatnonzero(sizes).tolist():
        done = int(ends[byte] - sizes[byte])
        while done < heads[byte]:                        # runs of one byte induce within their own bucket
            until = int(heads[byte])
            induce(order[done:until])
            done = until
        induce(order[int(ends[byte] - sorted_sizes[byte]):int(ends[byte])])
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of each suffix in ``order`` with the one before it, at most ``depth`` (a multiple of 8)."""
    padded = np.append(data, np.zeros(depth + 8, dtype=np.uint8))
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)).view(">u8").ravel().astype(np.uint64)
    out = np.full(len(order), depth, dtype=np.int64)
    out[:1] = 0
    alive = np.arange(1, len(order))
    steps = np.array([1 << 8 * k for k in range(1, 8)], dtype=np.uint64)
    for at in range(0, depth, 8):
        a, b = order[alive - 1] + at, order[alive] + at
        differ = words[np.minimum(a, len(words) - 1)] ^ words[np.minimum(b, len(words) - 1)]
        ended = differ != 0
        out[alive[ended]] = at + 7 - np.searchsorted(steps, differ[ended], side="right")
        alive = alive[~ended]
    return out


def repeated_windows(pieces: list[bytes], times: np.ndarray, min_bytes: int) -> list[np.ndarray]:
    """For each different piece, which of its windows occur at least twice, pieces counted ``times``."""
    lengths = np.array([len(p) for p in pieces], dtype=np.int64)
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    piece = np.repeat(np.arange(len(pieces)), lengths)
    inside = np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    whole = inside + min_bytes <= lengths[piece]
    order = suffix_array(data, min_bytes)
    run = np.cumsum(common_prefixes(data, order, min_bytes) < min_bytes) - 1
    weight = np.where(whole[order], times[piece[order]], 0)
    often = np.bincount(run, weights=weight)[run] >= 2
    marked = np.zeros(len(data), dtype=bool)
    marked[order] = often
    marked &= whole
    return [m[:max(0, n - min_bytes + 1)] for m, n in zip(np.split(marked, np.cumsum(lengths)[:-1]), lengths.tolist())]


TEXTS = ddl("anchor:long piece:long times:long bytes:binary")
MARKS = ddl("anchor:long piece:long marks:binary")


def _sort_groups(min_bytes: int):
    """Marks of all pieces, from rows sorted by anchor and piece; blocks hold whole anchor groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(MARKS)
        block: list[tuple] = []
        size = 0

        def emit() -> Iterator[pa.RecordBatch]:
            marks = repeated_windows([b for *_, b in block], np.array([t for _, _, t, _ in block]), min_bytes)
            hit = [(a, p, np.packbits(m).tobytes()) for (a, p, _, _), m in zip(block, marks) if m.any()]
            yield from batches_of(schema, dict(zip(("anchor", "piece", "marks"), map(list, zip(*hit)))) if hit else {n: [] for n in schema.names})

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if block and row[:2] == block[-1][:2]:
                    continue                             # the same piece from a row with equal id and text
                if size > BLOCK_BYTES and row[0] != block[-1][0]:
                    yield from emit()
                    block, size = [], 0
                block.append(row)
                size += len(row[3])
        if block:
            yield from emit()
        return_memory()

    return run


def _cut(min_bytes: int):
    """Bytes of the wanted pieces of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(TEXTS)
        for batch in batches:
            for text, wanted in zip(batch.column(0), batch.column(1)):
                data, rows = text.as_py(), wanted.as_py()
                yield from batches_of(schema, {
                    "anchor": [r["anchor"] for r in rows], "piece": [r["piece"] for r in rows], "times": [r["times"] for r in rows],
                    "bytes": [data[r["start"]:r["start"] + r["windows"] - 1 + min_bytes] for r in rows]})

    return run


PARTS = ddl("anchor:long piece:long times:long first:int p1:long p2:long part:binary")


def _parts(min_bytes: int, gram: int):
    """Pieces of one large anchor group cut into parts of ``PART_WINDOWS`` windows at fixed places around the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(PARTS)
        for batch in batches:
            for anchor, piece, times, data in zip(*(c.to_pylist() for c in batch.columns)):
                array = np.frombuffer(data, dtype=np.uint8)
                one, two = Hashes(array), Hashes(255 - array)
                n = len(data) - min_bytes + 1
                last = np.arange(n - 1, min_bytes - gram + 1)          # the anchor lies in every window of the piece
                place = int(last[one.of(last, last + gram).view(np.int64) == anchor][0])
                number = (place - np.arange(n)) // PART_WINDOWS
                first = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
                end = np.append(first[1:], n) - 1 + min_bytes
                count = len(first)
                yield from batches_of(schema, {
                    "anchor": [anchor] * count, "piece": [piece] * count, "times": [times] * count, "first": pa.array(first, pa.int32()),
                    "p1": pa.array(_mixed(one.of(first, end) + end.astype(np.uint64) - first.astype(np.uint64)).view(np.int64)),
                    "p2": pa.array(two.of(first, end).view(np.int64)),
                    "part": [data[a:b] for a, b in zip(first.tolist(), end.tolist())]})

    return run


WINDOWS = ddl("p1:long p2:long times:long at:int w1:long w2:long")


def _windows(min_bytes: int):
    """A row for each window of each different part, with two hashes of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(WINDOWS)
        for batch in batches:
            for p1, p2, times, data in zip(*(c.to_pylist() for c in batch.columns)):
                array = np.frombuffer(data, dtype=np.uint8)
                at = np.arange(len(data) - min_bytes + 1)
                w1, w2 = Hashes(array).of(at, at + min_bytes), Hashes(255 - array).of(at, at + min_bytes)
                n = len(at)
                yield from batches_of(schema, {
                    "p1": [p1] * n, "p2": [p2] * n, "times": [times] * n, "at": pa.array(at, pa.int32()),
                    "w1": pa.array(w1.view(np.int64)), "w2": pa.array(w2.view(np.int64))})

    return run


def marks_by_count(pieces: DataFrame, min_bytes: int, gram: int) -> DataFrame:
    """Marks of pieces of large anchor groups: equal parts are aggregated, the different ones' windows counted."""
    parts = pieces.mapInArrow(_parts(min_bytes, gram), PARTS)
    different = parts.groupBy("p1", "p2").agg(F.sum("times").alias("times"), F.min("part").alias("part"))
    windows = different.mapInArrow(_windows(min_bytes), WINDOWS)
    often = windows.groupBy("w1", "w2").agg(F.sum("times").alias("all")).where("all > 1").select("w1", "w2")
    hits = windows.join(often, ["w1", "w2"]).groupBy("p1", "p2").agg(F.collect_list("at").alias("at"))
    found = parts.select("anchor", "piece", "first", "p1", "p2").join(hits, ["p1", "p2"])
    marked = found.groupBy("anchor", "piece").agg(F.collect_list(F.struct("first", "at")).alias("runs"))

    @F.arrow_udf("binary")
    def bitmap(runs: pa.Array) -> pa.Array:
        return pa.array([_bitmap([r["first"] + a for r in run for a in r["at"]]) for run in runs.to_pylist()], pa.binary())

    return marked.select("anchor", "piece", bitmap("runs").alias("marks"))


def _bitmap(at: list[int]) -> bytes:
    marks = np.zeros(max(at) + 1, dtype=np.uint8)
    marks[at] = 1
    return np.packbits(marks).tobytes()


# ------------------------------------------------------------------ the search


def join_texts(source: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """``source`` with each document's list."""
    right = lists.withColumnRenamed("doc_id", "list_id").withColumnRenamed("text_hash", "list_hash")
    same = F.col("text_hash").eqNullSafe(F.col("list_hash")) & F.col("doc_id").eqNullSafe(F.col("list_id"))
    return source.join(right, same, how)


def repeated_runs(source: DataFrame, min_bytes: int = MIN_BYTES, gram: int = GRAM_BYTES) -> DataFrame:
    """Pieces with repeated windows, from ``source(doc_id, text_hash, text)``: place and marks (null: all windows)."""
    pieces = write_shared(source.mapInArrow(_pieces(min_bytes, gram), PIECES), "pieces")
    anchors = pieces.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("piece").alias("low"), F.max("piece").alias("high"))
    # Written before the join, so that both its sides are plain shuffles and a hot anchor's partition can be split.
    several = write_shared(anchors.where("n > 1").select("anchor", F.expr("low <> high").alias("mixed")), "several")
    found = write_shared(pieces.join(several, "anchor"), "candidates")
    equal = found.where("NOT mixed").select("doc_id", "text_hash", "start", "windows", F.lit(None).cast("binary").alias("marks"))

    place = F.struct("doc_id", "text_hash", "start", "windows")
    different = found.where("mixed").groupBy("anchor", "piece").agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("place"))
    wanted = write_shared(different.select("place.*", "anchor", "piece", "times"), "different")
    lists = wanted.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("anchor", "piece", "times", "start", "windows")).alias("wanted"))
    texts = join_texts(source, lists, "inner").select("text", "wanted").mapInArrow(_cut(min_bytes), TEXTS)
    large = wanted.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP_LIMIT).select("anchor")
    texts = write_shared(texts, "piece-texts")

    large = write_shared(large, "large")
    sorted_groups = texts.join(large, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor", "piece")
    marks = sorted_groups.mapInArrow(_sort_groups(min_bytes), MARKS)

    by_count = marks_by_count(texts.join(large, "anchor").dropDuplicates(["anchor", "piece"]), min_bytes, gram)
    marks = write_shared(marks.unionByName(by_count), "marks")

    mixed = found.where("mixed").join(marks, ["anchor", "piece"]).select("doc_id", "text_hash", "start", "windows", "marks")
    return equal.unionByName(mixed).distinct()


def spans_of(runs: list, min_bytes: int) -> np.ndarray:
    """Maximal byte runs covered by repeated windows, rows of start and end."""
    starts = []
    for r in runs:
        if r["marks"] is None:
            starts.append(np.arange(r["start"], r["start"] + r["windows"]))
        else:
            bits = np.unpackbits(np.frombuffer(r["marks"], dtype=np.uint8), count=None)[:r["windows"]]
            starts.append(r["start"] + np.flatnonzero(bits))
    at = np.unique(np.concatenate(starts))
    cut = np.flatnonzero(np.diff(at) > min_bytes)
    return np.stack([at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)] + min_bytes], axis=1)


REMOVED = ddl("doc_id:long n_bytes:long n_removed:long n_spans:long kept_sha256:string span_starts:longs span_ends:longs kept:binary")


def _remove(min_bytes: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(REMOVED)
        for batch in batches:
            columns: dict[str, list] = {f.name: [] for f in schema}
            size = 0
            for doc_id, text, runs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                text, runs = text.as_py(), runs.as_py()
                spans = spans_of(runs, min_bytes).tolist() if runs else []
                kept, at = [], 0
                for a, b in spans:
                    kept.append(text[at:a])
                    at = b
                kept = b"".join([*kept, text[at:]])
                values = (doc_id, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                          [a for a, _ in spans], [b for _, b in spans], kept if with_text else None)
                for name, value in zip(columns, values):
                    columns[name].append(value)
                size += len(kept) if with_text else 0
                if size > 16 << 20:
                    yield from batches_of(schema, columns)
                    columns, size = {f.name: [] for f in schema}, 0
            yield from batches_of(schema, columns)
        return_memory()

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES,
                   gram: int = GRAM_BYTES, with_text: bool = True) -> DataFrame:
    """One row per document: its bytes, what was removed, the removed spans and the bytes kept."""
    if not 0 < gram <= min_bytes or min_bytes % 8:
        raise ValueError("the window must be a multiple of 8 bytes and not shorter than the gram")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"))
    source = source.withColumn("text_hash", F.xxhash64("text"))
    runs = write_shared(repeated_runs(source.select("doc_id", "text_hash", "text"), min_bytes, gram), "runs")
    lists = runs.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "windows", "marks")).alias("runs"))
    joined = join_texts(source, lists, "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(_remove(min_bytes, with_text), REMOVED)

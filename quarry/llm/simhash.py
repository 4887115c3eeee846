"""SimHash near-duplicates with Golay-code fuzzy keys.

A document's fingerprint has a bit set where over half of its shingles' hashes
have it.  Two fingerprints link when at most ``max_bits`` = 2 bits differ.

The 64 bits are cut into three segments (22, 21 and 21 bits).  Of three
segments, two errors leave one without error and another with at most one
(pigeonhole); going round the segments, one of the pairs (1, 2), (2, 3),
(3, 1) has its first segment exact and its second with at most one error.  A
segment, filled up to 23 bits, is decoded by the perfect binary Golay code:
every word has one codeword within distance 3, so a word one bit away has that
codeword within distance 4.  A fingerprint therefore gets a key for each pair
and each codeword within distance 4 of the second segment (one or six of
them): the pair, the first segment, and the codeword's index.  Linked
fingerprints share a key; candidates of a key are verified by their distance.

Only distinct fingerprints are keyed, so copies meet once.  A key with more
than ``group_limit`` distinct fingerprints is not compared pair by pair: its
fingerprints are expanded to themselves and their 64 one-bit changes, and all
that share one of these are linked to the smallest, which finds every link
between them (both lie within one bit of it).

Defined results: null and empty texts and texts of white space have
fingerprint zero; repeated rows share a fingerprint; an empty table gives no
rows; rows without a document id belong to their group but give it no id;
other columns are not read.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import arrow_schema, batches_of, ddl, fresh_name, utf8, write_shared
from quarry.llm.graph import components

SHINGLE_WORDS = 3
MAX_BITS = 2
HASH_SEED = 42
GROUP_LIMIT = 64
HASH_BLOCK = 1 << 16          # shingles counted at a time

# The binary Golay code of length 23.
GOLAY_LENGTH, GOLAY_BITS = 23, 12
GOLAY_GENERATOR = 0b110001110101
SEGMENTS = [(0, 22), (22, 21), (43, 21)]
SEGMENT_PAIRS = [(0, 1), (1, 2), (2, 0)]


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one text as an unsigned number."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, HASH_BLOCK):
        stop = min(n, at + HASH_BLOCK)
        runs = [words[at + k:stop + k] for k in range(shingle_words)] if n > 1 or len(words) == shingle_words else None
        shingles = map(b" ".join, zip(*runs)) if runs else [b" ".join(words)]
        hashes = np.array([xxhash.xxh64_intdigest(s, HASH_SEED) for s in shingles], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, into: str, text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with the fingerprint's bits as a signed long."""

    @F.arrow_udf(T.LongType())
    def printed(texts: pa.Array) -> pa.Array:
        bits = [fingerprint(t.as_py(), shingle_words) for t in texts]
        return pa.array(np.array(bits, dtype=np.uint64).view(np.int64))

    return docs.withColumn(into, printed(utf8(text_col)))


@functools.lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome, the error patterns of weight at most 4 (-1 fills up); and the syndrome of each single bit."""
    check = GOLAY_LENGTH - GOLAY_BITS

    def syndrome(word: int) -> int:
        for k in range(GOLAY_LENGTH - 1, check - 1, -1):
            if word >> k & 1:
                word ^= GOLAY_GENERATOR << (k - check)
        return word

    single = np.array([syndrome(1 << k) for k in range(GOLAY_LENGTH)], dtype=np.int64)
    by_syndrome: list[list[int]] = [[] for _ in range(1 << check)]
    for weight in range(5):
        for bits in itertools.combinations(range(GOLAY_LENGTH), weight):
            s = 0
            for b in bits:
                s ^= int(single[b])
            by_syndrome[s].append(sum(1 << b for b in bits))
    table = np.full((1 << check, max(map(len, by_syndrome))), -1, dtype=np.int64)
    for s, patterns in enumerate(by_syndrome):
        table[s, :len(patterns)] = patterns
    return table, single


def codeword_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the codewords within distance 4 of each 23-bit word, and a mask of the valid ones."""
    table, single = golay_tables()
    syndromes = np.zeros(len(words), dtype=np.int64)
    for k in range(GOLAY_LENGTH):
        syndromes ^= np.where(words >> k & 1, single[k], 0)
    patterns = table[syndromes]
    # The code is systematic in its upper bits, which number the codewords.
    return (words[:, None] ^ np.maximum(patterns, 0)) >> (GOLAY_LENGTH - GOLAY_BITS), patterns >= 0


def fuzzy_keys(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of fingerprints (uint64), and which fingerprint each belongs to."""
    segments = [(bits >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    keys, owners = [], []
    for pair, (exact, fuzzy) in enumerate(SEGMENT_PAIRS):
        indices, valid = codeword_indices(segments[fuzzy])
        row, _ = np.nonzero(valid)
        keys.append((pair << 40) | (segments[exact][row] << GOLAY_BITS) | indices[valid])
        owners.append(row)
    return np.concatenate(keys), np.concatenate(owners)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(ddl("key:long bits:long"))
    for batch in batches:
        bits = batch.column(0).to_numpy(zero_copy_only=False)
        keys, owners = fuzzy_keys(bits.view(np.uint64))
        yield from batches_of(schema, {"key": pa.array(keys), "bits": pa.array(bits[owners])})


def links(distinct_bits: DataFrame, max_bits: int = MAX_BITS, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints (column ``bits``) that keep all links' components.

    Every pair within ``max_bits`` (at most 2) is joined directly or through a
    common partner that is within ``max_bits`` of both.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the segment keys hold for at most 2 differing bits")
    keyed = distinct_bits.select("bits").mapInArrow(_keys, ddl("key:long bits:long"))
    # Written before the join, so that both its sides are plain shuffles and a hot key's partition can be split.
    sizes = write_shared(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "key-sizes")
    grouped = write_shared(keyed.join(sizes, "key"), "simhash-keys")

    few = grouped.where(F.col("n") <= group_limit)
    pairs = (
        few.alias("x").join(few.alias("y"), F.expr(f"x.key = y.key AND x.bits < y.bits AND bit_count(x.bits ^ y.bits) <= {max_bits}"))
        .select(F.col("x.bits").alias("a"), F.col("y.bits").alias("b")).distinct()
    )
    many = grouped.where(F.col("n") > group_limit).select("bits").distinct()
    if max_bits == 0:
        return pairs
    # Two bits: all around a common word one bit away.  One bit: a fingerprint and its neighbours.
    flips = "transform(sequence(0, 63), i -> bits ^ shiftleft(1L, i))"
    spread = many.select(F.explode(F.expr(f"concat(array(bits), {flips})")).alias("near"), "bits")
    if max_bits == 1:
        stars = spread.join(many.select(F.col("bits").alias("near")), "near").where("near < bits").select(
            F.col("near").alias("a"), F.col("bits").alias("b"))
        return pairs.unionAll(stars)
    least = spread.groupBy("near").agg(F.min("bits").alias("a"), F.max("bits").alias("top")).where("a != top")
    stars = spread.join(write_shared(least.select("near", "a"), "stars"), "near").where("a != bits").select("a", F.col("bits").alias("b")).distinct()
    return pairs.unionAll(stars)


def cluster(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(bits, root)`` for every distinct fingerprint in ``prints(bits, ...)``."""
    distinct = prints.select("bits").distinct()
    found = components(links(distinct, max_bits)).withColumnRenamed("node", "bits")
    return distinct.join(found, "bits", "left").select("bits", F.coalesce("root", "bits").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: id, fingerprint in hexadecimal, smallest id of its component."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    prints = write_shared(with_fingerprint(source, "bits", "text", shingle_words).select("doc_id", "bits"), "fingerprints")
    first = prints.groupBy("bits").agg(F.min("doc_id").alias("least_id"))
    labelled = write_shared(cluster(prints, max_bits).join(first, "bits"), "labels")
    ids = labelled.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = labelled.join(ids, "root").select("bits", "component_id")
    return prints.join(named, "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The columns of ``docs`` with one row of each component: that of the smallest id, rows without id last."""
    row, bits = fresh_name(docs.columns, "row_no"), fresh_name(docs.columns, "bits")
    numbered = with_fingerprint(docs, bits, text_col, shingle_words).withColumn(row, F.monotonically_increasing_id())
    table = write_shared(numbered, "numbered")
    prints = table.select(F.col(bits).alias("bits"), F.struct(
        F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(row).alias("row")).alias("rank"))
    first = prints.groupBy("bits").agg(F.min("rank").alias("rank"))
    kept = cluster(prints, max_bits).join(first, "bits").groupBy("root").agg(F.min("rank").alias("rank"))
    rows = kept.select(F.col("rank.row").alias(row))
    return table.join(rows, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])

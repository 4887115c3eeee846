"""Cross-tokenizer alignment: where two tokenizations of one text cut it at the same byte.

Vocabulary A is a byte-level BPE (a ``tokenizers`` file), vocabulary B a
sentencepiece model.  A reads a blank and the text, B the text, to which it
adds the blank itself, so both cover the same bytes.  Each token has a length
in bytes, so a document is two ascending lists of end offsets, and the common
ends cut both token lists into groups that cover equal bytes.

Common ends are found by a galloping intersection.  The shorter list drives:
an end is looked for behind the place of the one before it by doubling the step
until the other list has passed it, then by binary search within the last
step.  All ends of a chunk of documents (offsets of a document follow
those before it, so a chunk is one pair of lists) gallop in lockstep: first
every ``RUN``-th end, from the place of the head before it, then the ends
between two heads, which start at the first head's place.  The ranks of the
common ends in both lists slice the groups, and a group's rank differences are
the numbers of its A and B tokens.

Links are the pairs of an A token and a B token that end together.  How many
links of the corpus hold a pair of ids, and the highest such number for a B
id, are corpus statistics that no task could hold.  Links are written once as
numbers into a dictionary of their chunk (at most ``CHUNK_LINKS`` links, a
longer document is cut over several chunks).  Dictionaries are summed to
corpus counts, joined back, and each chunk meets its own dictionary again;
what crosses the shuffles is distinct pairs of chunks, not links.

Defined results: null and empty texts have no tokens and zeros, as have texts
whose tokens do not spell the blank and the text (a vocabulary may normalise);
strings of special tokens are plain text; whole texts are read at any length;
repeated rows count each time and an id of null stays; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_schema, clean_text, ddl, text_chunks, write_shared
from quarry.llm.wordcache import byte_level_table

CHUNK_LINKS = 400_000        # links that share a dictionary, at most
TEXT_CHUNK = 1 << 20         # bytes of texts aligned at a time; a longer text comes alone
RUN = 16                     # ends between two heads of the galloping search
#: The fast encoder's pattern backtracks over a run of white space; texts with longer runs go to the other library.
BLANK_RUN = re.compile(r"(?<!\s)\s{4096}")
#: How byte-level BPE splits a text (fixed value of the vocabulary's pre-tokenizer).
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps"]
SEGMENT = ddl("row:long doc_id:long n_a:long n_b:long n_groups:long n_links:long n_overlaps:long groups_sha256:string chunk:long links:ints keys:longs counts:longs")


# --------------------------------------------------------------------------- vocabularies


class ByteLevel:
    """Vocabulary A: ``encode(text)`` and the bytes of each id.

    Where an id is its merge's rank, as usual, ids come from a rank encoder
    over the same entries; else from the vocabulary's own library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        vocab = made["model"]["vocab"]
        back = {chr(c): b for b, c in byte_level_table().items()} | {chr(b): b for b in range(256) if b not in byte_level_table()}
        pieces = {i: bytes(back[c] for c in entry) for entry, i in vocab.items()
                  if all(c in back for c in entry)}
        added = {t["id"]: t["content"].encode() for t in made.get("added_tokens", [])}
        self.table = [added.get(i) or pieces.get(i, b"") for i in range(max([*pieces, *added], default=-1) + 1)]
        self.fast = self._ranked(made, vocab, {b: i for i, b in pieces.items() if i not in added})

    @staticmethod
    def _ranked(made: dict, vocab: dict, ranks: dict):
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in made["model"]["merges"]]
        singles = sum(len(b) == 1 for b in ranks)
        pre = made.get("pre_tokenizer") or {}
        plain = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                 and not made.get("normalizer") and not made["model"].get("ignore_merges"))
        if not plain or singles != 256 or any(vocab.get(a + b) != 256 + k for k, (a, b) in enumerate(merges)):
            return None
        import tiktoken

        return tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.fast is None or BLANK_RUN.search(text):
            return self.library.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class Pieces:
    """Vocabulary B: ``encode(texts)`` and the bytes of each id."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.table = [bytes([int(n[3:5], 16)]) if re.fullmatch("<0x[0-9A-Fa-f]{2}>", n) else n.replace("▁", " ").encode() for n in names]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@functools.lru_cache(maxsize=1)
def vocabularies(path_a: str, path_b: str) -> tuple[ByteLevel, Pieces, np.ndarray, np.ndarray]:
    """The worker's vocabularies and the byte lengths of their ids."""
    a, b = ByteLevel(path_a), Pieces(path_b)
    return a, b, np.array([len(x) for x in a.table], dtype=np.int64), np.array([len(x) for x in b.table], dtype=np.int64)


# --------------------------------------------------------------------------- alignment


def gallop(wanted: np.ndarray, start: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each wanted value the first place in ``ends``, from ``start`` on, that is not below it."""
    low, step = start.copy(), np.ones(len(wanted), dtype=np.int64)
    high = np.minimum(low + step, len(ends))
    going = np.flatnonzero((high < len(ends)) & (ends[np.minimum(high, len(ends) - 1)] < wanted))
    while len(going):                                        # exponential: double the step
        low[going] = high[going]
        step[going] *= 2
        high[going] = np.minimum(low[going] + step[going], len(ends))
        at = high[going]
        going = going[(at < len(ends)) & (ends[np.minimum(at, len(ends) - 1)] < wanted[going])]
    going = np.flatnonzero(low < high)
    while len(going):                                        # binary: low <= place <= high
        middle = (low[going] + high[going]) // 2
        below = ends[middle] < wanted[going]
        low[going[below]] = middle[below] + 1
        high[going[~below]] = middle[~below]
        going = going[low[going] < high[going]]
    return low


def places(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each end of the shorter list its place in the longer one, driven by heads, then by the runs between them."""
    if len(short) <= RUN:
        out, at = np.empty(len(short), dtype=np.int64), np.zeros(1, dtype=np.int64)
        for k in range(len(short)):
            out[k:k + 1] = at = gallop(short[k:k + 1], at, long)
        return out
    heads = places(short[::RUN], long)
    return gallop(short, np.repeat(heads, RUN)[:len(short)], long)


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the ends that both ascending lists hold, in either list (of equal ends the last one)."""
    # Tokens without bytes end where the one before them ends: the last of them closes the group.
    last_a = np.flatnonzero(np.append(ends_a[1:] != ends_a[:-1], True)) if len(ends_a) else np.zeros(0, np.int64)
    last_b = np.flatnonzero(np.append(ends_b[1:] != ends_b[:-1], True)) if len(ends_b) else np.zeros(0, np.int64)
    a, b = ends_a[last_a], ends_b[last_b]
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    turned = len(a) > len(b)
    short, long = (b, a) if turned else (a, b)
    at = places(short, long)
    hit = np.flatnonzero((at < len(long)) & (long[np.minimum(at, len(long) - 1)] == short))
    found, other = (at[hit], hit) if turned else (hit, at[hit])
    return last_a[found], last_b[other]


def overlap_ranges(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each A token the first B token that shares a byte with it, and how many do (differences of ranks)."""
    begins = np.concatenate([[0], ends_a[:-1]]) if len(ends_a) else ends_a
    first = np.searchsorted(ends_b, begins, side="right")
    behind = np.searchsorted(ends_b, ends_a, side="left") + 1
    return first, np.where(ends_a > begins, behind - first, 0)


def groups_text(ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: the ids of each group, from the last token of each group in both lists."""
    n_a, n_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
    before_a, before_b = np.repeat(np.concatenate([[0], n_b.cumsum()[:-1]]), n_a), np.repeat(n_a.cumsum(), n_b)
    place_a, place_b = np.arange(len(ids_a)) + before_a, np.arange(len(ids_b)) + before_b
    marks = np.zeros(len(ids_a) + len(ids_b), dtype=np.int64)          # 0 ',', 1 '|', 2 ';'
    marks[place_a[cut_a]] = 1
    marks[place_b[cut_b]] = 2
    ids = np.empty(len(marks), dtype=np.int64)
    ids[place_a], ids[place_b] = ids_a, ids_b
    words = _decimal(int(ids.max()) + 1)
    return b"".join(map(words.__getitem__, (ids * 3 + marks).tolist()))[:-1]


@functools.lru_cache(maxsize=4)
def _decimals(size: int) -> list[bytes]:
    return [b"%d%s" % (i, mark) for i in range(size) for mark in (b",", b"|", b";")]


def _decimal(least: int) -> list[bytes]:
    """Ids with each mark behind them, for at least this many ids."""
    return _decimals(1 << max(16, (least - 1).bit_length()))


def aligned(texts: list[str], path_a: str, path_b: str) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each text that both vocabularies spell: its number, the ids, and each group's last A and B token."""
    a, b, len_a, len_b = vocabularies(path_a, path_b)
    numbers, all_a, all_b = [], [], []
    wanted = [i for i, t in enumerate(texts) if t]
    for i, of_b in zip(wanted, b.encode([texts[i] for i in wanted])):
        spelled = " " + texts[i]
        of_a, whole = a.encode(spelled), spelled.encode("utf-8", "replace")
        if b"".join(map(a.table.__getitem__, of_a)) == whole and b"".join(map(b.table.__getitem__, of_b)) == whole:
            numbers.append(i)
            all_a.append(np.array(of_a, dtype=np.int64))
            all_b.append(np.array(of_b, dtype=np.int64))
    if not numbers:
        return
    ids_a, ids_b = np.concatenate(all_a), np.concatenate(all_b)
    cut_a, cut_b = common_ends(len_a[ids_a].cumsum(), len_b[ids_b].cumsum())
    from_a, from_b = np.cumsum([0, *map(len, all_a)]), np.cumsum([0, *map(len, all_b)])
    # A document's end is a common end, so a group never reaches into the next document.
    behind = np.searchsorted(cut_a, from_a)
    for k, i in enumerate(numbers):
        mine = slice(behind[k], behind[k + 1])
        yield i, all_a[k], all_b[k], cut_a[mine] - from_a[k], cut_b[mine] - from_b[k]


# --------------------------------------------------------------------------- corpus


class _Chunk:
    """Links of some documents as numbers into the dictionary of their distinct pairs."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.keys: list[np.ndarray] = []
        self.rows: list[tuple] = []

    def add(self, row: tuple, keys: np.ndarray) -> None:
        self.rows.append(row)
        self.keys.append(keys)
        self.size += len(keys)

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        joined = np.concatenate(self.keys) if self.keys else np.zeros(0, np.int64)
        keys, place, counts = np.unique(joined, return_inverse=True, return_counts=True)
        offsets = np.cumsum([0, *map(len, self.keys), 0]).astype(np.int32)
        names = ["row", "doc_id", *COUNTS, "groups_sha256"]
        columns = list(zip(*self.rows)) if self.rows else [()] * len(names)
        none = [0] * len(self.rows)
        arrays = [pa.array([*c, None], schema.field(n).type) for c, n in zip(columns, names)]
        arrays.append(pa.array([self.number] * (len(self.rows) + 1), pa.int64()))
        arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(place.astype(np.int32))).cast(schema.field("links").type))
        for values in (keys, counts):
            own = pa.array(np.array([*none, 0, len(values)], dtype=np.int32))
            arrays.append(pa.ListArray.from_arrays(own, pa.array(values.astype(np.int64))).cast(schema.field("keys").type))
        return pa.RecordBatch.from_arrays(arrays, schema=schema)


def encode_corpus(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Both tokenizations of every text, aligned: a row per document (a long one: per chunk) and one per chunk.

    ``chunk`` names the chunk; a document's row holds its ``links`` as places
    in the chunk's dictionary, and the row without ``row`` holds that
    dictionary: ``keys`` (A id times 2^32 plus B id) and ``counts``.
    """
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), clean_text(text_col).alias("text"))
    limit = CHUNK_LINKS
    packed = source.select(F.struct("row", "doc_id").alias("at"), "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema = arrow_schema(SEGMENT)
        number = TaskContext.get().partitionId() << 32
        chunk = _Chunk(number)
        for ids, texts in text_chunks(batches, TEXT_CHUNK):
            found = {i: rest for i, *rest in aligned(texts, path_a, path_b)}
            for i, at in enumerate(ids):
                row = (at["row"], at["doc_id"])
                if i not in found:
                    chunk.add((*row, 0, 0, 0, 0, 0, ""), np.zeros(0, np.int64))
                    continue
                of_a, of_b, cut_a, cut_b = found[i]
                keys = (of_a[cut_a] << 32) | of_b[cut_b]
                sha = hashlib.sha256(groups_text(of_a, of_b, cut_a, cut_b)).hexdigest()
                # Without a common end inside it, a group of p and q tokens has p + q - 1 pairs that share a byte.
                overlaps = int((np.diff(cut_a, prepend=-1) + np.diff(cut_b, prepend=-1) - 1).sum())
                meta = (*row, len(of_a), len(of_b), len(cut_a), len(keys), overlaps, sha)
                for k in range(0, len(keys), limit):
                    chunk.add(meta, keys[k:k + limit])
                    if chunk.size >= limit:
                        yield chunk.batch(schema)
                        number += 1
                        chunk = _Chunk(number)
            if len(chunk.rows) >= limit:
                yield chunk.batch(schema)
                number += 1
                chunk = _Chunk(number)
        if chunk.rows:
            yield chunk.batch(schema)

    return packed.mapInArrow(encode, SEGMENT)


def pair_counts(segments: DataFrame) -> DataFrame:
    """``(key, count, best)``: links of the corpus with a pair of ids, and whether no pair of its B id has more."""
    each = segments.where("row IS NULL").select(F.inline(F.arrays_zip("keys", "counts")))
    counted = write_shared(each.groupBy(F.col("keys").alias("key")).agg(F.sum("counts").alias("count")), "pairs")
    highest = counted.groupBy(F.expr("key & 4294967295").alias("b")).agg(F.max("count").alias("most"))
    best = counted.withColumn("b", F.expr("key & 4294967295")).join(highest, "b")
    return best.select("key", "count", (F.col("count") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_overlaps, n_best, count_sum, groups_sha256``.

    ``n_best`` counts the links whose pair is the most frequent of its B id in
    the corpus (ties included); ``count_sum`` adds up the corpus counts of the
    links' pairs.
    """
    segments = write_shared(encode_corpus(docs, path_a, path_b, id_col, text_col), "aligned")
    pairs = write_shared(pair_counts(segments), "pair-counts")
    entries = segments.where("row IS NULL").select("chunk", F.posexplode("keys").alias("place", "key"))
    known = entries.join(pairs, "key").select(F.col("chunk").alias("of_chunk"), "place", "count", "best")
    linked = segments.where("row IS NOT NULL AND size(links) > 0").select("chunk", "row", "links")
    sums = ddl("row:long n_best:long count_sum:long")

    def look_up(_key: tuple, links: pa.Table, dictionary: pa.Table) -> pa.Table:
        schema = arrow_schema(sums)
        if not links.num_rows:
            return schema.empty_table()
        place = dictionary["place"].to_numpy()
        counts, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        counts[place], best[place] = dictionary["count"].to_numpy(), dictionary["best"].to_numpy(zero_copy_only=False)
        lists = links["links"].combine_chunks()
        at, offsets = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        return pa.table({"row": links["row"], "n_best": pa.array(np.add.reduceat(best[at], offsets[:-1])),
                         "count_sum": pa.array(np.add.reduceat(counts[at], offsets[:-1]))}, schema=schema)

    found = linked.groupBy("chunk").cogroup(known.groupBy("of_chunk")).applyInArrow(look_up, sums)
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    whole = segments.where("row IS NOT NULL").select(
        "row", "doc_id", *COUNTS, "groups_sha256", zero.alias("n_best"), zero.alias("count_sum"))
    parts = found.select("row", *[none.alias(c) for c in ("doc_id", *COUNTS)], none.cast("string").alias("groups_sha256"), "n_best", "count_sum")
    # Every document has one row of each chunk that holds a part of it, and one of sums for each.
    result = whole.unionByName(parts).groupBy("row").agg(
        *[F.max(c).alias(c) for c in ("doc_id", *COUNTS)], F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"),
        F.max("groups_sha256").alias("groups_sha256"))
    return result.drop("row")


def token_groups(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The alignment itself, a row per document.

    ``ids_a``, ``ids_b``: the tokens; ``cuts_a``, ``cuts_b``: each group's last
    token in either list; ``first_b``, ``n_b``: for each A token the first B
    token that shares a byte with it, and how many do.  All are empty where a
    document has no tokens.
    """
    result = ddl("doc_id:long ids_a:ints ids_b:ints cuts_a:ints cuts_b:ints first_b:ints n_b:ints")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(result)
        for ids, texts in text_chunks(batches, TEXT_CHUNK):
            rows: list[list] = [[i, [], [], [], [], [], []] for i in ids]
            for i, of_a, of_b, cut_a, cut_b in aligned(texts, path_a, path_b):
                _, _, len_a, len_b = vocabularies(path_a, path_b)
                first, many = overlap_ranges(len_a[of_a].cumsum(), len_b[of_b].cumsum())
                rows[i][1:] = (x.tolist() for x in (of_a, of_b, cut_a, cut_b, first, many))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), clean_text(text_col).alias("text")).mapInArrow(each, result)

"""Packing: every id in one piece, gapless sequences, checksums of the real ids."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from quarry.llm import packing
from quarry.llm.wordcache import word_end_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


TOKENIZER = Tokenizer.from_file(PATH)


def expected_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, texts_by_row):
    by_seq = defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append(r)
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    want, got = [], []
    for doc_id, text in texts_by_row:
        want.append((doc_id, expected_ids(text)))
    total = sum(len(x) for _, x in want)
    assert sum(r.length for r in rows) == total
    assert padding <= 0.01 * total
    return by_seq, want


def test_word_ids_are_those_of_the_whole_text(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts += ["Straße ÉTÉ e\u0301te\u0301 ﬁne ǅabc İstanbul ΣΑΣ ʼn don't I'LL a'b 3rd x² ½ ªº µm ĳ ŉ"]
    cache = word_end_ids(PATH)
    for text in texts:
        words = text.encode().lower().split()
        table = cache.table([words])
        assert np.frombuffer(b"".join(table[w] for w in words), dtype="<u4").tolist() == expected_ids(text)[:-1]


def test_pack_rebuilds_every_document(docs_frame):
    texts = [(1, "Hello, world! <|endoftext|> don't"), (2, None), (3, ""), (4, "x" * 5000 + " café Ünï. 12,5"),
             (5, "word " * 9000), (None, "null id"), (7, "a b c"), (8, "tail.,!? ...!")]
    texts += [(100 + i, "alpha beta. " * (i % 37)) for i in range(300)]
    rows = packing.pack(docs_frame(texts, extra=("ids", "offset")), PATH).collect()
    check(rows, texts)
    parts = defaultdict(list)
    for r in rows:
        parts[r.doc_id].append(r)
    for doc_id, text in texts:
        pieces = sorted(parts[doc_id], key=lambda r: r.start)
        ids = np.frombuffer(b"".join(bytes(p.ids) for p in pieces), dtype="<u4").tolist()
        assert ids == expected_ids(text)
        assert all(p.doc_tokens == len(ids) for p in pieces)


def test_query_on_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = entry.queries()["op6_packing"](spark, sf).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    _, want = check(rows, docs)
    ids = dict(want)
    for r in rows:
        raw = np.asarray(ids[r.doc_id][r.start:r.start + r.length], dtype="<u4").tobytes()
        assert zlib.crc32(raw) == r.ids_crc32


def test_repeated_rows_and_empty_table(docs_frame):
    rows = packing.pack(docs_frame([(1, "same text")] * 5), PATH).collect()
    check(rows, [(1, "same text")] * 5)
    assert packing.pack(docs_frame([]), PATH).collect() == []


def test_special_tokens_in_texts_have_their_own_ids(spark, docs_frame):
    plain = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "X<|startoftext|>Y. end", "<|EndOfText|> and <|ENDOFTEXT|>!", "<|endoftext|><|endoftext|>.",
             "<|startoftext|>Don't <|EndOfText|><|endoftext|>É", "< |endoftext|> <|endoftext |>", "None HERE"]
    rows = packing.pack(docs_frame([*enumerate(texts)]), PATH).collect()
    for i, text in enumerate(texts):
        pieces = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        ids = np.frombuffer(b"".join(bytes(p.ids) for p in pieces), dtype="<u4").tolist()
        assert ids == plain.encode(text, add_special_tokens=False).ids + [1], text
    assert plain.encode(texts[0], add_special_tokens=False).ids == [320, 49407, 321]


@pytest.mark.parametrize("windows", [1, 2, 5])
def test_differencing_is_a_partition(windows):
    lengths = [7, 3, 9, 4, 4, 1, 12, 6]
    dealt = packing.difference(lengths, windows)
    assert sorted(k for w in dealt for k in w) == list(range(len(lengths)))
    loads = [sum(lengths[k] for k in w) for w in dealt]
    assert max(loads) - min(loads) <= max(lengths)


@pytest.mark.parametrize("lengths, capacity", [
    ([1500] * 70, 2048), ([1025] * 9 + [3] * 40, 2048), ([1] * 50, 4), ([3] * 30, 4), ([1] * 7, 1), ([2047, 2047, 2], 2048),
    ([(i * 7919) % 2047 + 1 for i in range(200)], 2048), ([5], 8), ([8], 8),
])
def test_window_count_rises_until_whole_pieces_fit(lengths, capacity, monkeypatch):
    counts = []
    plain = packing.difference
    monkeypatch.setattr(packing, "difference", lambda sizes, windows: counts.append(windows) or plain(sizes, windows))
    pieces = [(k, 10 * k, n) for k, n in enumerate(lengths)]
    whole = packing.deal_whole(pieces, capacity)
    assert sorted(p for w in whole for p in w) == pieces                       # none is cut
    assert all(sum(n for _, _, n in w) <= capacity for w in whole)
    assert counts[0] == -(-sum(lengths) // capacity) and counts == sorted(set(counts)) and len(whole) == counts[-1]
    assert (len(counts) > 1) == (max(sum(lengths[k] for k in w) for w in plain_deal(plain, lengths, capacity, counts[0])) > capacity)
    full, rest = packing.fill_windows(pieces, capacity)
    assert all(sum(n for _, _, n in w) == capacity for w in full) and len(full) == sum(lengths) // capacity
    assert sum(n for _, _, n in rest) == sum(lengths) % capacity
    covered = defaultdict(list)
    for key, start, n in [p for w in [*full, rest] for p in w]:
        covered[key] += range(start, start + n)
    assert all(sorted(covered[k]) == list(range(10 * k, 10 * k + n)) for k, n in enumerate(lengths))


def plain_deal(difference, lengths, capacity, windows):
    groups = packing._bundles(lengths, min(packing.BUNDLE_TOKENS, capacity // 2))
    return [[k for g in held for k in groups[g]] for held in difference([sum(lengths[k] for k in g) for g in groups], windows)]


def test_distinct_words_and_their_ids_of_a_chunk():
    """Each distinct word of a chunk is looked up once, special tokens stay as written, long words are not kept."""
    import pyarrow as pa

    from quarry.llm import wordcache

    asked = []
    cache = wordcache.WordCache(lambda ws: asked.append(list(ws)) or [w + b"!" for w in ws], generation_words=4, special=(b"<|end|>",))
    long = b"l" * (wordcache.LONG_WORD_BYTES + 1)
    for texts in ([b"a B  a", b"", b" b c\n", long], [b"x <|END|> <|end|> A<|end|>", b"b"], [b"e f g c", long], [b"a e"]):
        lengths, words, place = cache.distinct(pa.array(texts, pa.binary()))
        want = [cache.words(t) for t in texts]
        assert lengths.tolist() == [len(w) for w in want]
        assert [words[k] for k in place] == [w for ws in want for w in ws] and len(set(words)) == len(words)
        assert cache.values(words) == [w + b"!" for w in words] and long not in cache.young
    made = [w for ws in asked for w in ws if w != long]
    assert len(made) == len(set(made)) or made.count(b"a") <= 2


def test_differencing_of_many_rests_holds_loaded_windows_only():
    """Early merges cost their loaded windows, not all: 3,000 windows' rests are dealt at once, each in one window."""
    import time

    lengths = [1 + 37 * k % 1500 for k in range(6000)]
    begun = time.process_time()
    dealt = packing.difference(lengths, 3000)
    assert time.process_time() - begun < 5
    assert sorted(k for w in dealt for k in w) == list(range(6000)) and len(dealt) == 3000
    loads = [sum(lengths[k] for k in w) for w in dealt]
    assert max(loads) - min(loads) < 40

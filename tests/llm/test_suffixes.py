"""Suffix-array dedup against brute force on small windows and on a table."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from quarry.llm import suffixes


def brute(docs, size):
    texts = [(t or "").encode() for _, t in docs]
    seen = Counter(t[i:i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for (i, _), t in zip(docs, texts):
        gone = bytearray(len(t))
        for at in range(len(t) - size + 1):
            if seen[t[at:at + size]] > 1:
                gone[at:at + size] = b"\1" * size
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


@settings(max_examples=150, deadline=None)
@given(st.binary(min_size=1, max_size=200) | st.lists(st.sampled_from([b"a", b"ab", b"abc", b"\0", b"zz"]), min_size=1, max_size=80).map(b"".join))
def test_suffix_array_and_prefixes(data):
    array = np.frombuffer(data, dtype=np.uint8)
    depth = 16
    order = suffixes.suffix_array(array, depth).tolist()
    padded = data + bytes(depth)
    keys = [padded[i:i + depth] for i in order]
    assert sorted(order) == list(range(len(data))) and keys == sorted(keys)
    got = suffixes.common_prefixes(array, np.array(order), depth).tolist()
    want = [0] + [next((k for k in range(depth) if a[k] != b[k]), depth) for a, b in zip(keys, keys[1:])]
    assert got == want


def synthetic(seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcde é") for _ in range(rng.randint(20, 90))) for _ in range(6)]
    docs = []
    for i in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 60)))
                 for _ in range(rng.randint(0, 5))]
        docs.append((i, "".join(parts)))
    docs += [(100, None), (101, ""), (102, "x" * 500), (103, "xy" * 200), (104, docs[3][1]), (None, docs[4][1]), (7, docs[7][1]), (7, docs[7][1])]
    return docs


@pytest.mark.parametrize("group_limit", [1, 2048])
@pytest.mark.parametrize("seed", [1, 2])
def test_small_windows(docs_frame, monkeypatch, seed, group_limit):
    monkeypatch.setattr(suffixes, "GROUP_LIMIT", group_limit)
    docs = synthetic(seed)
    got = suffixes.remove_repeats(docs_frame(docs, extra=("start", "text_hash")), min_bytes=32, gram=12)
    assert rows_of(got) == brute(docs, 32)


def test_long_texts_are_cut_into_segments(docs_frame, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", 150)
    docs = synthetic(3) + [(200, "".join(t for _, t in synthetic(3)[:10]))]
    assert rows_of(suffixes.remove_repeats(docs_frame(docs), min_bytes=32, gram=12)) == brute(docs, 32)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert rows_of(entry.queries()["op2_suffix_dedup"](spark, sf)) == brute(docs, 200)


def test_empty_table_and_kept_bytes(docs_frame):
    assert suffixes.remove_repeats(docs_frame([])).collect() == []
    same = "0123456789abcdef" * 20
    rows = suffixes.remove_repeats(docs_frame([(1, "head " + same + " tail"), (2, same)])).collect()
    by = {r.doc_id: r for r in rows}
    assert bytes(by[1].kept) == b"head  tail" and by[1].span_starts == [5] and by[1].span_ends == [325]


def test_memory_of_pieces_is_bounded():
    """Many texts are hashed a few at a time: over 16 MB of them no more than 100 MB are held at once."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(6)
    texts = [bytes(rng.integers(97, 123, size=4000, dtype=np.uint8)) for _ in range(4000)]
    batch = pa.record_batch([pa.array(range(4000)), pa.array(range(4000)), pa.array(texts, pa.binary())], names=["doc_id", "text_hash", "text"])
    tracemalloc.start()
    try:
        windows = sum(sum(b.column("windows").to_pylist()) for b in suffixes._pieces(200, 40)(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert windows == 4000 * 3801
    assert peak < 100 << 20

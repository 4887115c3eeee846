"""SimHash: fingerprints and components against brute force; the keys reach every pair within two bits."""

import random
import re

import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
from quarry.llm import simhash
from quarry.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids_bits):
    """Smallest id reachable, by plain search over distinct fingerprints."""
    bits = sorted({b for _, b in ids_bits})
    array = np.array(bits, dtype=np.uint64)
    parent = list(range(len(bits)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(bits)):
        for j in np.flatnonzero(np.bitwise_count(array[i + 1:] ^ array[i]) <= 2) + i + 1:
            parent[find(int(j))] = find(i)
    at = {b: find(i) for i, b in enumerate(bits)}
    least = {}
    for i, b in ids_bits:
        if i is not None:
            least[at[b]] = min(least.get(at[b], i), i)
    return {b: least.get(at[b]) for _, b in ids_bits}


def check(rows, docs):
    prints = [(i, plain_fingerprint(t)) for i, t in docs]
    comp = brute_components(prints)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in rows), key=str) == sorted(
        ((i, f"{b:016x}", comp[b]) for i, b in prints), key=str)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(entry.queries()["op5_simhash"](spark, sf).collect(), docs)


def test_edges(docs_frame):
    docs = [(5, None), (3, ""), (9, " \n"), (None, ""), (1, "One two"), (1, "one TWO"), (7, "É é"), (8, "é é"), (2, "w " * 70000),
            (None, "only row without an id at all")]
    check(simhash.near_duplicates(docs_frame(docs, extra=("bits", "root"))).collect(), docs)
    assert simhash.near_duplicates(docs_frame([])).collect() == []


def test_every_pair_within_two_bits_shares_a_key():
    rng = random.Random(3)
    base = np.array([rng.getrandbits(64) for _ in range(40)], dtype=np.uint64)
    for _ in range(200):
        a, b = rng.sample(range(64), 2)
        other = base ^ np.uint64(1 << a) ^ np.uint64(1 << b if rng.random() < 0.8 else 0)
        (k1, o1), (k2, o2) = simhash.fuzzy_keys(base), simhash.fuzzy_keys(other)
        for i in range(len(base)):
            assert set(k1[o1 == i].tolist()) & set(k2[o2 == i].tolist())


def test_golay_code_is_perfect():
    table, _ = simhash.golay_tables()
    weights = np.where(table >= 0, np.bitwise_count(np.maximum(table, 0)), 99)
    assert ((weights <= 3).sum(axis=1) == 1).all()
    assert sorted(set((table >= 0).sum(axis=1).tolist())) == [1, 6]


@pytest.mark.parametrize("group_limit", [2, 64])
@pytest.mark.parametrize("max_bits", [0, 1, 2])
def test_components_of_dense_groups(spark, group_limit, max_bits):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(6)]
    bits = set(centres)
    for c in centres:
        for _ in range(120):
            word = c
            for _ in range(rng.randint(1, 5)):
                word ^= 1 << rng.randrange(64)
            bits.add(word)
    bits = sorted(bits)
    signed = np.array(bits, dtype=np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(b,) for b in signed], "bits long")
    found = {r.node: r.root for r in components(simhash.links(frame, max_bits, group_limit)).collect()}
    array = np.array(bits, dtype=np.uint64)
    label = list(range(len(bits)))
    changed = True
    while changed:
        changed = False
        for i in range(len(bits)):
            near = np.flatnonzero(np.bitwise_count(array ^ array[i]) <= max_bits)
            low = min(label[j] for j in near)
            for j in near:
                if label[j] != low:
                    label[j], changed = low, True
    groups = {}
    for i, s in enumerate(signed):
        groups.setdefault(found.get(s, s), set()).add(label[i])
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len(set(label))


def test_keep_first(docs_frame):
    docs = docs_frame([(4, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (9, ""), (None, None), (None, "lonely text here")], extra=("row_no", "bits"))
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id) == [(2, "a b c d e"), (9, "")]
    assert kept.count() == 3

"""Language model: base score against plain code, the recursion against enumeration, and held-out gain."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from quarry.llm import hmm

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain(docs):
    tokens = [(i, [w.lower() for w in WORD.findall((t or "").encode())]) for i, t in docs]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in docs]
    c, end = Counter(), 0
    for (_, ws), h in zip(tokens, held):
        if not h:
            c.update(ws)
            end += 1
    n, v = sum(c.values()) + end, len(c) + (end > 0)
    out = []
    for (i, ws), h in zip(tokens, held):
        counts = [c[w] for w in ws] + [end]
        out.append((i, h, len(counts), sum(x > 0 for x in counts), n, sum(math.log10((x + 1) / (n + v + 1)) for x in counts)))
    return out


def check(rows, docs):
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows), key=lambda r: (str(r[0]), r[2]))
    want = sorted(plain(docs), key=lambda r: (str(r[0]), r[2]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)


def test_query_and_held_out_gain(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = entry.queries()["op3_hmm_score"](spark, sf).collect()
    check(rows, docs)
    held = [r for r in rows if r.held_out]
    tokens = sum(r.n_tokens for r in held)
    gain = (sum(r.score for r in held) - sum(r.base_score for r in held)) / tokens
    print("held-out log10 gain per token", gain)
    assert gain > 0.02


@pytest.mark.parametrize("own", [0, 2, 100])
def test_edges_with_any_cut(spark, docs_frame, monkeypatch, own):
    monkeypatch.setattr(hmm, "OWN_SYMBOLS", own)
    docs = [(1, None), (2, ""), (None, "a b"), (3, "A a b É é \x1c c"), (3, "A a b É é \x1c c"), (16, "new words only here"), (5, "w " * 60000), (6, " \t\n"), (7, "y" * 3000 + " a b")]
    docs += [(i, f"common words and rare{i} words") for i in range(20, 60)]
    rows = hmm.score(docs_frame(docs, extra=("held_out", "row")), passes=2).collect()
    check(rows, docs)
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


def test_empty_and_untrained(spark, docs_frame):
    assert hmm.score(docs_frame([])).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    rows = hmm.score(docs_frame([(held, "some text")])).collect()
    check(rows, [(held, "some text")])


def random_model(symbols, states, seed=0):
    rng = np.random.default_rng(seed)
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return hmm.Model(norm(rng.random(states), 0), norm(rng.random((states, states)), 1), norm(rng.random((symbols, states)), 0))


def enumerate_paths(model, doc):
    """Probability of every state path."""
    states = len(model.start)
    for path in itertools.product(range(states), repeat=len(doc)):
        p = model.start[path[0]] * model.emit[doc[0], path[0]]
        for a, b, x in zip(path, path[1:], doc[1:]):
            p *= model.move[a, b] * model.emit[x, b]
        yield path, p


def test_recursion_equals_enumeration():
    model = random_model(6, 3)
    rng = np.random.default_rng(1)
    docs = sorted([rng.integers(0, 6, size=n) for n in (1, 5, 3, 3, 2)], key=lambda d: -len(d))
    group = hmm.Group(docs)
    _, scale, _ = group.forward(model)
    likelihoods = [sum(p for _, p in enumerate_paths(model, d)) for d in docs]
    assert np.allclose(group.log_likelihoods(scale), np.log10(likelihoods))
    emitted = np.zeros((3, 6))
    starts, moves, total = group.expected(model, emitted)
    want_start, want_move, want_emit = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 6))
    for d, like in zip(docs, likelihoods):
        for path, p in enumerate_paths(model, d):
            want_start[path[0]] += p / like
            for a, b in zip(path, path[1:]):
                want_move[a, b] += p / like
            for s, x in zip(path, d):
                want_emit[s, x] += p / like
    assert np.allclose(starts, want_start) and np.allclose(moves, want_move) and np.allclose(emitted, want_emit)
    assert math.isclose(total, np.log10(likelihoods).sum())


def trained(spark, sf, states, passes):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").selectExpr("doc_id", "cast(text as binary) text", "false held_out")
    symbols = hmm.choose_symbols(hmm.count_words(docs))
    encoded = hmm.encode(docs, symbols)
    return docs, symbols, encoded, hmm.train(encoded, symbols, states, passes)


def test_training_never_lowers_the_likelihood(spark):
    *_, (_, _, _, history) = trained(spark, "sf0.001", 3, 4)
    assert len(history) == 4
    assert all(b > a - abs(a) * 1e-3 for a, b in zip(history, history[1:])) and history[-1] > history[0]


def test_every_word_has_a_row_and_rows_sum_to_one(spark, monkeypatch):
    monkeypatch.setattr(hmm, "OWN_SYMBOLS", 300)
    docs, symbols, _, (model, rare, learned, _) = trained(spark, "sf0.001", 3, 3)
    counts = {bytes(r.word): r.c for r in hmm.count_words(docs).collect()}
    rows = learned.collect()
    assert {bytes(r.word): r.n for r in rows} == {w: c for w, c in counts.items() if w and w not in set(symbols.words)}
    n, expected = np.array([r.n for r in rows], dtype=float), np.array([[r.e0, r.e1, r.e2] for r in rows]) / hmm.FRACTION
    assert np.allclose(expected.sum(axis=1), n, rtol=1.5 / hmm.FRACTION)
    emitted = rare.rows(n, expected)
    unseen = rare.rows(np.zeros(1), np.zeros((1, 3)))
    assert (emitted > unseen).all() and len(np.unique(emitted.round(12), axis=0)) > len(rows) // 4
    assert np.allclose(model.emit.sum(axis=0) + emitted.sum(axis=0) + unseen[0], 1)


def test_rare_words_counts_equal_enumeration(spark, docs_frame, monkeypatch):
    """The only pass is the untying one: its sums over all chunks are those of every path of the first model."""
    monkeypatch.setattr(hmm, "OWN_SYMBOLS", 2)
    texts = ["a b a x y", "b a z x", "a a b b", "y w", ""]
    docs = docs_frame(list(enumerate(texts))).selectExpr("doc_id", "cast(text as binary) text", "false held_out").repartition(3)
    symbols = hmm.choose_symbols(hmm.count_words(docs))
    _, _, learned, _ = hmm.train(hmm.encode(docs, symbols), symbols, states=2, passes=1)
    first, _ = hmm.first_model(symbols, 2)
    assert symbols.words == [b"a", b"b"]
    want = {}
    for text in texts:
        words = text.encode().split() + [hmm.END]
        known = {hmm.END: 0, b"a": 1, b"b": 2}
        doc = [known.get(w, symbols.head + hmm.tail_symbols([w])[0]) for w in words]
        paths = list(enumerate_paths(first, doc))
        for path, p in paths:
            for s, w in zip(path, words):
                want.setdefault(w, np.zeros(2))[s] += p / sum(q for _, q in paths)
    got = {bytes(r.word): np.array([r.e0, r.e1]) / hmm.FRACTION for r in learned.collect()}
    assert set(got) == {b"x", b"y", b"z", b"w"}
    assert all(np.allclose(got[w], want[w], atol=1.5 / hmm.FRACTION) for w in got)


def test_score_is_the_likelihood_of_the_final_model(spark, docs_frame, monkeypatch):
    """Scores by chunks and joins equal the recursion over one matrix of all rows, unseen words included."""
    monkeypatch.setattr(hmm, "OWN_SYMBOLS", 3)
    docs = [(i, f"a b c w{i % 7} w{i % 5} a" + " seldom" * (i % 3) + f" only{i}") for i in range(40)]
    frame = docs_frame(docs).repartition(4)
    rows = {r.doc_id: r for r in hmm.score(frame, states=2, passes=2).collect()}
    source = frame.selectExpr("doc_id", "cast(text as binary) text", "pmod(crc32(cast(cast(doc_id as string) as binary)), 7) = 2 held_out")
    symbols = hmm.choose_symbols(hmm.count_words(source.where("NOT held_out")))
    model, rare, learned, _ = hmm.train(hmm.encode(source, symbols), symbols, states=2, passes=2)
    emit = dict(zip([hmm.END, *symbols.words], model.emit))
    for r in learned.collect():
        emit[bytes(r.word)] = rare.rows(np.array([float(r.n)]), np.array([[r.e0, r.e1]]) / hmm.FRACTION)[0]
    unseen = rare.rows(np.zeros(1), np.zeros((1, 2)))[0]
    assert any(r.held_out for r in rows.values())
    for i, text in docs:
        alpha, total = model.start, 0.0
        for t, w in enumerate([*text.encode().split(), hmm.END]):
            alpha = (alpha if t == 0 else alpha @ model.move) * emit.get(w, unseen)
            total, alpha = total + math.log10(alpha.sum()), alpha / alpha.sum()
        assert math.isclose(rows[i].score, total, rel_tol=1e-4)


def test_words_of_equals_a_plain_split():
    import pyarrow as pa

    texts = [b"", b" ", b"  a B\n\tc\x0b\x0cd\r ", "Éé ÀB  x y \x1c \x85".encode(), b"a", b"\n\n", b"\xff\xfe Q\xe9"]
    for kind in (pa.binary(), pa.large_binary()):
        lengths, words = hmm.words_of(pa.array([b"cut off", *texts], kind).slice(1))
        split = [WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), t)) for t in texts]
        assert lengths.tolist() == [len(s) for s in split]
        assert words.to_pylist() == [w for s in split for w in s]


def test_a_pass_holds_few_bytes_a_token():
    """Memory of a group: three values a token and state, no copy of the forward values for the transitions."""
    import tracemalloc

    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 500, size=n) for n in range(699, 199, -1)]
    model = hmm.single(random_model(500, 8))
    group, emitted = hmm.Group(docs), np.zeros((8, 500))
    tracemalloc.start()
    try:
        group.expected(model, emitted)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 4 * 8 * 4 * sum(map(len, docs))


def test_encoded_chunks_are_written_apart(spark):
    """Row groups and pages of the encoded table hold a few chunks, however many a task writes."""
    import pyarrow.parquet as pq

    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 10**6, size=250_000).tolist()) for _ in range(24)]
    docs = spark.createDataFrame([(i, t.encode(), False) for i, t in enumerate(texts)], "doc_id long, text binary, held_out boolean").coalesce(1)
    nothing = np.zeros(hmm.TAIL_SYMBOLS)
    encoded = hmm.encode(docs, hmm.Symbols([], np.zeros(0, dtype=np.int64), 0, nothing, nothing, 0, 0))
    files = [pq.ParquetFile(f.removeprefix("file://")) for f in encoded.inputFiles()]
    groups = [f.metadata.row_group(k) for f in files for k in range(f.metadata.num_row_groups)]
    rows = encoded.count()
    assert rows >= 4 and len(groups) == rows              # each chunk here has more than a row group's 4 MiB
    assert {g.column(0).compression for g in groups} == {"ZSTD"}

"""Line dedup against brute force over all pairs of lines."""

import random
import re

import pytest

import __spark_entry__ as entry
from quarry.llm import lines as lines_op


def words(line):
    return [w for w in re.split(r"[ \t\n\x0B\f\r]+", line.lower()) if w]


def near(x, y):
    """Whether two lines, as words, are within one edit of their units."""
    if (len(x) >= lines_op.MIN_WORDS) != (len(y) >= lines_op.MIN_WORDS):
        return False
    if len(x) >= lines_op.MIN_WORDS:
        return within_one(x, y)
    x, y = list(" ".join(x)), list(" ".join(y))
    return min(len(x), len(y)) >= lines_op.MIN_CHARS and within_one(x, y)


def within_one(x, y):
    if abs(len(x) - len(y)) > 1:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) <= 1
    long, short = (x, y) if len(x) > len(y) else (y, x)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute(docs, text_hashes):
    """Texts left, by (id, text); ``text_hashes`` breaks ties between equal ids."""
    places = []
    for i, t in sorted(set(docs), key=str):
        for n, line in enumerate((t or "").split("\n")):
            if words(line):
                places.append(((i is None, i or 0, text_hashes[t or ""], n), (i, t), n, words(line)))
    places.sort(key=lambda p: p[0])
    gone = {}
    for k, (_, doc, n, w) in enumerate(places):
        for _, _, _, other in places[:k]:
            if w == other or near(w, other):
                gone.setdefault(doc, set()).add(n)
                break
    return {d: "\n".join(x for n, x in enumerate((d[1] or "").split("\n")) if n not in gone[d]) if d in gone else d[1] for d in set(docs)}


def hashes(spark, docs):
    texts = list({t or "" for _, t in docs})
    rows = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", "xxhash64(t) AS h").collect()
    return {r.t: r.h for r in rows}


def synthetic(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)] + ["É", "x.", "Y!"]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(6, 14))] for _ in range(12)]
    docs = []
    for i in range(40):
        out = []
        for _ in range(rng.randint(0, 6)):
            w = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, 1, 1, 2])):
                at, kind = rng.randrange(len(w)), rng.choice("sid")
                if kind == "d" and len(w) > 1:
                    del w[at]
                elif kind == "i":
                    w.insert(at, rng.choice(vocabulary))
                else:
                    w[at] = rng.choice(vocabulary)
            out.append(rng.choice(["  ", " ", "\t"]).join(w))
        docs.append((rng.randrange(30), "\n".join(out)))
    return docs + [(None, None), (50, ""), (51, "\n\n \n"), (52, "same\nSAME\n same "), (53, "same"), (None, "a b c d e f g h\n\nb c d e f g h"),
                   (54, "one " * 3000 + "\n" + "one " * 2999 + "two"), (55, docs[0][1]), (55, docs[0][1]),
                   (60, "Subscribe now!\nSubscribe  now\nsubscribe new\nsubscribed NOW"), (61, "page 1\npage 2\npage 3"), (62, "chapter 1\nchapter 12\nchapter 2"),
                   (63, "naïve café 🎉\nnaïve cafe 🎉\nnaive cafe 🎉\n🎉naïve café 🎉"), (64, "a b c d e f g\na b c d e f g h\na b c d e f h g\nabcdefgh\nabcdefg h"),
                   (65, "x" * 700 + "\n" + "x" * 699 + "\n" + "x" * 350 + "y" + "x" * 349 + "\n" + "x" * 300)]


@pytest.mark.parametrize("seed, sum_units", [(1, 256), (2, 256), (3, 4)])
def test_against_brute_force(spark, docs_frame, monkeypatch, seed, sum_units):
    monkeypatch.setattr(lines_op, "SUM_UNITS", sum_units)
    docs = synthetic(seed)
    got = lines_op.dedup_lines(docs_frame(docs, extra=("lines", "removed", "text_hash"))).collect()
    want = brute(docs, hashes(spark, docs))
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(((i, want[i, t]) for i, t in docs), key=str)


def test_nothing_is_marked_for_broadcast(spark, docs_frame, monkeypatch):
    """Candidate and removed lines are lists of a document, of any length: their joins are always shuffled."""
    docs = [(i, "\n".join(f"all of these words stay but one: n{k} d{i if k % 2 else 0} here" for k in range(60))) for i in range(3)]
    want = brute(docs, hashes(spark, docs))
    monkeypatch.setattr(lines_op.F, "broadcast", lambda table: pytest.fail("broadcast"))
    got = lines_op.dedup_lines(docs_frame(docs))
    assert "BroadcastExchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.doc_id, r.text) for r in got.collect()) == sorted((i, want[i, t]) for i, t in docs)


def test_variant_keys(spark):
    """Equal keys for equal variants, whatever part of the running sum they come from."""
    line = [f"u{k % 7}" for k in range(41)]
    rows = [(k, 0, 41 if k < 0 else 40, True, True, line if k < 0 else line[:k] + line[k + 1:], True) for k in range(-1, 41)]
    made = lines_op.variants(spark.createDataFrame(rows, "h1 long, h2 long, n int, front boolean, back boolean, units array<string>, by_word boolean"))
    keys = {(r.h1, r.place): (r.a, r.b) for r in made.collect()}
    assert len(keys) == 42 + 41 + 41 * 40
    for k in range(41):
        assert keys[-1, k + 1] == keys[k, 0]
    assert len({keys[-1, k + 1] for k in range(41)}) == 41


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute(docs, hashes(spark, docs))
    rows = entry.queries()["op4_line_dedup"](spark, sf).collect()
    assert sorted((r.doc_id, r.text) for r in rows) == sorted((i, want[i, t]) for i, t in docs)
    assert sum(r.n_removed for r in rows) == sum(len((t or "").split("\n")) for _, t in docs) - sum(
        0 if r.n_removed == r.n_lines else len(r.text.split("\n")) for r in rows)


def test_empty_table_and_columns(docs_frame):
    assert lines_op.dedup_lines(docs_frame([])).collect() == []
    docs = docs_frame([(1, "x")], extra=("doc",))
    assert lines_op.dedup_lines(docs).columns == docs.columns

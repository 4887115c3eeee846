"""Cap filters against brute force over all pairs."""

import math

import numpy as np
import pytest

import __spark_entry__ as entry
from quarry.llm import capfilters

SF = "/root/testdata/sf0.001"
COLUMNS = "vec_id long, embedding array<double>, ball string, u string"


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, cosine=capfilters.COSINE):
    """``(vec_id, n_links, component_id, kept)`` of every row."""
    unit = [np.array(v) / np.abs(v).max() if usable(v) else None for _, v in rows]
    unit = [None if v is None else v / np.linalg.norm(v) for v in unit]
    near = [[j for j, w in enumerate(unit) if j != i and v is not None and w is not None and len(v) == len(w) and v @ w >= cosine]
            for i, v in enumerate(unit)]
    group = list(range(len(rows)))
    for start in range(len(rows)):
        todo = [start] if group[start] == start else []
        while todo:
            for j in near[todo.pop()]:
                if group[j] == j and j > start:
                    group[j] = start
                    todo.append(j)
    least = {}
    for g, (i, _) in zip(group, rows):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return sorted([(i, len(n), least.get(g), i is not None and i == least.get(g)) for (i, _), n, g in zip(rows, near, group)], key=str)


def run(spark, rows):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], COLUMNS).repartition(3)
    return sorted([tuple(r) for r in capfilters.near_duplicates(df).collect()], key=str)


def around(rng, centre, cosine, n):
    """``n`` unit vectors at this cosine to ``centre``."""
    noise = rng.normal(size=(n, len(centre)))
    noise -= np.outer(noise @ centre, centre)
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    return (cosine * centre + math.sqrt(1 - cosine * cosine) * noise).tolist()


def test_groups_of_every_tightness(spark):
    rng = np.random.default_rng(2)
    vectors = []
    for cosine, n in ((0.995, 200), (0.985, 60), (0.977, 40), (0.96, 30), (0.9, 10)):
        centre = rng.normal(size=48)
        vectors += around(rng, centre / np.linalg.norm(centre), cosine, n)
    centre = rng.normal(size=48)
    centre /= np.linalg.norm(centre)
    # Two tight groups whose members are linked across only in part.
    other = np.array(around(rng, centre, 0.955, 1)[0])
    vectors += around(rng, centre, 0.998, 40) + around(rng, other, 0.998, 60) + rng.normal(size=(150, 48)).tolist()
    vectors += vectors[:3] + vectors[:1] + [(np.array(vectors[5]) * 1e200).tolist(), (np.array(vectors[300]) * 1e-200).tolist()]
    rows = list(enumerate(vectors))
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    line = [math.cos(0.1), math.sin(0.1)]
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, float("nan")]), (5, [1.0, None]), (6, [float("inf"), 1.0]), (6, [1.0, 0.0]),
            (6, [2.0, 0.0]), (None, line), (None, None), (7, [1.0, 0.0, 0.0]), (8, [1.0]), (9, [3.0]), (10, [-1.0]), (None, [0.0, -1.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


@pytest.mark.parametrize("cosine, least", [(0.95, 0.995), (0.98, 0.9995)])
def test_pairs_share_filters(cosine, least):
    """Pairs at the wanted cosine meet in a filter; unrelated ones seldom do."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = np.array([around(rng, v, cosine, 1)[0] for v in x])
    codes = capfilters.ProductCodes(64, 50_000, capfilters.COSINE)
    (a, f), (b, g) = codes.decode(x), codes.decode(y)
    held = set(zip(a.tolist(), f.tolist()))
    met = {i for i, k in zip(b.tolist(), g.tolist()) if (i, k) in held}
    strangers = sum(((i + 1) % 1500, k) in held for i, k in zip(b.tolist(), g.tolist()))
    assert len(met) >= least * 1500 and strangers < 15


def test_decoding_lists_every_exceeding_filter():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(40, 20))
    x /= np.linalg.norm(x, axis=1)[:, None]
    codes = capfilters.ProductCodes(20, 200, 0.95)
    who, found = codes.decode(x)
    want = set()
    for r, (rotation, (p, q, s)) in enumerate(zip(codes.rotations, codes.books)):
        t = x.astype(np.float32) @ rotation
        a, b = codes.cuts[1], codes.cuts[2]
        total = (t[:, :a] @ p.T)[:, :, None, None] + (t[:, a:b] @ q.T)[:, None, :, None] + (t[:, b:] @ s.T)[:, None, None, :]
        for i, j, k, m in np.argwhere(total >= codes.cap + 1e-5).tolist():
            want.add((i, ((j * codes.words + k) * codes.words + m) + r * codes.words ** 3))
    got = set(zip(who.tolist(), found.tolist()))
    assert want <= got and len(got) <= 1.01 * len(want) + 2 and len(got) == len(who)


def test_open_members_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(capfilters, "COMPARED_ROWS", 7)
    rng = np.random.default_rng(8)
    centre = rng.normal(size=32)
    centre /= np.linalg.norm(centre)
    other = np.array(around(rng, centre, 0.957, 1)[0])
    rows = list(enumerate(around(rng, centre, 0.993, 50) + around(rng, other, 0.993, 30)))
    rows += [(100 + k, rows[k][1]) for k in range(4)]
    assert run(spark, rows) == brute(rows)


def test_query(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted([tuple(r) for r in entry.queries()["op12_cap_filters"](spark, SF).collect()], key=str) == brute(rows)

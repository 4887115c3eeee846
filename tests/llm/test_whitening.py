"""Whitening against plain integer arithmetic."""

import math

import numpy as np
import pytest

import __spark_entry__ as entry
from quarry.llm import whitening

SF = "/root/testdata/sf0.001"
COLUMNS = "vec_id long, embedding array<double>, x string, c string"


def plain_fit(vectors, scale=256):
    """Number, sums and exact covariance numerators of the distinct integer vectors."""
    distinct = sorted({tuple(math.floor(scale * c) for c in v) for v in vectors})
    n, d = len(distinct), len(distinct[0])
    sums = [sum(x[j] for x in distinct) for j in range(d)]
    top = [[n * sum(x[j] * x[k] for x in distinct) - sums[j] * sums[k] for k in range(d)] for j in range(d)]
    return n, sums, top


def check(rows, given, components=4):
    used = [(i, v) for i, v in given]
    n, sums, top = plain_fit([v for _, v in used])
    cov = np.array([[c / (n * n) for c in row] for row in top])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    many = min(components, len(sums))
    assert len(rows) == many * len(used)
    by_id = {}
    for r in rows:
        by_id.setdefault((r.vec_id, r.component), []).append(r)
    for i, v in used:
        x = [math.floor(256 * c) for c in v]
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        for c in range(many):
            found = by_id[i, c + 1]
            exact = [r for r in found if r.deviation == deviation]
            assert exact and all(r.n == n for r in found)
            if values[c] > 1e-9 * values[0] > 0:
                want = abs(sum((n * a - s) / n * e for a, s, e in zip(x, sums, vectors[:, c])) / math.sqrt(values[c]))
                gap = np.abs(np.delete(values, c) - values[c]).min(initial=values[0]) / values[0]
                assert any(abs(abs(r.whitened) - want) < 1e-9 / max(gap, 1e-6) for r in exact)
                assert abs(exact[0].explained - values[c] / cov.trace()) < 1e-9
                assert exact[0].identity_error < 1e-6


def test_planes_give_exact_products():
    rng = np.random.default_rng(3)
    x = rng.integers(-300, 900, (1000, 5))
    x[:, 2] = 7                                       # no range at all
    x[:, 3] *= 1 << 40
    low = x.min(axis=0)
    bits = np.array([max(1, int(v).bit_length()) for v in x.max(axis=0) - low])
    counts = whitening.PlaneCounts(low, bits)
    counts.add(x[:613])
    counts.add(x[613:])
    products, singles = {}, {}
    for j, k, s, c in zip(*(a.tolist() for a in counts.rows())):
        if k < 0:
            singles[j] = singles.get(j, 0) + (c << s)
        else:
            products[j, k] = products.get((j, k), 0) + (c << s)
    y = [[int(v) for v in row] for row in x - low]
    for j in range(5):
        assert singles.get(j, 0) == sum(r[j] for r in y)
        for k in range(j, 5):
            assert products.get((j, k), 0) == sum(r[j] * r[k] for r in y)


def test_rows_against_plain_arithmetic(spark):
    rng = np.random.default_rng(5)
    given = [(i, (rng.normal(size=6) * [9, 4, 2, 1, 0.5, 0.2]).tolist()) for i in range(60)]
    given += [(7, given[7][1]), (100, given[0][1]), (101, [-0.0, 0.0, 1e-9, -1e-9, 3.0, 0.25])]
    odd = [(200, None), (201, [1.0] * 5 + [float("nan")]), (202, [1.0] * 5 + [None]), (203, [float("inf")] + [1.0] * 5),
           (204, [1.0, 2.0]), (205, []), (206, [1e300] + [0.0] * 5)]
    df = spark.createDataFrame([(i, v, "a", "b") for i, v in given + odd], COLUMNS).repartition(3)
    check(whitening.whiten(df).collect(), given)


def test_large_integers_stay_exact(spark):
    given = [(i, [2.0 ** 40 + 3e7 * i, (-1) ** i * i * i * 2.0 ** 21, float(i * i * 10 ** 6)]) for i in range(20)]
    rows = whitening.whiten(spark.createDataFrame([(i, v, "", "") for i, v in given], COLUMNS)).collect()
    n, sums, _ = plain_fit([v for _, v in given])
    for r in rows:
        deviation = sum((n * math.floor(256 * c) - s) ** 2 for c, s in zip(given[r.vec_id][1], sums))
        assert r.deviation == (deviation if deviation < 2 ** 63 else None)
    assert len(rows) == 60 and rows[0].identity_error < 1e-6


@pytest.mark.parametrize("given, rows, error", [
    ([], 0, None), ([(1, [1.0, 2.0])], 2, None), ([(1, [1.0, 2.0]), (None, [1.0, 2.0])], 4, None),
    ([(1, [1.0, 1.0]), (2, [2.0, 2.0]), (3, [5.0, 5.0])], 6, True),
])
def test_no_variance(spark, given, rows, error):
    """Components without variance have no value; one direction gives one component."""
    got = whitening.whiten(spark.createDataFrame([(i, v, "", "") for i, v in given], COLUMNS)).collect()
    assert len(got) == rows
    assert all((r.whitened is None) == (error is None or r.component > 1) for r in got)
    assert all(r.identity_error is None if error is None else r.identity_error < 1e-9 for r in got)


def test_query(spark):
    given = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(entry.queries()["op11_whitening"](spark, SF).collect(), given)

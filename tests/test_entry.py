"""Driver contract: entry, queries and SQL oracles agree on sf0.001."""

import hashlib
import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from quarry.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "orders", "lineitem"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["keyword", "n_articles"]
    assert len(df.collect()) > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("module", ["xxhash", "public_tokenizers", "tokenizers_and_more", "quarry.llm", "corpus_pipeline"])
def test_entry_without_an_optional_module(module):
    """A module that only the optional operators need may be absent."""
    code = f"import sys; sys.modules[{module!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=os.path.dirname(entry.__file__), capture_output=True, text=True)
    n, sql = map(int, said.stdout.split())
    assert n >= len(QUERIES) and sql >= len(QUERIES), said.stderr


def test_entry_hides_no_error_of_the_library():
    code = "import sys; sys.modules['quarry.plans.oracle'] = None; import __spark_entry__"
    assert subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(entry.__file__), capture_output=True).returncode


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _digest(df.columns, rows) == _digest(dcols, drows)

"""Registered queries against their SQL in DuckDB, on the smallest tables (skipped where those are not there)."""

import math
import os

import duckdb
import pytest

from weekloom.plans import catalog

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SLOW = {"join05_with_context", "agg23_contexts", "top04_neighbours", "agg06_multi_sense", "join07_single_sense", "agg27_distinctive_terms", "vec10_cohesion"} if FOLDER.endswith("sf0.001") else set()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return "none"
    if isinstance(x, bool) or type(x).__name__ in ("bool_", "bool"):
        return repr(bool(x))
    if isinstance(x, (int, float)):
        return f"{float(x):.5f}".replace("-0.00000", "0.00000")
    return str(x)[:19].removesuffix(" 00:00:00") if "date" in type(x).__name__ else str(x)


@pytest.mark.parametrize("name", sorted(set(catalog.oracle_sql()) - SLOW))
def test_query_equals_sql(spark, duck, name):
    ours = catalog.queries()[name](spark, FOLDER)
    theirs = duck.sql(catalog.oracle_sql()[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    at = [theirs.columns.index(c) for c in ours.columns]
    assert sorted(tuple(map(plain, r)) for r in ours.collect()) == sorted(tuple(plain(r[k]) for k in at) for r in theirs.fetchall())

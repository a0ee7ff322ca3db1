"""Every query of the catalog against its DuckDB oracle statement (sf0.001).

The driver runs the same comparison at sf0.01."""

import math
import os

import pytest

from tessera.plans.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data missing")


@pytest.fixture(scope="module")
def duck():
    import tempfile

    import duckdb

    from tessera.sources.corpus import TABLES

    con = duckdb.connect()
    con.execute(f"SET temp_directory='{tempfile.mkdtemp(prefix='duck-')}'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = df.columns
    got = _rows(cols, [tuple(r) for r in df.collect()])
    res = duck.execute(ORACLE[name])  # every query has its statement
    dcols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(dcols)
    assert got == _rows(dcols, res.fetchall())

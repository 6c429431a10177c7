"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from rasterloom.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}") + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_equals_sql(spark, db, name):
    frame = catalog.queries()[name](spark, SF)
    result = db.execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(frame.columns)
    order = sorted(columns)
    got = sorted((tuple(plain(r[c]) for c in order) for r in frame.collect()), key=repr)
    want = sorted((tuple(plain(r[columns.index(c)]) for c in order) for r in result.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_gives_rows(spark, name):
    rows = catalog.queries()[name](spark, SF).collect()
    assert rows
    assert all(r.asDict().get("ok", True) for r in rows)

"""Every registered query of the core against its SQL, on the smallest tables."""

import os

import pytest

from quarterline.plans.oracles import ORACLES
from quarterline.plans.queries import QUERIES

AT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(AT), reason="no tables here")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in os.listdir(AT):
        con.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{AT}/{file}'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple("null" if x is None or x != x and str(x) in ("NaT", "nan", "<NA>") else str(float(x)) if isinstance(x, float) else str(x) for x in r) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, db, name):
    mine, theirs = QUERIES[name](spark, AT).toPandas(), db.sql(ORACLES[name])
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows(mine) == rows(theirs.df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, AT).toPandas().columns.size >= 1


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)

"""Every registered query of the library against its SQL, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from chronolake.plans import queries as plans

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)]

    def one(v):
        if v is None or v is pd.NaT or v is pd.NA or v != v:
            return ""
        if hasattr(v, "year"):
            return str(v)[:10]
        return repr(float(v) + 0.0) if isinstance(v, (int, float)) and not isinstance(v, bool) or hasattr(v, "dtype") and v.dtype.kind in "iuf" else str(v)

    return sorted([one(v) for v in row] for row in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, db, name):
    got = plans.QUERIES[name](spark, SF).toPandas()
    if name in plans.SQL:
        want = db.sql(plans.SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert plain(got) == plain(want)
    else:
        assert list(got.columns)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(plans.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())

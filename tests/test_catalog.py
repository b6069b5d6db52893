"""Every query of the catalog against DuckDB, on the smallest tables."""

import duckdb
import pytest

from examlake.plans.catalog import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    return c


def normal(frame):
    k = sorted(frame.columns)
    text = frame[k].astype(object).where(frame[k].notna(), "~").astype(str).replace(r"\.0$", "", regex=True)
    return text.sort_values(k).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    got, want = QUERIES[name](spark, FOLDER).toPandas(), con.sql(ORACLE_SQL[name]).df()
    assert normal(got).equals(normal(want))

"""Every registered query against its SQL, over the whole smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, SQL = ({n: x for g in entry.ALL for n, x in getattr(g, kind).items()} for kind in ("queries", "sql"))


def normal(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(
        tuple("NULL" if pd.isna(v) else str(v) for v in row) for row in frame.itertuples(index=False)
    )


@pytest.fixture(scope="module")
def oracle(data):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, data, oracle, name):
    got = QUERIES[name](spark, data).toPandas()
    want = oracle.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(want) > 0
    assert normal(got) == normal(want)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0

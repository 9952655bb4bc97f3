"""Every registered query against its SQL, on the smallest driver tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tickweave.plans import queries as q


def rows(df: pd.DataFrame, cols: list[str], floats: set[str]) -> list[tuple]:
    text = lambda c, v: "NULL" if v is None or pd.isna(v) else f"{float(v):.6f}" if c in floats else str(v)
    return sorted(tuple(text(c, v) for c, v in zip(cols, r)) for r in df[cols].itertuples(index=False))


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect(config={"temp_directory": "/tmp/tickweave-duck", "max_temp_directory_size": "1GB"})
    for path in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(q.ORACLE_SQL))
def test_query_matches_sql(spark, sf, db, name):
    got, want = q.QUERIES[name](spark, sf).toPandas(), db.sql(q.ORACLE_SQL[name]).df()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    floats = {c for c in cols if got[c].dtype.kind == "f" or want[c].dtype.kind == "f"}
    assert rows(got, cols, floats) == rows(want, cols, floats)


@pytest.mark.parametrize("name", sorted(set(q.QUERIES) - set(q.ORACLE_SQL)))
def test_query_without_sql_runs(spark, sf, name):
    assert q.QUERIES[name](spark, sf).limit(5).count() == 5


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1


def test_nothing_else_imports_the_corpus_operators():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for path in glob.glob(f"{root}/tickweave/**/*.py", recursive=True):
        if f"{os.sep}llm{os.sep}" not in path:
            assert "llm" not in open(path).read(), path

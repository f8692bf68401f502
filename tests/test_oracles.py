"""Every registered query against its DuckDB oracle on the smallest tables."""

import hashlib
import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = os.environ.get("QALAKE_TEST_SF", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None or v is pd.NaT:
        return "NULL"
    try:
        if pd.isna(v):
            return "NULL"
    except (TypeError, ValueError):
        pass
    if isinstance(v, pd.Timestamp) or hasattr(v, "isoformat"):
        return pd.Timestamp(v).strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(v, float):
        return str(int(v)) if v.is_integer() else repr(v)
    return str(v)


def _digest(df):
    cols = sorted(df.columns)
    rows = sorted("|".join(_norm(r[c]) for c in cols) for r in df[cols].to_dict("records"))
    return len(rows), hashlib.sha256("\n".join(rows).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["post_id", "up", "down"]
    assert df.count() >= 0


def test_every_query_has_an_oracle_or_is_listed():
    no_oracle = set(entry.queries()) - set(entry.oracle_sql())
    # the training-data operators are tested against brute force in tests/llm
    no_oracle -= set(entry._training_data())
    assert not no_oracle


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF)
    rel = duck.sql(entry.oracle_sql()[key])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == duck_types
    sdf = df.toPandas()
    odf = rel.df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    assert _digest(sdf) == _digest(odf)

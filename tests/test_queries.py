"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry
from vendora.plans import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        if os.path.exists(f"{DATA}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def canonical(rows, columns):
    def text(v):
        if v is None or (isinstance(v, float) and np.isnan(v)) or v is pd.NaT:
            return "null"
        if isinstance(v, float) or type(v).__name__ == "Decimal":
            return f"{float(v):.9g}"
        return str(v)

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(text(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, DATA)
    rel = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(rel.fetchall(), rel.columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())

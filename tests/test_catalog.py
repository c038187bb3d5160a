"""Every registered query outside the corpus operators against its SQL in DuckDB."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from docloom.plans.catalog import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return c


def canonical(df: pd.DataFrame) -> list[tuple]:
    def one(v):
        if v is None or (pd.api.types.is_scalar(v) and pd.isna(v)):
            return ""
        return f"{float(v):.5f}" if isinstance(v, (float, np.floating, int, np.integer)) and not isinstance(v, (bool, np.bool_)) else str(v)

    df = df[sorted(df.columns)]
    return sorted(tuple(one(v) for v in row) for row in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, sf_dir, duck, name):
    got, want = QUERIES[name](spark, sf_dir).toPandas(), duck.sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0

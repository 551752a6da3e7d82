"""Every registered query with SQL gives the rows that DuckDB gives, on the smallest tables."""

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = sorted(k for k in entry.oracle_sql() if not k.startswith(("op", "pipeline")))


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    c.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def shown(v):
    """Whole numbers alike whether integers or not, others in six digits, all nulls alike."""
    if v is None or (pd.api.types.is_scalar(v) and pd.isna(v)):
        return "null"
    if isinstance(v, (int, float, np.number)) and not isinstance(v, (bool, np.bool_)):
        return str(int(v)) if np.isfinite(v) and v == int(v) else f"{v:.6g}"
    return str(v)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(shown, r)) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    found, want = entry.queries()[name](spark, DATA).toPandas(), duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(found.columns) == sorted(want.columns)
    assert rows(found) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).columns == ["partition", "alphabet", "usable", "reason"]

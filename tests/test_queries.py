"""Every query with an SQL twin gives DuckDB's rows."""

import math

import duckdb
import numpy as np
import pandas as pd
import pytest

from weftline import plans

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ORACLES = plans.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    if v is None or v is pd.NA or v is pd.NaT or isinstance(v, float) and math.isnan(v):
        return "null"
    if isinstance(v, (int, np.integer)) and not isinstance(v, (bool, np.bool_)):
        return f"{float(v):.5f}" if abs(v) < 2**53 else str(v)
    if isinstance(v, float):
        return f"{v:.5f}".replace("-0.00000", "0.00000")
    return str(v)


def rows(frame):
    names = sorted(frame.columns)
    return names, sorted(tuple(cell(v) for v in r) for r in frame[names].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, sf_dir, duck, name):
    got = rows(plans.queries()[name](spark, sf_dir).toPandas())
    want = rows(duck.execute(ORACLES[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_entry_is_the_flagship(spark):
    import __spark_entry__

    found = __spark_entry__.entry(spark)
    assert found.columns == ["left_id", "right_id", "cosine"] and found.count() > 0


def test_names_are_unique_and_registered():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(plans.queries()) <= set(__spark_entry__.queries())

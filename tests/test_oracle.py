"""Every registered query with an oracle matches DuckDB on sf0.001."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMOKE_SF

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
ORACLE = entry.oracle_sql()
# Queries that train a model or drive a stream are covered by their own tests.
SLOW = {"train_gbt", "predict_scores", "feature_importance"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = Path(SMOKE_SF) / f"{t}.parquet"
        if p.exists():
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _norm(v):
    import numpy as np
    import pandas as pd
    if isinstance(v, np.ndarray):
        return tuple(_norm(x) for x in v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if v is None or (not isinstance(v, str) and not hasattr(v, "__len__") and pd.isna(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else None
    return v


def _rows(pdf, cols):
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def test_every_query_has_a_callable():
    qs = entry.queries()
    assert set(ORACLE) <= set(qs)
    assert len(qs) >= 100


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SMOKE_SF).toPandas()
    ddf = con.sql(ORACLE[name]).df()
    assert sorted(sdf.columns) == sorted(ddf.columns)
    cols = sorted(sdf.columns)
    assert _rows(sdf, cols) == _rows(ddf, cols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "answered_correctly_avg_u" in df.columns and "PCA_0" in df.columns

"""Every registered query of the library against its DuckDB SQL on the smallest tables."""

import os

import pytest

from lakemill.plans.registry import ORACLES, QUERIES

duckdb = pytest.importorskip("duckdb")


def _rows(pdf):
    def plain(x):
        if x is None or x != x:
            return None
        return str(x) if not isinstance(x, float) else round(x, 9) + 0.0

    cols = sorted(pdf.columns)
    for c in cols:
        if str(pdf[c].dtype).startswith("datetime"):
            pdf[c] = pdf[c].astype("datetime64[us]").astype(str)
    return sorted((tuple(plain(v) for v in r) for r in pdf[cols].astype(object).itertuples(index=False)), key=str)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, sf, con, name):
    ours, theirs = QUERIES[name](spark, sf).toPandas(), con.sql(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    a, b = _rows(ours), _rows(theirs)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            assert u == v or (isinstance(u, float) and isinstance(v, float) and abs(u - v) < 1e-8) or str(u) == str(v), (x, y)


def test_streams_read_tables_that_are_folders(spark, sf, tmp_path):
    for name in ("documents", "events"):
        spark.read.parquet(f"{sf}/{name}.parquet").repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    for name in ("stream_sentiment_windows", "stream_hourly_state"):
        one, parts = (QUERIES[name](spark, d).toPandas() for d in (sf, str(tmp_path)))
        assert len(one) and _rows(one) == _rows(parts)

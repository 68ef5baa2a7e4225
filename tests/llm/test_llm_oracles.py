"""Queries of the training-data operators against DuckDB SQL, whole or in their base columns."""

import os

import pytest

from lakemill.llm.queries import ORACLES, QUERIES

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, con, name):
    ours, theirs = QUERIES[name](spark, SF), con.sql(ORACLES[name])
    names = sorted(ours.columns)
    assert names == sorted(theirs.columns)
    a = sorted(tuple(r[c] for c in names) for r in ours.collect())
    b = sorted(theirs.select(*[duckdb.ColumnExpression(c) for c in names]).fetchall())
    assert a == b and len(a) > 50


def test_base_columns_of_the_license_scan(spark, con):
    """Places of the four phrases as runs of words."""
    words = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')".replace("\\\\", "\\")
    want = con.sql(f"""
      WITH d AS (SELECT doc_id, {words} AS w FROM documents), p(phrase, label) AS (VALUES ('gnu general public license', 'gpl'), ('apache license', 'apache'), ('cc by', 'cc-by'), ('mit license', 'mit')),
      q AS (SELECT string_split(phrase, ' ') AS ws, label FROM p),
      hit AS (SELECT doc_id, p, label FROM (SELECT doc_id, w, unnest(range(len(w))) AS p FROM d) JOIN q ON w[p + 1] = ws[1] AND w[p + 1 : p + len(ws)] = ws)
      SELECT doc_id, len(w), count(p), min(p), max(p), coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') FROM d LEFT JOIN hit USING (doc_id) GROUP BY doc_id, w""").fetchall()
    got = QUERIES["op6_license_scan"](spark, SF).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)) and any(r["n_base"] for r in got)

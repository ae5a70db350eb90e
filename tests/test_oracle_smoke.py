"""A sample of registered queries against their DuckDB oracle at sf0.001
(the full set runs with ``python check_oracle.py``)."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("nation", "customer", "supplier", "lineitem", "events")
SAMPLE = ("summary_5", "summaries_all", "metrics_view_60", "pair_details", "stage_snapshot", "base_tokens",
          "token_scores", "activity_cutoff", "eligible_timeframes", "freshness")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else float(f"{v:.6g}"))
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    idx = [rel.columns.index(c) for c in sdf.columns]
    got = Counter(tuple(_norm(x) for x in r) for r in sdf.collect())
    want = Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == want

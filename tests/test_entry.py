"""Driver contract smoke test."""

import __spark_entry__ as E


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "pct_geek_fees_liquidity_24h" in df.columns
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    for name in ("summary_5", "update_count", "base_tokens"):
        assert qs[name](spark, "/root/testdata/sf0.001").count() >= 0

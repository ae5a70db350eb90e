"""C19, C20 and the dashboard data helpers."""

import datetime as dt

from helpers import history, pairs

from tidepool.operators.filters import DEFAULT_FILTER_MODEL, apply_filter_model
from tidepool.operators.tokens import SOL_MINT, USDC_MINT, USDT_MINT, base_tokens, token_scores
from tidepool.plans import metrics as M
from tidepool.plans.dashboard import freshness
from tidepool.schema import PAIRS, TOKENS


def _bt(spark, pair_rows, token_rows):
    p = spark.createDataFrame([(i, a, "n", x, y, 1, 0.1, False, False) for i, a, x, y in pair_rows], PAIRS)
    t = spark.createDataFrame(token_rows, TOKENS)
    return {r["pair_address"]: (r["symbol"], r["mint"]) for r in base_tokens(p, t).collect()}


def test_base_token_choice(spark):
    toks = [(1, SOL_MINT, "SOL"), (2, USDC_MINT, "USDC"), (3, USDT_MINT, "USDT"), (4, "m4", "FOO"), (5, "m5", "BAR")]
    out = _bt(
        spark,
        [(10, "a", 4, 1), (11, "b", 1, 5), (12, "c", 2, 1), (13, "d", 2, 3), (14, "e", 2, 2), (15, "f", 4, 5), (16, "g", 4, 4)],
        toks,
    )
    assert out["a"] == ("FOO", "m4")  # first non-quote
    assert out["b"] == ("BAR", "m5")  # non-quote on the y side
    assert out["c"] == ("SOL", SOL_MINT)  # both quotes: SOL first
    assert out["d"] == ("USDT", USDT_MINT)  # then USDT
    assert out["e"] == ("USDC", USDC_MINT)  # else the first row
    assert out["f"] == ("FOO", "m4")  # x before y
    assert out["g"] == ("FOO", "m4")  # equal mints: one row (C20)


def test_token_scores(spark):
    df = spark.createDataFrame(
        [("a", '{"tokens": [{"organicScore": 68.5}]}'), ("b", '{"tokens": []}'), ("c", "not json"), ("d", '{"tokens": [{"organicScore": 69.5}]}')],
        "mint string, payload string",
    )
    out = {r["mint"]: r["organic_score"] for r in token_scores(df).collect()}
    assert out == {"a": 68, "b": None, "c": None, "d": 70}


def test_filter_model_and_freshness(spark):
    h = history(spark, [(m, 1, 10 + m, 2000, 1) for m in range(5)] + [(m, 2, 10, 10, 0) for m in range(5)])
    p = pairs(spark, [(1, "P1", 10, False), (2, "P2", 10, False)])
    s = M.summary(h, p, 5)
    assert [r["pair_address"] for r in apply_filter_model(s, DEFAULT_FILTER_MODEL).collect()] == ["P1"]
    from tidepool.operators.filters import opportunities

    ranked = opportunities(s, model={}, sort_model=[{"colId": "liquidity", "sort": "asc"}]).collect()
    assert [r["pair_address"] for r in ranked] == ["P2", "P1"]
    assert [r["pair_address"] for r in opportunities(s, model={}, top=1).collect()] == ["P1"]
    f = freshness(h, s, dt.datetime(2024, 1, 1, 12, 10, 30)).collect()[0]
    assert (f["update_count"], f["minutes_ago"], f["shown"], f["offer_refresh"]) == (5, 6, True, True)
    empty = freshness(h, s.filter("false"), dt.datetime(2024, 1, 1, 12, 10)).collect()[0]
    assert empty["minutes_ago"] == -1 and not empty["shown"]


def test_json_pages_views_and_lookup(spark, scratch):
    import json

    from tidepool.operators.ingest import stage_snapshot
    from tidepool.plans.views import pair_row, register_views
    from tidepool.sources.snapshots import export, read_pages

    entry = {"address": "A", "name": "X-Y", "mint_x": "x", "mint_y": "y", "bin_step": 10,
             "base_fee_percentage": "0.2", "hide": False, "is_blacklisted": False,
             "cumulative_fee_volume": "12.5", "current_price": 1.5, "liquidity": 10.0, "fees": {"min_30": 0.0}}
    with open(scratch + "/p0.json", "w") as fh:
        fh.write(json.dumps({"created_at": "2024-01-01T00:00:00", "page": 0, "pairs": [entry, dict(entry, address="B")]}) + "\n")
    st = stage_snapshot(read_pages(spark, scratch + "/p0.json"))
    assert sorted(r["address"] for r in st.collect()) == ["A", "B"]
    h = history(spark, [(m, 1, 10 + m, 2000, 1) for m in range(5)])
    p = pairs(spark, [(1, "P1", 10, False)])
    register_views(spark, h, p, n=5)
    assert spark.sql("SELECT count(*) AS n FROM v_pair_history").collect()[0]["n"] == 5
    export(pair_row(M.summary(h, p, 5), "P1"), scratch + "/out")
    assert spark.read.option("header", True).csv(scratch + "/out").count() == 1


def test_timeframe_options_and_default(spark):
    from tidepool.operators.snapshots import eligible_timeframes

    def opts(n):
        h = history(spark, [(m, 1, 10, 100, 0) for m in range(n)])
        rows = eligible_timeframes(h).orderBy("timeframe").collect()
        return [r["timeframe"] for r in rows], [r["timeframe"] for r in rows if r["is_default"]], rows

    assert opts(4)[0] == []
    assert opts(5)[:2] == ([5], [5])
    assert opts(20)[:2] == ([5, 15], [15])  # fewer than four options: the last
    got, default, rows = opts(60)
    assert got == [5, 15, 30, 60] and default == [30]  # otherwise the third
    assert rows[0]["label"] == "5 minutes" and rows[-1]["label"] == "1 hour" and rows[0]["ready"]

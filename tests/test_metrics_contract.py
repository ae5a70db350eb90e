"""Contract rows C1-C8, C15-C17 and the summary/detail split (hand-built)."""

import pytest
from helpers import by_key, history, pairs

from tidepool.plans import metrics as M


def test_gap_counts_snapshots_not_minutes(spark):
    # Pair 1 present in all 5 snapshots, pair 2 misses two of them.
    rows = [(m, 1, 10 + m, 1000, 1) for m in range(5)]
    rows += [(m, 2, 10, 1000, 1) for m in (0, 3, 4)]
    h, p = history(spark, rows), pairs(spark, [(1, "P1", 10, False), (2, "P2", 10, False)])
    out = by_key(M.summary(h, p, 5))
    assert set(out) == {"P1"}
    assert out["P1"]["num_minutes"] == 5
    # N=3: pair 2 has 2 of the last 3 snapshots (< 2.7), so it is left out.
    out3 = by_key(M.summary(h, p, 3))
    assert "P2" not in out3


def test_snapshot_set_and_latest_come_before_blacklist(spark):
    # Newest snapshot holds only a blacklisted pair -> empty summary.
    rows = [(m, 1, 10, 1000, 1) for m in range(5)] + [(5, 2, 10, 1000, 1)]
    h = history(spark, rows)
    p = pairs(spark, [(1, "P1", 10, False), (2, "P2", 10, True)])
    assert M.summary(h, p, 5).count() == 0
    assert M.summary(h, p, 5, method="window").count() == 0


def test_first_row_stddev_null_unless_zero_liquidity(spark):
    h = history(spark, [(0, 1, 10, 500, 5), (0, 2, 10, 0, 5)])
    p = pairs(spark, [(1, "P1", 10, False), (2, "P2", 10, False)])
    out = by_key(M.metrics_view(h, p, 5))
    assert out["P1"]["pct_geek_fees_liquidity"] is None  # C6
    assert out["P2"]["pct_geek_fees_liquidity"] == 0.0
    assert out["P1"]["liquidity_std_dev"] is None


def test_peers_share_running_values(spark):
    # Two rows at the same created_at are peers of the RANGE frame (C4).
    h = history(spark, [(0, 1, 10, 100, 1), (1, 1, 11, 100, 1), (1, 1, 12, 300, 1)])
    p = pairs(spark, [(1, "P1", 10, False)])
    rows = [r for r in M.metrics_view(h, p, 5).collect() if r["num_minutes"] == 3]
    assert len(rows) == 2
    assert {r["avg_liquidity"] for r in rows} == {500 / 3}


def test_rounded_stddev_feeds_ratios(spark):
    # liquidity 100, 100.01 -> sd 0.00707.. rounds to 0.01.
    h = history(spark, [(0, 1, 10, 100, 0), (1, 1, 10, 100.01, 3)])
    p = pairs(spark, [(1, "P1", 10, False)])
    r = by_key(M.summary(h, p, 2))["P1"]
    assert r["liquidity_std_dev"] == 0.01
    avg = (100.0 + float(__import__("numpy").float32(100.01))) / 2
    assert r["pct_geek_fees_liquidity"] == pytest.approx(100 * 3 / (avg + 0.01))
    assert r["liquidity_volatility_ratio"] == 0.0
    raw = 1440 * r["pct_geek_fees_liquidity"] / 2
    assert r["pct_geek_fees_liquidity_24h"] == pytest.approx(round(raw, 2), abs=1e-9)


def test_bins_exact_multiples_and_guards(spark):
    # max/min = 1.01^2 with bin_step 100 -> 2 bins (C15); min 0 and step 0 -> NULL.
    lo, hi = 1.0, 1.0201
    h = history(
        spark,
        [(0, 1, lo, 100, 0), (1, 1, hi, 100, 0), (0, 2, 0.0, 100, 0), (1, 2, 2.0, 100, 0), (0, 3, lo, 100, 0), (1, 3, hi, 100, 0)],
    )
    p = pairs(spark, [(1, "P1", 100, False), (2, "P2", 100, False), (3, "P3", 0, False)])
    out = by_key(M.summary(h, p, 2))
    # 1.0201 is stored as float32 1.0200999975..., just under 1.01^2: 2 bins.
    assert out["P1"]["bins_range"] == 2
    assert out["P1"]["num_positions_range"] == 1
    assert out["P2"]["bins_range"] is None and out["P2"]["pct_price_range"] is None
    assert out["P3"]["bins_range"] is None and out["P3"]["bins_below_max"] is None
    # At the max price, pct_below_max = 0 -> 0 bins, near max.
    assert out["P1"]["pct_below_max"] == 0.0 and out["P1"]["bins_below_max"] == 0 and out["P1"]["near_max"]


def test_constant_price_has_no_tick_ratio(spark):
    h = history(spark, [(m, 1, 5, 100, 0) for m in range(3)])
    p = pairs(spark, [(1, "P1", 10, False)])
    r = by_key(M.summary(h, p, 3))["P1"]
    assert r["num_tick_up"] == 0 and r["num_tick_down"] == 0 and r["pct_tick_up"] is None  # C17


def test_summary_second_level_sees_one_row_but_detail_sees_series(spark):
    h = history(spark, [(0, 1, 1, 100, 1), (1, 1, 2, 100, 1), (2, 1, 3, 100, 1)])
    p = pairs(spark, [(1, "P1", 10, False)])
    s = by_key(M.summary(h, p, 3))["P1"]
    d = M.pair_details(h, p, "P1", 3).collect()
    assert [r["num_tick_up"] for r in d] == [0, 1, 2]
    assert s["num_tick_up"] == 1 and s["pct_tick_up"] == 100.0
    assert s["std_dev_pct_geek_fees_liquidity_24h"] is None
    series = by_key(M.summary(h, p, 3, second_level="series"))["P1"]
    assert series["num_tick_up"] == 2
    # Everything else agrees between the summary and detail's last row.
    last = d[-1].asDict()
    for k, v in s.items():
        if k not in ("std_dev_pct_geek_fees_liquidity_24h", "pct_geek_fees_liquidity_24h_volatility_ratio",
                     "num_tick_up", "num_tick_down", "pct_tick_up"):
            assert last[k] == pytest.approx(v) if isinstance(v, float) else last[k] == v, k


def test_aggregate_form_equals_window_form(spark):
    from tidepool.sources import testdata as td

    d = "/root/testdata/sf0.001"
    h, p = td.events_history(spark, d), td.customer_pairs(spark, d)
    for n in (5, 15, 30):
        a = sorted(M.summary(h, p, n).collect())
        w = sorted(M.summary(h, p, n, method="window").collect())
        assert len(a) == len(w)
        for x, y in zip(a, w):
            for k in x.asDict():
                if isinstance(x[k], float):
                    assert x[k] == pytest.approx(y[k], rel=1e-9, abs=1e-9), k
                else:
                    assert x[k] == y[k], k


def test_single_pass_summaries_equal_per_timeframe(spark):
    from tidepool.sources import testdata as td

    d = "/root/testdata/sf0.001"
    h, p = td.events_history(spark, d), td.customer_pairs(spark, d)
    allx = M.summaries(h, p)
    assert sorted(r["timeframe"] for r in allx.select("timeframe").distinct().collect()) == [5, 15, 30]
    for n in (5, 15, 30):
        one = sorted(tuple(r) for r in M.summary(h, p, n).collect())
        part = sorted(tuple(r)[1:] for r in allx.filter(f"timeframe = {n}").collect())
        # Merged variances agree up to the last digits.
        assert len(one) == len(part)
        assert all(a == b or a == pytest.approx(b, rel=1e-9) for x, y in zip(one, part) for a, b in zip(x, y))


def test_detail_timeframe_is_global(spark):
    # Pair 2 is missing from the newest snapshots: its detail over N=3 holds
    # only its rows inside the global last 3 snapshots.
    rows = [(m, 1, 10, 100, 0) for m in range(6)] + [(m, 2, 10, 100, 0) for m in range(4)]
    h, p = history(spark, rows), pairs(spark, [(1, "P1", 10, False), (2, "P2", 10, False)])
    got = [r["dttm"].minute for r in M.pair_details(h, p, "P2", 3).collect()]
    assert got == [3]
    assert M.pair_details(h, p, "nope", 3).count() == 0


def test_output_schema_is_the_contract(spark):
    from tidepool.schema import METRICS, SUMMARIES
    from tidepool.sources import testdata as td

    d = "/root/testdata/sf0.001"
    h, p = td.events_history(spark, d), td.customer_pairs(spark, d)
    strip = lambda st: [(f.name, f.dataType) for f in st.fields]
    for df in (M.summary(h, p, 5), M.summary(h, p, 5, method="window"), M.metrics_view(h, p, 5),
               M.pair_details(h, p, "Customer#000000007", 5)):
        assert strip(df.schema) == strip(METRICS)
    assert strip(M.summaries(h, p).schema) == strip(SUMMARIES)

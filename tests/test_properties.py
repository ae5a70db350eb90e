"""Randomised properties (hypothesis): aggregate form = window form, and
per-pair fee sums telescope to last - first counter."""

import datetime as dt

import pytest
from helpers import raw_entries
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidepool.operators import ingest as I
from tidepool.plans import metrics as M
from tidepool.schema import COUNTERS, HISTORY, PAIRS

T0 = dt.datetime(2024, 3, 1)
T0_FEED = dt.datetime(2024, 1, 1, 12, 0)  # minute 0 of ``helpers.raw_entries``

# Per pair: a set of snapshot indexes it appears in, with price/liquidity/fees.
pair_rows = st.lists(
    st.tuples(
        st.integers(0, 9),
        st.floats(0.5, 1000, allow_nan=False),
        st.floats(0, 1e6, allow_nan=False),
        st.one_of(st.none(), st.floats(-5, 50, allow_nan=False)),
    ),
    min_size=1,
    max_size=10,
    unique_by=lambda r: r[0],
)
histories = st.lists(pair_rows, min_size=1, max_size=4)

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def _frames(spark, hist):
    rows, prs = [], []
    for pid, series in enumerate(hist):
        prs.append((pid, f"P{pid}", f"P{pid}-Q", 1, 2, 1 + pid * 37, 0.25, False, pid == 3))
        for m, price, liq, fees in series:
            rows.append((T0 + dt.timedelta(minutes=m), pid, price, liq, fees))
    return spark.createDataFrame(rows, HISTORY), spark.createDataFrame(prs, PAIRS)


def _close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == pytest.approx(b, rel=1e-9, abs=1e-9)
    return a == b


@SETTINGS
@given(hist=histories, n=st.sampled_from([2, 5, 10]))
def test_aggregate_equals_window(spark, hist, n):
    h, p = _frames(spark, hist)
    a = {r["pair_address"]: r.asDict() for r in M.summary(h, p, n).collect()}
    w = {r["pair_address"]: r.asDict() for r in M.summary(h, p, n, method="window").collect()}
    assert a.keys() == w.keys()
    for k in a:
        for col, v in a[k].items():
            assert _close(v, w[k][col]), (k, col, v, w[k][col])


@SETTINGS
@given(counters=st.lists(st.lists(st.integers(0, 10**6), min_size=1, max_size=8), min_size=1, max_size=3))
def test_fee_sum_telescopes(spark, counters):
    rows = [
        {"m": m, "address": f"A{i}", "counter": str(c)}
        for i, series in enumerate(counters)
        for m, c in enumerate(series)
    ]
    staged = I.stage_snapshot(raw_entries(spark, rows))
    out = I.fee_deltas(staged, spark.createDataFrame([], COUNTERS)).groupBy("address").sum("fees").collect()
    got = {r["address"]: r["sum(fees)"] for r in out}
    for i, series in enumerate(counters):
        import numpy as np

        f = np.float32
        want = sum(float(f(series[k]) - f(series[k - 1])) for k in range(1, len(series)))
        assert got[f"A{i}"] == pytest.approx(want, rel=1e-6, abs=1e-3)


@SETTINGS
@given(
    counters=st.lists(st.lists(st.integers(0, 10**5), min_size=6, max_size=6), min_size=1, max_size=3),
    present=st.lists(st.lists(st.booleans(), min_size=6, max_size=6), min_size=3, max_size=3),
    cuts=st.sets(st.integers(1, 5), max_size=3),
)
def test_batches_equal_one_load(spark, counters, present, cuts):
    """Loading snapshots in several batches, carrying the counter state, gives
    the same fees as one batch (state survives gaps and batch boundaries)."""
    rows = [
        {"m": m, "address": f"A{i}", "counter": str(c)}
        for i, series in enumerate(counters)
        for m, c in enumerate(series)
        if present[i][m] or m == 0
    ]
    staged = I.stage_snapshot(raw_entries(spark, rows))
    empty = spark.createDataFrame([], COUNTERS)
    whole = sorted((r["address"], r["created_at"], r["fees"]) for r in I.fee_deltas(staged, empty).collect())
    bounds = [0, *sorted(cuts), 6]
    state, parts = empty, []
    for lo, hi in zip(bounds, bounds[1:]):
        lo_t, hi_t = T0_FEED + dt.timedelta(minutes=lo), T0_FEED + dt.timedelta(minutes=hi)
        part = staged.filter((staged.created_at >= lo_t) & (staged.created_at < hi_t))
        parts += I.fee_deltas(part, state).collect()
        state = spark.createDataFrame(I.counter_upsert(part, state).collect(), COUNTERS)
    assert sorted((r["address"], r["created_at"], r["fees"]) for r in parts) == whole

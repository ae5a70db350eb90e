"""Mergeable moments, peers at the newest snapshot, sealed blocks."""

import math
import random

import pytest
from helpers import history, minute, pairs, raw_entries
from pyspark.sql import functions as F

from tidepool.operators.moments import PARTIAL, STATE, folded, moment_columns, statistics
from tidepool.operators.snapshots import readiness
from tidepool.plans import metrics as M
from tidepool.plans.load import load_snapshot
from tidepool.plans.refresh import append_history, current_summaries, seal_blocks
from tidepool.sources.tables import Tables


def _close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def _same(got, want, keys):
    def rows(df):
        return sorted((r.asDict() for r in df.collect()), key=lambda r: tuple(str(r[k]) for k in keys))

    g, w = rows(got), rows(want)
    assert len(g) == len(w) and g
    for x, y in zip(g, w):
        assert x.keys() == y.keys() and all(_close(x[k], y[k]) for k in x), (x, y)


def _random(n_pairs, n_minutes, seed=1, gap=0.1):
    rng = random.Random(seed)
    rows = []
    for p in range(1, n_pairs + 1):
        price = 1e6 if p == 1 else 10.0 * p
        for m in range(n_minutes):
            price *= 1 + rng.uniform(-1e-3, 1e-3)
            if rng.random() >= gap or m == n_minutes - 1:
                rows.append((m, p, price, rng.uniform(10, 1000), rng.choice([None, 0, 1.5, -2.0])))
    return rows


def test_merged_moments_equal_those_of_all_rows(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(6), 1e9 + rng.random() if rng.random() > 0.2 else None, rng.random(), rng.choice([None, 1.0, -1.0]), minute(k)) for k in range(200)]
    df = spark.createDataFrame(rows, "part int, price double, liquidity double, fees double, created_at timestamp_ntz")
    parts = df.groupBy("part").agg(*moment_columns()).select("part", F.struct(*PARTIAL).cast(STATE).alias("p"))
    one = parts.agg(F.array_sort(F.collect_list(F.struct("part", "p"))).alias("a")).select(folded(F.transform("a", lambda x: x["p"])).alias("s"))
    whole = df.agg(*moment_columns()).select(F.struct(*PARTIAL).alias("s"))
    got, want = one.select(*statistics("s")).first().asDict(), whole.select(*statistics("s")).first().asDict()
    direct = df.agg(F.stddev_samp("price").alias("d"), F.avg("price").alias("a")).first()
    # Means near 1e9 are known to 1e-7 only, and so are the deviations between them.
    assert all(_close(got[k], want[k]) or got[k] == pytest.approx(want[k], rel=1e-6) for k in want)
    assert got["std_dev_price"] == pytest.approx(direct["d"], rel=1e-6) and got["avg_price"] == pytest.approx(direct["a"], rel=1e-14)


def test_bands_equal_one_timeframe_at_a_time(spark):
    h, p = history(spark, _random(4, 40)), pairs(spark, [(i, f"P{i}", 10, i == 4) for i in range(1, 5)])
    both = M.summaries(h, p, (5, 15, 30, 60))
    for n in (5, 15, 30):
        _same(both.filter(F.col("timeframe") == n).drop("timeframe"), M.summary(h, p, n, method="window"), ["pair_address"])
    assert both.filter("timeframe = 60").count() == 0


def test_peers_at_the_newest_snapshot_have_a_row_each(spark):
    rows = [(m, q, 10 + m, 100 + m, 1) for m in range(6) for q in (1, 2)] + [(5, 1, 20, 300, 2), (5, 1, 12, 100, 0)]
    h, p = history(spark, rows), pairs(spark, [(1, "P1", 10, False), (2, "P2", 10, False)])
    got, want = M.summary(h, p, 5), M.summary(h, p, 5, method="window")
    assert got.count() == 4
    # The window plan leaves open in which order peers follow one another.
    order = ["num_tick_up", "num_tick_down", "pct_tick_up"]
    _same(got.drop(*order), want.drop(*order), ["pair_address", "price", "liquidity"])
    ups = {(r["pair_address"], r["num_tick_up"], r["num_tick_down"]) for r in got.collect()}
    assert ups == {("P1", 2, 1), ("P2", 1, 0)}  # behind 14 the peers are 12, 15, 20


def test_readiness_below_five_snapshots(spark):
    for n, ready in ((0, False), (4, False), (5, True)):
        assert [tuple(r) for r in readiness(history(spark, [(m, 1, 1, 1, 0) for m in range(n)])).collect()] == [(n, ready)]


TFS = (5, 15, 30)


def test_refresh_from_sealed_blocks_equals_a_full_run(spark, scratch):
    t, rows = Tables(scratch + "/t"), _random(3, 50, seed=4)
    p = pairs(spark, [(i, f"P{i}", 10, False) for i in range(1, 4)])
    t.write(p, "pairs", 0)
    for b, (lo, hi) in enumerate([(0, 20), (20, 21), (21, 44), (44, 50)], 1):
        append_history(spark, history(spark, [r for r in rows if lo <= r[0] < hi]), t, b)
        # Blocks of four minutes: T0 is a whole hour, so they start with the first row.
        assert seal_blocks(spark, t, b, 240, TFS) or b == 2
        seen = history(spark, [r for r in rows if r[0] < hi])
        _same(current_summaries(spark, t, b + 1, 240, TFS), M.summaries(seen, p, TFS), ["timeframe", "pair_address"])
    # What a refresh reads of the history: not the sealed blocks within a band.
    sealed = t.sealed(spark, before=5).select("block").distinct().count()
    assert sealed >= 30 / 4 - 2
    # The same batch again changes nothing.
    append_history(spark, history(spark, [r for r in rows if 44 <= r[0] < 50]), t, 4)
    seal_blocks(spark, t, 4, 240, TFS)
    _same(current_summaries(spark, t, 5, 240, TFS), M.summaries(history(spark, rows), p, TFS), ["timeframe", "pair_address"])


def test_late_rows_seal_their_blocks_again(spark, scratch):
    t = Tables(scratch + "/t")
    one = lambda m: {"m": m, "address": "A", "counter": str(3 * m + 10 * (m > 9)), "name": "A-Q", "mint_x": "A", "mint_y": "q", "price": 5.0 + m % 3}
    for b, ms in enumerate(([m for m in range(12) if m != 6], [12], [6], [13]), 1):
        load_snapshot(spark, raw_entries(spark, [one(m) for m in ms]), t, b)
        seal_blocks(spark, t, b, 240, (5, 10))
        whole = M.summaries(t.history(spark), t.pairs(spark), (5, 10))
        _same(current_summaries(spark, t, b + 1, 240, (5, 10)), whole, ["timeframe"])
    again = {(r["block"], r["batch_id"]) for r in t.sealed(spark, before=9).collect()}
    assert max(sum(b == x for b, _ in again) for x, _ in again) == 2

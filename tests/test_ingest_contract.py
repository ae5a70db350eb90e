"""Contract rows C9-C14, C18 and the batch loader (hand-built)."""

from helpers import by_key, minute, raw_entries
from pyspark.sql import functions as F

from tidepool import schema
from tidepool.operators import ingest as I
from tidepool.plans.load import load_snapshot
from tidepool.schema import COUNTERS, PAIRS, TOKENS
from tidepool.sources.tables import Tables, read_or_none


def _empty(spark):
    return (spark.createDataFrame([], TOKENS), spark.createDataFrame([], PAIRS), spark.createDataFrame([], COUNTERS))


def test_first_sight_and_reset(spark):
    raw = raw_entries(spark, [{"m": i, "address": "A", "counter": c} for i, c in enumerate(["100", "130", "20"])])
    _, _, c0 = _empty(spark)
    fees = [r["fees"] for r in I.fee_deltas(I.stage_snapshot(raw), c0).orderBy("created_at").collect()]
    assert fees == [0.0, 30.0, -110.0]  # C9


def test_counter_survives_gaps_across_batches(spark):
    raw1 = raw_entries(spark, [{"m": 0, "address": "A", "counter": "10"}, {"m": 0, "address": "B", "counter": "5"}])
    raw2 = raw_entries(spark, [{"m": 2, "address": "A", "counter": "25"}])
    _, _, c0 = _empty(spark)
    s1, s2 = I.stage_snapshot(raw1), I.stage_snapshot(raw2)
    c1 = I.counter_upsert(s1, c0)
    assert [r["fees"] for r in I.fee_deltas(s2, c1).collect()] == [15.0]
    c2 = {r["pair_id"]: r["cumulative_fee_volume"] for r in I.counter_upsert(s2, c1).collect()}
    assert sorted(c2.values()) == [5.0, 25.0]  # B keeps its old counter


def test_float32_delta(spark):
    raw = raw_entries(spark, [{"m": 0, "address": "A", "counter": "16777216"}, {"m": 1, "address": "A", "counter": "16777217"}])
    _, _, c0 = _empty(spark)
    assert [r["fees"] for r in I.fee_deltas(I.stage_snapshot(raw), c0).collect()] == [0.0, 0.0]  # C10


def test_duplicate_address_keeps_smallest_counter(spark):
    raw = raw_entries(spark, [{"address": "A", "counter": "7", "price": 1.0}, {"address": "A", "counter": "5", "price": 2.0},
                              {"address": "A", "counter": "oops", "price": 3.0}])
    st = I.stage_snapshot(raw).collect()
    assert len(st) == 1 and st[0]["counter"] == 5.0 and st[0]["current_price"] == 2.0  # C11
    assert I.rejected_entries(raw).count() == 1


def test_name_split_on_first_dash(spark):
    raw = raw_entries(spark, [{"address": "A", "name": "A-B"}, {"address": "B", "name": "A-B-C"}, {"address": "C", "name": "AB"}])
    out = {r["address"]: (r["x"], r["y"]) for r in I.stage_snapshot(raw).collect()}
    assert out == {"A": ("A", "B"), "B": ("A", "B-C"), "C": ("AB", None)}  # C12


def test_dimensions_frozen_and_x_symbol_wins(spark):
    raw = raw_entries(
        spark,
        [
            {"m": 0, "address": "P", "name": "SOLX-USDX", "mint_x": "m1", "mint_y": "m2"},
            {"m": 0, "address": "Q", "name": "FOO-BAR", "mint_x": "m3", "mint_y": "m1"},
            {"m": 1, "address": "P", "name": "NEW-NAME", "mint_x": "m1", "mint_y": "m2", "is_blacklisted": True},
        ],
    )
    t0, p0, _ = _empty(spark)
    st = I.stage_snapshot(raw)
    toks = I.new_tokens(st, t0)
    sym = {r["mint"]: r["symbol"] for r in toks.collect()}
    assert sym["m1"] == "SOLX"  # C14: x side wins over Q's y side "BAR"
    prs = by_key(I.new_pairs(st, toks, p0))
    assert prs["P"]["name"] == "SOLX-USDX" and prs["P"]["is_blacklisted"] is False  # C13
    # A later batch cannot change a stored pair or token.
    again = I.new_pairs(st, toks, I.new_pairs(st, toks, p0))
    assert again.count() == 0 and I.new_tokens(st, toks).count() == 0


def test_activity_cutoff_looks_at_last_page_of_batch(spark):
    rows = [{"address": f"A{p}", "page": p, "min_30": 0.0 if p == 1 else 1.0} for p in range(6)]
    kept = I.activity_cutoff(raw_entries(spark, rows))
    assert kept.count() == 6  # C18: a zero on a middle page never stops
    rows[5]["min_30"] = 0.0
    rows.append({"address": "A6", "page": 6})
    kept = I.activity_cutoff(raw_entries(spark, rows))
    assert sorted(r["page"] for r in kept.collect()) == [0, 1, 2, 3, 4, 5]
    rows[2]["min_30"] = 0.0
    assert sorted(r["page"] for r in I.activity_cutoff(raw_entries(spark, rows)).collect()) == [0, 1, 2]


def test_loader_is_replay_safe_and_sums_match(spark, scratch):
    t = Tables(scratch + "/tables")
    rows = [{"m": m, "address": a, "counter": str(c), "name": f"{a}-Q", "mint_x": a, "mint_y": "q"}
            for m, cs in enumerate([(10, 5), (15, 5), (40, 9)]) for a, c in zip(("A", "B"), cs)]
    rows.append({"m": 1, "address": "A", "counter": "n/a", "name": "A-Q", "mint_x": "A", "mint_y": "q"})
    rows.append({"m": 0, "address": "C", "counter": "1", "name": "C", "mint_x": "C", "mint_y": None})
    raw = raw_entries(spark, rows)
    first = F.col("created_at") < F.lit("2024-01-01 12:02:00").cast("timestamp_ntz")
    load_snapshot(spark, raw.filter(first), t, 1)
    before = sorted(t.history(spark).collect())
    load_snapshot(spark, raw.filter(first), t, 1)  # replay batch 1
    assert sorted(t.history(spark).collect()) == before
    load_snapshot(spark, raw.filter(~first), t, 2)
    h = t.history(spark).join(t.pairs(spark).select(F.col("id").alias("pair_id"), "pair_address"), "pair_id")
    sums = {r["pair_address"]: r["s"] for r in h.groupBy("pair_address").agg(F.sum("fees").alias("s")).collect()}
    assert sums == {"A": 30.0, "B": 4.0}  # last counter - first counter
    # C's x mint is stored (mints load on their own); C gets no pair.
    assert t.tokens(spark).count() == 4 and t.pairs(spark).count() == 2
    rejected = sorted((r["address"], r["reason"]) for r in spark.read.parquet(t.path("rejected")).collect())
    assert rejected == [("A", "counter"), ("C", "mint")]
    from tidepool.operators.quality import constraint_report

    rep = constraint_report(t.tokens(spark), t.pairs(spark), t.history(spark), t.counters(spark))
    assert all(r["violations"] == 0 for r in rep.collect())


def _one(m, c, address="A"):
    return {"m": m, "address": address, "counter": c, "name": f"{address}-Q", "mint_x": address, "mint_y": "q"}


def _fees(spark, t):
    names = t.pairs(spark).select(F.col("id").alias("pair_id"), "pair_address")
    return sorted((r["pair_address"], r["created_at"], r["fees"]) for r in t.history(spark).join(names, "pair_id").collect())


def test_late_snapshot_is_merged(spark, scratch):
    t = Tables(scratch + "/late")
    load_snapshot(spark, raw_entries(spark, [_one(0, "10")]), t, 1)
    load_snapshot(spark, raw_entries(spark, [_one(5, "30")]), t, 2)
    load_snapshot(spark, raw_entries(spark, [_one(3, "20"), _one(5, "30")]), t, 3)  # behind minute 5, with a replay
    fees = sorted((r["created_at"].minute, r["fees"]) for r in t.history(spark).collect())
    assert fees == [(0, 0.0), (3, 10.0), (5, 10.0)]
    assert read_or_none(spark, t.path("late")) is None
    repairs = spark.read.parquet(t.path("repairs")).collect()
    assert sorted((r["created_at"].minute, r["fees"], r["is_late"]) for r in repairs) == [(3, 10.0, True), (5, 10.0, False)]
    assert sorted(r["created_at"].minute for r in t.snapshots(spark).collect()) == [0, 3, 5]
    state = t.counters(spark).collect()
    assert [(r["cumulative_fee_volume"], r["updated_at"].minute) for r in state] == [(30.0, 5)]
    assert t.last_loaded(spark) == 3
    # Before the batch, and after another attempt of it, the tables are the same.
    assert sorted((r["created_at"].minute, r["fees"]) for r in t.history(spark, before=3).collect()) == [(0, 0.0), (5, 20.0)]
    load_snapshot(spark, raw_entries(spark, [_one(3, "20"), _one(5, "30")]), t, 3)
    assert sorted((r["created_at"].minute, r["fees"]) for r in t.history(spark).collect()) == fees
    assert t.retain_versions(spark, "counters", keep=1) == [1, 2]
    assert [r["cumulative_fee_volume"] for r in t.counters(spark).collect()] == [30.0]


def test_late_rows_days_back_touch_only_their_dates(spark, scratch):
    day = 24 * 60
    snaps = [_one(d * day + m, str(100 * d + m)) for d in range(12) for m in (0, 1)] + [_one(d * day, str(7 * d + 1), "B") for d in (0, 6, 11)]
    late = [s for s in snaps if s["m"] in (2 * day, 2 * day + 1, 9 * day) or (s["address"], s["m"]) == ("B", 6 * day)]
    # B's row of day 6 has its predecessor days before the oldest late row's day.
    whole, parts = Tables(scratch + "/whole"), Tables(scratch + "/parts")
    load_snapshot(spark, raw_entries(spark, snaps), whole, 1)
    load_snapshot(spark, raw_entries(spark, [s for s in snaps if s not in late]), parts, 1)
    load_snapshot(spark, raw_entries(spark, late[:1] + [_one(12 * day, "9000")]), parts, 2)
    load_snapshot(spark, raw_entries(spark, late[1:]), parts, 3)
    load_snapshot(spark, raw_entries(spark, [_one(12 * day, "9000")]), whole, 2)
    assert _fees(spark, parts) == _fees(spark, whole)
    rewritten = {(r["batch_id"], (r["snapshot_date"] - minute(0).date()).days) for r in spark.read.parquet(parts.path("rewrites")).collect()}
    assert rewritten == {(2, 2), (2, 3), (3, 2), (3, 3), (3, 6), (3, 9), (3, 11)}


def test_first_sight_that_arrives_late(spark, scratch):
    t = Tables(scratch + "/t")
    load_snapshot(spark, raw_entries(spark, [_one(5, "30")]), t, 1)
    load_snapshot(spark, raw_entries(spark, [_one(1, "4"), _one(2, "6")]), t, 2)
    assert [(at.minute, f) for _, at, f in _fees(spark, t)] == [(1, 0.0), (2, 2.0), (5, 24.0)]


def test_quiet_batch_reads_no_history(spark, scratch, monkeypatch):
    t = Tables(scratch + "/t")
    load_snapshot(spark, raw_entries(spark, [_one(0, "1")]), t, 1)
    monkeypatch.setattr(Tables, "facts", None)
    load_snapshot(spark, raw_entries(spark, [_one(1, "2")]), t, 2)


def test_another_attempt_without_rows_leaves_none(spark, scratch):
    t = Tables(scratch + "/t")
    load_snapshot(spark, raw_entries(spark, [_one(0, "1"), _one(0, "x", "B")]), t, 1)
    load_snapshot(spark, raw_entries(spark, []), t, 1)
    for name in ("raw", "rejected", "tokens", "pairs", "history", "snapshots", "counters"):
        assert t._read(spark, name, spark.read.parquet(t.batch_path("raw", 1)).schema if name in ("raw", "rejected") else getattr(schema, "STORED_HISTORY" if name == "history" else name.upper()), None).count() == 0, name


def test_constraint_report_counts_violations(spark):
    import datetime as dt

    from tidepool.operators.quality import constraint_report
    from tidepool.schema import HISTORY

    t0 = dt.datetime(2024, 1, 1)
    tokens = spark.createDataFrame([(1, "m1", "A"), (2, "m1", "B"), (3, None, "C")], "id bigint, mint string, symbol string")
    pairs = spark.createDataFrame(
        [(10, "P", "A-B", 1, 9, 10, 0.1, False, False), (10, "P", "A-B", 1, 2, 10, 0.1, False, False)], PAIRS
    )
    history = spark.createDataFrame([(t0, 10, 1.0, 1.0, 0.0), (t0, 10, 2.0, 1.0, 0.0), (t0, 11, 1.0, 1.0, 0.0)], HISTORY)
    counters = spark.createDataFrame([(10, 1.0, t0), (12, 2.0, t0)], COUNTERS)
    got = {(r["table_name"], r["rule"]): r["violations"] for r in constraint_report(tokens, pairs, history, counters).collect()}
    assert got[("tokens", "null_mint")] == 1
    assert got[("tokens", "duplicate_mint")] == 1
    assert got[("pairs", "duplicate_pair_address")] == 1 and got[("pairs", "duplicate_id")] == 1
    assert got[("pairs", "orphan_mint_y")] == 1 and got[("pairs", "orphan_mint_x")] == 0
    assert got[("pair_history", "orphan_pair")] == 1
    assert got[("pair_history", "duplicate_pair_snapshot")] == 1
    assert got[("counters", "orphan_pair")] == 1

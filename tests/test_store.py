"""The stored tables over many batches: payload, accounting, compaction, folding."""

import datetime as dt
import json
import os

import pytest
from helpers import minute, raw_entries
from pyspark.sql import functions as F

from tidepool.plans.load import load_snapshot
from tidepool.sources.snapshots import read_payload
from tidepool.sources.tables import Tables, read_or_none

DAY = 24 * 60


def _one(m, c, address="A", **kw):
    return {"m": m, "address": address, "counter": c, "name": f"{address}-Q", "mint_x": address, "mint_y": "q", **kw}


def _fees(spark, t):
    names = t.pairs(spark).select(F.col("id").alias("pair_id"), "pair_address")
    return sorted((r["pair_address"], r["created_at"], r["fees"]) for r in t.history(spark).join(names, "pair_id").collect())


ENTRY = {"address": "A", "name": "X-Y", "mint_x": "x", "mint_y": "y", "bin_step": 10, "base_fee_percentage": "0.2",
         "hide": False, "is_blacklisted": False, "cumulative_fee_volume": "1", "current_price": 1.5, "liquidity": 10.0, "fees": {"min_30": 1.0}}


def _payload(folder, pages):
    os.makedirs(folder)
    for name, pairs in pages.items():
        with open(f"{folder}/{name}.json", "w") as fh:
            fh.write(json.dumps({"pairs": pairs}) + "\n")


def test_payload_gets_its_page_and_time_from_the_files(spark, scratch):
    _payload(scratch + "/poll", {"page-0": [ENTRY, dict(ENTRY, address="B")], "page_12": [dict(ENTRY, address="C")], "other": [dict(ENTRY, address="D")]})
    at = "2024-03-01T10:05:00"
    rows = {(r["address"], r["page"], r["created_at"]) for r in read_payload(spark, scratch + "/poll", at).collect()}
    stamp = dt.datetime(2024, 3, 1, 10, 5)
    assert rows == {("A", 0, stamp), ("B", 0, stamp), ("C", 12, stamp), ("D", None, stamp)}
    os.utime(f"{scratch}/poll/page-0.json", (1_700_000_000, 1_700_000_000))
    own = {r["address"]: r["created_at"] for r in read_payload(spark, scratch + "/poll").collect()}
    assert own["A"] == dt.datetime(2023, 11, 14, 22, 13) and own["A"] < own["C"]


def test_load_stamps_what_has_no_time(spark, scratch):
    t = Tables(scratch + "/t")
    raw = raw_entries(spark, [_one(0, "1")])
    load_snapshot(spark, raw.drop("created_at"), t, 1, created_at="2024-01-01T00:00:00")
    load_snapshot(spark, raw.withColumn("created_at", F.lit(None).cast("timestamp_ntz")), t, 2, created_at=dt.datetime(2024, 1, 2))
    load_snapshot(spark, raw.drop("created_at"), t, 3)
    found = sorted(r["created_at"] for r in t.snapshots(spark).collect())
    assert found[:2] == [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)] and abs(found[2] - dt.datetime.now(dt.UTC).replace(tzinfo=None)) < dt.timedelta(days=1)


def test_accounting_names_every_row(spark, scratch):
    t = Tables(scratch + "/t")
    first = [_one(5, "9"), _one(5, "9", "B"), _one(5, "8", "B"), _one(5, "n/a", "C"), _one(5, "1", "D", mint_x=None), _one(5, "1", "E", bin_step=None)]
    first += [_one(5, "1", "F", page=2, min_30=0.0), _one(5, "1", "G", page=3)]  # the cut-off stops behind page 2
    got = load_snapshot(spark, raw_entries(spark, first), t, 1, report=True)
    want = dict(rows_in=8, rejected_counter=1, rejected_bin_step=1, cut=1, duplicate=1, unpaired=1, loaded=3, late=0, replay=0)
    assert {k: v for k, v in got.items() if v or k in want} == want
    got = load_snapshot(spark, raw_entries(spark, [_one(6, "10"), _one(5, "9"), _one(2, "4"), _one(3, "5", "B")]), t, 2, report=True)
    assert {k: v for k, v in got.items() if v} == dict(rows_in=4, loaded=1, late=2, replay=1)
    assert all(sum(v for k, v in r.items() if k != "rows_in") == r["rows_in"] for r in (got,))
    assert load_snapshot(spark, raw_entries(spark, [_one(7, "11")]), t, 3) is None


def _days(spark, t, days, compact, start=0):
    for b in range(start, days * 2):
        snaps = [_one(b * DAY // 2 + 1, str(10 * b + k), a) for k, a in enumerate("ABCD")]
        load_snapshot(spark, raw_entries(spark, snaps), t, b + 1, compact=compact)


def test_compacted_and_folded_store_is_the_same(spark, scratch):
    plain, t = Tables(scratch + "/plain"), Tables(scratch + "/folded")
    _days(spark, plain, 2, False)
    _days(spark, t, 2, True)
    assert _fees(spark, t) == _fees(spark, plain)
    anew = {(r["batch_id"], str(r["snapshot_date"])) for r in spark.read.parquet(t.path("rewrites")).collect()}
    assert len(anew) == 2
    before = {n: sorted(map(tuple, getattr(t, n)(spark).collect())) for n in ("tokens", "pairs", "snapshots", "counters")}
    assert t.fold(spark, keep=1) == [1, 2, 3]
    for n, rows in before.items():
        assert sorted(map(tuple, getattr(t, n)(spark).collect())) == rows, n
    assert _fees(spark, t) == _fees(spark, plain)
    # Replaced folders are gone, folded batches are refused, the others can be loaded again.
    left = [f"{b}/{d}" for b in sorted(os.listdir(t.path("history"))) for d in os.listdir(f"{t.path('history')}/{b}") if d.startswith("snapshot_date")]
    assert len(left) < 4 + len(anew)
    with pytest.raises(ValueError, match="cannot be loaded again"):
        load_snapshot(spark, raw_entries(spark, [_one(0, "1")]), t, 3)
    _days(spark, t, 2, True, start=3)
    assert _fees(spark, t) == _fees(spark, plain)
    assert t.batch_of(spark, "stream", 0) == 5 and t.batch_of(spark, "stream", 0) == 5
    # Folding again replaces the base; late rows still find their neighbours.
    late = [_one(5, "3"), _one(DAY + 3, "25", "B")]
    for s in (t, plain):
        load_snapshot(spark, raw_entries(spark, late), s, 6)
    assert t.fold(spark, keep=1, slack=9) == [] and t.fold(spark, keep=1) == [4]
    assert _fees(spark, t) == _fees(spark, plain)


def test_compacted_files_hold_disjoint_pairs(spark, scratch, monkeypatch):
    from tidepool.plans import load

    monkeypatch.setattr(load, "ROWS_A_FILE", 10)
    t = Tables(scratch + "/t")
    for b, m in enumerate((0, 1, DAY)):
        load_snapshot(spark, raw_entries(spark, [_one(m, str(b), f"P{k}") for k in range(20)]), t, b + 1, compact=True)
    files = spark.read.parquet(t.batch_path("history", 3)).filter(F.col("snapshot_date") == F.lit(minute(0).date()))
    spans = sorted((r["lo"], r["hi"]) for r in files.groupBy(F.input_file_name().alias("f")).agg(F.min("pair_id").alias("lo"), F.max("pair_id").alias("hi")).collect())
    assert len(spans) == 5 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert t.history(spark).count() == 60


def test_state_written_follows_the_batch(spark, scratch):
    t = Tables(scratch + "/t")
    load_snapshot(spark, raw_entries(spark, [_one(0, "1", f"P{k}") for k in range(50)]), t, 1)
    load_snapshot(spark, raw_entries(spark, [_one(1, "2", "P7")]), t, 2)
    assert spark.read.parquet(t.batch_path("counters", 2)).count() == 1
    assert t.counters(spark).count() == 50 and t.counters(spark, before=2).agg(F.max("cumulative_fee_volume")).first()[0] == 1.0
    assert read_or_none(spark, t.path("counters_base")) is None

"""Physical-plan properties the design relies on (checked on a stored history)."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from tidepool.plans import metrics as M
from tidepool.sources import testdata as td
from tidepool.sources.tables import Tables

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    t = Tables(str(tmp_path_factory.mktemp("stored")))
    h = td.events_history(spark, SF).withColumn("snapshot_date", F.to_date("created_at"))
    t.write(h.sortWithinPartitions("snapshot_date", "pair_id"), "history", 1, partition_by=("snapshot_date",))
    return t.history(spark), td.customer_pairs(spark, SF)


def _history_scan(p: str) -> str:
    scans = [b for b in p.split("\n\n") if "Scan parquet" in b and "snapshot_date" in b]
    assert scans, p
    return scans[0]


def test_summary_prunes_and_pushes_down(stored):
    h, p = stored
    txt = plan(M.summary(h, p, 5))
    scan = _history_scan(txt)
    assert re.search(r"PartitionFilters: \[.*snapshot_date.* >= \d{4}-\d\d-\d\d", scan), scan
    assert "GreaterThanOrEqual(created_at," in scan
    assert "ReadSchema: struct<created_at:timestamp_ntz,pair_id:bigint,price:float,liquidity:float,fees:float>" in scan
    # One hash aggregate by pair: no sort-based aggregate, no window.
    assert "SortAggregate" not in txt and "Window" not in txt
    assert "HashAggregate" in txt


def test_detail_reads_one_pair(stored):
    h, p = stored
    scan = _history_scan(plan(M.pair_details(h, p, "Customer#000000007", 5)))
    assert re.search(r"PushedFilters: \[.*(In\(pair_id|EqualTo\(pair_id)", scan), scan


def test_view_windows_share_one_shuffle(stored):
    h, p = stored
    txt = plan(M.metrics_view(h, p, 5))
    top = txt.split("\n\n")[0]
    # Both window levels sit on one sort over the join's pair_id partitioning:
    # the only hash exchanges are the two join sides, none above the join.
    assert top.count("Window") == 2
    shuffles = re.findall(r"Arguments: hashpartitioning\((\w+)#", txt)
    assert shuffles == ["pair_id", "pair_id"], shuffles
    above_join = top.split("Join")[0]
    assert "Exchange" not in above_join


def test_first_rows_need_no_sort_aggregate(spark):
    from tidepool.operators import ingest as I

    raw = td.events_raw_snapshots(spark, SF)
    staged = I.stage_snapshot(raw)
    tokens = spark.createDataFrame([], "id long, mint string, symbol string")
    pairs = spark.createDataFrame([], "pair_address string")
    for df in (staged, I.new_tokens(staged, tokens), I.new_pairs(staged, tokens, pairs)):
        txt = plan(df)
        # A row a key and task goes to the shuffle.
        assert "SortAggregate" not in txt and "WindowGroupLimit" in txt


def test_timeframes_copy_no_facts(stored):
    h, p = stored
    txt = plan(M.summaries(h, p, (5, 15, 30)))
    tree = txt.split("\n\n")[0]
    # Rows are multiplied by timeframe above the aggregates by (pair, band) only.
    assert "SortAggregate" not in txt
    lines = [x for x in tree.splitlines() if "Generate" in x or "HashAggregate" in x]
    generates = [i for i, x in enumerate(lines) if "Generate" in x]
    assert generates and all(any("HashAggregate" in y for y in lines[i:]) for i in generates)


def test_heavy_keys_meet_where_they_lie(spark):
    from tidepool.operators import heavy

    rows = spark.range(20000).selectExpr("IF(id % 10 = 0, id, 7) AS k", "id AS v")
    side = spark.range(20000).selectExpr("id AS k", "id * 2 AS w")
    assert heavy.heavy_keys(rows, "k") == [7]
    joined = heavy.join_heavy(rows, side, "k")
    assert joined.count() == 20000 and joined.filter("w != 2 * k").count() == 0
    assert heavy.join_heavy(rows.filter("k != 7"), side, "k").count() == 2000
    assert heavy.join_heavy(rows.limit(0), side, "k").count() == 0
    txt = plan(joined)
    assert "BroadcastHashJoin" in txt and "Union" in txt

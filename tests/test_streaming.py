"""The foreachBatch loader over snapshot files equals the batch load."""

from helpers import minute, raw_entries
from pyspark.sql import functions as F

from tidepool.sources.tables import Tables
from tidepool.streaming.ingest import ingest_stream


def test_stream_equals_batch(spark, scratch):
    src = scratch + "/feed"
    snaps = [[("A", "10"), ("B", "3")], [("A", "12")], [("A", "20"), ("B", "9")]]
    for m, entries in enumerate(snaps):
        rows = [{"m": m, "address": a, "counter": c, "name": f"{a}-Q", "mint_x": a, "mint_y": "q"} for a, c in entries]
        raw_entries(spark, rows).coalesce(1).write.mode("append").parquet(src)
    # A replayed copy of the second snapshot arrives again.
    raw_entries(spark, [{"m": 1, "address": "A", "counter": "12", "name": "A-Q", "mint_x": "A", "mint_y": "q"}]).coalesce(
        1
    ).write.mode("append").parquet(src)
    t = Tables(scratch + "/tables")
    q = ingest_stream(spark, src, t, scratch + "/ckpt", max_files_per_trigger=1, refresh_summaries=True)
    q.awaitTermination()
    h = t.history(spark).join(t.pairs(spark).select(F.col("id").alias("pair_id"), "pair_address"), "pair_id")
    got = sorted((r["pair_address"], r["created_at"].minute, r["fees"]) for r in h.collect())
    assert got == [("A", 0, 0.0), ("A", 1, 2.0), ("A", 2, 8.0), ("B", 0, 0.0), ("B", 2, 6.0)]
    from tidepool.schema import SUMMARIES

    assert t.summaries(spark).schema == SUMMARIES  # 3 snapshots: no timeframe is eligible yet


def test_staging_stream_reads_json_pages(spark, scratch):
    import json

    from tidepool.operators.ingest import stage_snapshot
    from tidepool.streaming.ingest import stage_stream

    src = scratch + "/pages"
    import os

    os.makedirs(src)
    entry = {"address": "A", "name": "X-Y", "mint_x": "x", "mint_y": "y", "bin_step": 10,
             "base_fee_percentage": "0.2", "hide": False, "is_blacklisted": False,
             "cumulative_fee_volume": "1", "current_price": 1.5, "liquidity": 10.0, "fees": {"min_30": 1.0}}
    docs = [
        {"created_at": "2024-01-01T00:00:00", "page": 0, "pairs": [entry, dict(entry, address="B")]},
        {"created_at": "2024-01-01T00:01:00", "page": 0, "pairs": [dict(entry, cumulative_fee_volume="3")]},
    ]
    for i, doc in enumerate(docs + docs[:1]):  # the first page is delivered twice
        with open(f"{src}/p{i}.json", "w") as fh:
            fh.write(json.dumps(doc) + "\n")
    q = stage_stream(spark, src, scratch + "/staged", scratch + "/ckpt", fmt="json", pages=True,
                     max_files_per_trigger=1)
    q.awaitTermination()
    staged = spark.read.parquet(scratch + "/staged")
    assert staged.count() == 3
    assert stage_snapshot(staged).count() == 3


def test_late_row_and_new_checkpoint_lose_nothing(spark, scratch):
    """Minutes 0, 40, 41, then 5: the late one is merged, and a second
    checkpoint over the same tables takes new batch ids."""
    src, t = scratch + "/feed", Tables(scratch + "/tables")
    for m in (0, 40, 41, 5):
        rows = [{"m": m, "address": "A", "counter": str(10 + m), "name": "A-Q", "mint_x": "A", "mint_y": "q"}]
        raw_entries(spark, rows).coalesce(1).write.mode("append").parquet(src)
    ingest_stream(spark, src, t, scratch + "/ckpt", max_files_per_trigger=1).awaitTermination()
    fees = sorted((r["created_at"].minute, r["fees"]) for r in t.history(spark).collect())
    assert fees == [(0, 0.0), (5, 5.0), (40, 35.0), (41, 1.0)]
    ingest_stream(spark, src, t, scratch + "/ckpt2", max_files_per_trigger=4).awaitTermination()
    assert sorted((r["created_at"].minute, r["fees"]) for r in t.history(spark).collect()) == fees
    assert spark.read.parquet(t.path("raw")).count() == 8


def _staged(spark, folder):
    return sorted((r["created_at"], r["address"], r["cumulative_fee_volume"]) for r in spark.read.parquet(folder).collect())


def test_staging_stream_with_late_rows_and_replays(spark, scratch):
    """Rows far behind the watermark leave by the side exit: the new ones are kept
    once, the stored ones dropped; a second stream adds nothing."""
    from tidepool.streaming.ingest import stage_stream

    day = 24 * 60
    entry = lambda m, c="1", a="A": {"m": m, "address": a, "counter": c}
    files = [
        [entry(0), entry(0, a="B")],
        [entry(5 * day), entry(5 * day)],  # a repeat within a file
        [entry(5 * day), entry(5 * day + 1)],  # a replay within the delay
        [entry(0), entry(1 * day), entry(1 * day), entry(5 * day, "2")],  # behind: a replay, and a late row twice
        [entry(1 * day), entry(6 * day)],  # behind: a replay of the late row
    ]
    for f in files:
        raw_entries(spark, f).coalesce(1).write.mode("append").parquet(scratch + "/feed")
    want = sorted({(minute(e["m"]), e["address"], e["counter"]) for f in files for e in f})
    for checkpoint in ("/one", "/two"):
        stage_stream(spark, scratch + "/feed", scratch + "/staged", scratch + checkpoint, max_files_per_trigger=1, state_partitions=2).awaitTermination()
        assert _staged(spark, scratch + "/staged") == want
    # New files go on where the first stream ended.
    raw_entries(spark, [entry(2 * day), entry(6 * day), entry(7 * day)]).coalesce(1).write.mode("append").parquet(scratch + "/feed")
    stage_stream(spark, scratch + "/feed", scratch + "/staged", scratch + "/one", max_files_per_trigger=1, state_partitions=2).awaitTermination()
    assert _staged(spark, scratch + "/staged") == sorted([*want, (minute(2 * day), "A", "1"), (minute(7 * day), "A", "1")])


def _page_files(folder):
    """A whole page, a truncated one, one with a field of a wrong type, one
    without pairs, and two entries that lack their address."""
    import json
    import os

    os.makedirs(folder)
    entry = {"address": "A", "name": "X-Y", "mint_x": "x", "mint_y": "y", "bin_step": 10,
             "base_fee_percentage": "0.2", "hide": False, "is_blacklisted": False,
             "cumulative_fee_volume": "1", "current_price": 1.5, "liquidity": 10.0, "fees": {"min_30": 1.0}}
    no_address = {k: v for k, v in entry.items() if k != "address"}
    at = {"created_at": "2024-01-01T00:00:00", "page": 0}
    docs = [
        json.dumps(at | {"pairs": [entry, no_address, dict(no_address, name="P-Q")]}),
        json.dumps(at | {"page": 1, "pairs": [dict(entry, address="B"), dict(entry, address="C")]})[:-150],
        json.dumps(at | {"page": 2, "pairs": [dict(entry, address="D", bin_step="ten"), dict(entry, address="E")]}),
        json.dumps(at | {"page": 3}),
        json.dumps(at | {"page": 4, "pairs": []}),
    ]
    for i, doc in enumerate(docs):
        with open(f"{folder}/p{i}.json", "w") as fh:
            fh.write(doc + "\n")
    return docs


def test_corrupt_pages_and_entries_without_address_are_rejected(spark, scratch):
    from tidepool.plans.load import load_snapshot
    from tidepool.sources.snapshots import read_pages

    docs = _page_files(scratch + "/pages")
    by_batch, by_stream = Tables(scratch + "/batch"), Tables(scratch + "/stream")
    load_snapshot(spark, read_pages(spark, scratch + "/pages"), by_batch, 1)
    ingest_stream(spark, scratch + "/pages", by_stream, scratch + "/ckpt", fmt="json", pages=True, max_files_per_trigger=1).awaitTermination()
    for t in (by_batch, by_stream):
        rejected = spark.read.parquet(t.path("rejected")).collect()
        assert {r["_corrupt_record"] for r in rejected if r["reason"] == "json"} == {docs[1], docs[2]}
        assert sorted(r["name"] for r in rejected if r["reason"] == "address" and r["name"]) == ["P-Q", "X-Y"]
        assert {r["page"] for r in rejected if r["reason"] == "address"} == {0, 3}
        assert [r["address"] for r in rejected if r["reason"] == "bin_step"] == ["D"]
        assert {"A", "E"} <= {r["pair_address"] for r in t.pairs(spark).collect()} <= {"A", "B", "E"}


def test_staging_keeps_entries_without_a_whole_key(spark, scratch):
    from tidepool.streaming.ingest import stage_stream

    docs = _page_files(scratch + "/pages")
    stage_stream(spark, scratch + "/pages", scratch + "/staged", scratch + "/ckpt", fmt="json", pages=True, max_files_per_trigger=2).awaitTermination()
    rows = spark.read.parquet(scratch + "/staged").collect()
    assert sorted(r["name"] for r in rows if r["address"] is None and r["name"]) == ["P-Q", "X-Y"]
    assert {r["_corrupt_record"] for r in rows} >= {docs[1], docs[2]}


def test_corrupt_json_entries_are_rejected(spark, scratch):
    import os

    from tidepool.operators.ingest import rejected_entries
    from tidepool.sources.snapshots import read_entries

    os.makedirs(scratch + "/entries")
    with open(scratch + "/entries/e.json", "w") as fh:
        fh.write('{"created_at": "2024-01-01T00:00:00", "page": 0, "addr\n')
    assert [r["reason"] for r in rejected_entries(read_entries(spark, scratch + "/entries", "json")).collect()] == ["json"]


def test_registered_view_follows_loads_and_inserts(spark, scratch):
    from helpers import history, minute, pairs

    from tidepool.plans.load import load_snapshot
    from tidepool.plans.views import VIEWS, register_views

    def seen():
        return sorted((r["dttm"], r["num_minutes"]) for r in spark.sql("SELECT dttm, num_minutes FROM v_pair_history").collect())

    def load(m):
        load_snapshot(spark, raw_entries(spark, [{"m": m, "address": "A", "counter": str(m), "name": "A-Q"}]), t, m + 1)

    t = Tables(scratch + "/tables")
    load(0)
    register_views(spark, t.history(spark), t.pairs(spark), n=2)
    assert seen() == [(minute(0), 1)]
    load(1)
    load(2)
    assert seen() == [(minute(1), 1), (minute(2), 2)]
    assert spark.sql("SELECT * FROM pair_history").count() == 3
    # A table of the catalog.
    try:
        history(spark, [(0, 1, 10, 2000, 1)]).write.option("path", scratch + "/h").saveAsTable("view_test_history")
        register_views(spark, spark.table("view_test_history"), pairs(spark, [(1, "P1", 10, False)]), n=2)
        assert seen() == [(minute(0), 1)]
        history(spark, [(m, 1, 10, 2000, 1) for m in (1, 2)]).write.insertInto("view_test_history")
        assert seen() == [(minute(1), 1), (minute(2), 2)]
    finally:
        spark.sql("DROP TABLE IF EXISTS view_test_history")
        for name in VIEWS:
            spark.catalog.dropTempView(name)

"""Queries whose files and tasks must follow the input: no task that takes a whole
feed, no file for each of very many small pages, no key that meets in one task."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from tidepool.operators import ingest as I
from tidepool.operators.quality import constraint_report
from tidepool.plans import catalog
from tidepool.schema import COUNTERS
from tidepool.sources import testdata as td
from tidepool.sources.snapshots import read_payload


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """Events of 200 users (8 pages) on 30 days."""
    root = str(tmp_path_factory.mktemp("made"))
    n = F.col("id")
    spark.range(1200).select(
        n.alias("event_id"), F.expr("timestamp_ntz'2024-01-01 10:00:00' + make_dt_interval(cast(id % 30 as int))").alias("ts"), (n * 7 % 200).alias("user_id"),
        F.when(n % 3 == 0, "purchase").when(n % 3 == 1, "error").otherwise("view").alias("event_type"), (n % 97 + 0.25).alias("value"),
        F.format_string('{"k": %d}', n % 50).alias("props"),
    ).write.parquet(f"{root}/events.parquet")
    spark.range(200).select(
        n.alias("c_custkey"), F.format_string("Customer#%09d", "id").alias("c_name"), (n % 25).cast("int").alias("c_nationkey"),
        (n * 10.0 - 300).alias("c_acctbal"), F.element_at(F.array(*map(F.lit, ("BUILDING", "AUTOMOBILE", "HOUSEHOLD"))), (n % 3 + 1).cast("int")).alias("c_mktsegment"),
    ).write.parquet(f"{root}/customer.parquet")
    spark.range(25).select(n.cast("int").alias("n_nationkey"), F.format_string("NATION_%d", "id").alias("n_name")).write.parquet(f"{root}/nation.parquet")
    return root


@pytest.fixture
def spread(spark):
    """As many tasks as partitions, however small they are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _lines(df):
    return df._jdf.queryExecution().optimizedPlan().toString().split("\n")


def test_pages_kept_many_in_a_file(spark, made, scratch, monkeypatch):
    monkeypatch.setattr(catalog, "checkpoint_dir", lambda s: scratch)
    raw = td.events_raw_snapshots(spark, made)
    want = I.fee_deltas(I.stage_snapshot(I.activity_cutoff(raw)), spark.createDataFrame([], COUNTERS)).select("created_at", "address", "price", "fees")
    got = catalog.QUERIES["load_pages"](spark, made).select("created_at", "pair_address", "price", "fees")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    files = glob.glob(f"{scratch}/tidepool-pages-*/feed/*/**/*.json", recursive=True)
    assert 0 < len(files) < raw.select("created_at", "page").distinct().count()


def test_payload_page_of_a_kept_path(spark, scratch):
    with open(f"{scratch}/poll.json", "w") as fh:
        for page, address in ((3, "A"), (14, "B")):
            fh.write(json.dumps({"file_path": f"day=2024-01-01/page={page}/page.json", "pairs": [{"address": address}]}) + "\n")
    rows = {(r["address"], r["page"]) for r in read_payload(spark, f"{scratch}/poll.json", "2024-01-01").collect()}
    assert rows == {("A", 3), ("B", 14)}


def test_ingest_feed_of_many_files_in_four_epochs(spark, made, scratch, monkeypatch, spread):
    monkeypatch.setattr(catalog, "checkpoint_dir", lambda s: scratch)
    got = catalog.QUERIES["stream_counters"](spark, made).collect()
    staged = I.stage_snapshot(td.events_raw_snapshots(spark, made))
    want = staged.groupBy("address").agg(F.max_by("counter", "created_at").cast("double"), F.max("created_at"))
    assert sorted(map(tuple, got)) == sorted(map(tuple, want.collect()))
    assert len(glob.glob(f"{scratch}/tidepool-ingest-*/feed/*.parquet")) > 4
    assert len(glob.glob(f"{scratch}/tidepool-ingest-*/tables/epochs/batch_id=*")) == 4


def test_orphans_meet_as_distinct_keys(spark, made):
    feed = td.events_dirty_feed(spark, made)
    lines = _lines(constraint_report(*td.unguarded_tables(feed), raw=feed))
    joins = [i for i, x in enumerate(lines) if "Join LeftAnti" in x]
    assert len(joins) == 4 and all("Aggregate" in lines[i + 1] for i in joins)


def test_scores_join_a_row_a_user(spark, made):
    lines = _lines(td.nation_score_payloads(spark, made))
    join = next(i for i, x in enumerate(lines) if "Join Inner, (user_id" in x)
    assert any("Aggregate [user_id" in x for x in lines[join:])


def test_staging_feed_of_many_files_an_epoch_a_part(spark, made, scratch, monkeypatch, spread):
    monkeypatch.setattr(catalog, "checkpoint_dir", lambda s: scratch)
    got = catalog.QUERIES["stream_fee_delta"](spark, made).select("created_at", "pair_address", "price", "fees").collect()
    want = I.fee_deltas(I.stage_snapshot(td.events_raw_snapshots(spark, made)), spark.createDataFrame([], COUNTERS)).select("created_at", "address", "price", "fees")
    assert sorted(map(tuple, got)) == sorted(map(tuple, want.collect()))
    assert len(glob.glob(f"{scratch}/tidepool-stream-*/feed/*.parquet")) > 5
    # The four parts; of the replayed one nothing is kept.
    assert len({p.rsplit("/", 1)[1] for p in glob.glob(f"{scratch}/tidepool-stream-*/staged/entry_date=*/owner=*/epoch=*")}) == 4

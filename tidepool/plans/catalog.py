"""Named queries over the driver's tables: ``name -> f(spark, sf_dir)``.

Each entry reads the generated parquet tables through the mappings in
``tidepool.sources.testdata`` and runs one library plan on the whole tables.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators import ingest as I
from tidepool.operators import snapshots as SN
from tidepool.operators.filters import opportunities
from tidepool.operators.quality import constraint_report
from tidepool.operators.reshape import FEE_LIQUIDITY_LABELS, PRICE_FEES_LABELS, chart_series, legend_rows, price_axis
from tidepool.operators.tokens import base_tokens, token_scores
from tidepool.plans import metrics as M
from tidepool.plans.dashboard import freshness, pair_header
from tidepool.plans.load import load_snapshot
from tidepool.plans.refresh import current_summaries
from tidepool.plans.views import pair_row, register_views
from tidepool.schema import COUNTERS, PAIRS, RAW_ENTRY
from tidepool.session import checkpoint_dir
from tidepool.sources import testdata as td
from tidepool.sources.snapshots import export, read_entries, read_payload
from tidepool.sources.tables import Tables
from tidepool.streaming.ingest import history_stream, ingest_stream, stage_stream

# The pools whose detail series the catalog shows.
DETAIL_CUSTOMER = "Customer#000000007"
DETAIL_SUPPLIER = "Supplier#000000003"
ROW_SUPPLIER = "Supplier#000000006"

Query = Callable[[SparkSession, str], DataFrame]


def _ev(spark: SparkSession, sf_dir: str):
    return td.events_history(spark, sf_dir), td.customer_pairs(spark, sf_dir)


def _li(spark: SparkSession, sf_dir: str):
    return td.lineitem_history(spark, sf_dir), td.supplier_pairs(spark, sf_dir)


def _summary(n: int, **kw) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return M.summary(*_ev(spark, sf_dir), n, **kw)

    return q


QUERIES: dict[str, Query] = {
    "summary_5": _summary(5),
    "summary_15": _summary(15),
    "summary_30": _summary(30),
    "summary_30_window": _summary(30, method="window"),
    "summary_30_series": _summary(30, second_level="series"),
    "summary_60_lineitem": lambda s, d: M.summary(*_li(s, d), 60),
    "summaries_all": lambda s, d: M.summaries(*_ev(s, d)),
    "summaries_all_lineitem": lambda s, d: M.summaries(*_li(s, d)),
    "pair_details": lambda s, d: M.pair_details(*_ev(s, d), DETAIL_CUSTOMER, 30),
    "pair_details_lineitem": lambda s, d: M.pair_details(*_li(s, d), DETAIL_SUPPLIER, 60),
    "metrics_view_60": lambda s, d: M.metrics_view(*_li(s, d), 60),
    "metrics_view_events": lambda s, d: M.metrics_view(*_ev(s, d), 60),
}


# ---------------------------------------------------------------------------
# Ingest path over the events feed, loaded as two batches split on a day.
# ---------------------------------------------------------------------------


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.stage_snapshot(td.events_raw_snapshots(spark, sf_dir))


_LOADED: dict[tuple[str, str], Tables] = {}


def _loaded(spark: SparkSession, sf_dir: str) -> Tables:
    """Load the events feed with ``load_snapshot`` as two batches split on a day.

    The tables are written under the session's shared checkpoint folder, once
    per application and scale, and read back by the ingest queries.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LOADED:
        root = f"{checkpoint_dir(spark)}/tidepool-load-{uuid.uuid4().hex}"
        tables = Tables(root)
        raw = td.events_raw_snapshots(spark, sf_dir)
        split = F.col("created_at") < F.lit(td.EVENTS_SPLIT_DAY).cast("timestamp_ntz")
        load_snapshot(spark, raw.filter(split), tables, 1, cutoff=False)
        load_snapshot(spark, raw.filter(~split), tables, 2, cutoff=False)
        _LOADED[key] = tables
    return _LOADED[key]


# The first days of parts of the events feed, and the order in which
# ``late_merged`` loads them: two parts arrive after newer ones.
LATE_PARTS = ("2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22")
LATE_ORDER = (0, 2, 1, 3)


def _parts(raw: DataFrame, order: tuple[int, ...]) -> list[DataFrame]:
    """The feed in parts of whole days, in the order given."""
    at = F.col("created_at")
    lows = [F.lit(d).cast("timestamp_ntz") for d in LATE_PARTS]
    inside = [(at >= low if k else F.lit(True)) & (at < lows[k + 1] if k + 1 < len(lows) else F.lit(True)) for k, low in enumerate(lows)]
    return [raw.filter(inside[k]) for k in order]


def _delivery(spark: SparkSession, sf_dir: str, root: str) -> list[DataFrame]:
    """The events feed in its parts as they arrive, one late: the feed is computed
    once, by all tasks, and its parts are read from that copy."""
    raw = td.events_raw_snapshots(spark, sf_dir)
    raw.write.parquet(f"{root}/delivery")
    return _parts(spark.read.schema(raw.schema).parquet(f"{root}/delivery"), LATE_ORDER)


def _q_late_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days loaded in another order than theirs: late rows are merged into the
    history, so its rows are those of ``fee_delta``."""
    tables = Tables(f"{checkpoint_dir(spark)}/tidepool-late-{uuid.uuid4().hex}")
    for batch_id, part in enumerate(_parts(td.events_raw_snapshots(spark, sf_dir), LATE_ORDER), 1):
        load_snapshot(spark, part, tables, batch_id, cutoff=False)
    return _history_by_pair(spark, tables)


def _pair_names(spark: SparkSession, t: Tables) -> DataFrame:
    return t.pairs(spark).select(F.col("id").alias("pair_id"), "pair_address")


def _q_activity_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = I.activity_cutoff(td.events_raw_snapshots(spark, sf_dir))
    return kept.select(
        "created_at", "page", "address", "cumulative_fee_volume", "current_price", F.col("fees.min_30").alias("min_30")
    )


def _q_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _staged(spark, sf_dir)
    return s.select(
        "created_at",
        "address",
        F.col("counter").cast("double").alias("cumulative_fee_volume"),
        "current_price",
        "liquidity",
        "name",
        "x",
        "y",
        "mint_x",
        "mint_y",
        "bin_step",
        F.col("base_fee_percentage").cast("double").alias("base_fee_percentage"),
        "hide",
        "is_blacklisted",
    )


def _q_new_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _loaded(spark, sf_dir)
    return spark.read.parquet(t.path("tokens")).select("mint", "symbol", F.col("batch_id").cast("int").alias("batch"))


def _q_new_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _loaded(spark, sf_dir)
    tok = t.tokens(spark)
    tx = tok.select(F.col("id").alias("mint_x_id"), F.col("mint").alias("mint_x"))
    ty = tok.select(F.col("id").alias("mint_y_id"), F.col("mint").alias("mint_y"))
    pairs = spark.read.parquet(t.path("pairs"))
    return pairs.join(tx, "mint_x_id").join(ty, "mint_y_id").select(
        "pair_address",
        "name",
        "mint_x",
        "mint_y",
        "bin_step",
        F.col("base_fee_percentage").cast("double").alias("base_fee_percentage"),
        "hide",
        "is_blacklisted",
        F.col("batch_id").cast("int").alias("batch"),
    )


def _q_fee_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history_by_pair(spark, _loaded(spark, sf_dir))


def _history_by_pair(spark: SparkSession, t: Tables) -> DataFrame:
    return t.history(spark).join(_pair_names(spark, t), "pair_id").select(
        "created_at",
        "pair_address",
        F.col("price").cast("double").alias("price"),
        F.col("liquidity").cast("double").alias("liquidity"),
        F.col("fees").cast("double").alias("fees"),
    )


def _q_counter_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _loaded(spark, sf_dir)
    return t.counters(spark).join(_pair_names(spark, t), "pair_id").select(
        "pair_address", F.col("cumulative_fee_volume").cast("double").alias("cumulative_fee_volume")
    )


def _q_constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _loaded(spark, sf_dir)
    return constraint_report(
        t.tokens(spark), t.pairs(spark), t.history(spark), t.counters(spark), raw=td.events_raw_snapshots(spark, sf_dir)
    )


QUERIES.update(
    {
        "activity_cutoff": _q_activity_cutoff,
        "stage_snapshot": _q_stage,
        "new_tokens": _q_new_tokens,
        "new_pairs": _q_new_pairs,
        "fee_delta": _q_fee_delta,
        "late_merged": _q_late_merged,
        "counter_upsert": _q_counter_upsert,
        "constraint_report": _q_constraint_report,
    }
)


# ---------------------------------------------------------------------------
# Snapshot axis, sub-operators of the metrics, dashboard data.
# ---------------------------------------------------------------------------


# A user filter model exercising ranges, text and OR conditions.
CUSTOM_FILTER = {
    "filterModel": {
        "liquidity": {"filterType": "number", "type": "inRange", "filter": 100, "filterTo": 900},
        "name": {
            "filterType": "text",
            "operator": "OR",
            "conditions": [
                {"filterType": "text", "type": "contains", "filter": "build"},
                {"filterType": "text", "type": "endsWith", "filter": "_3"},
            ],
        },
        "pct_minutes_with_volume": {"filterType": "number", "type": "greaterThanOrEqual", "filter": 20},
    }
}

# The "now" of the freshness line in the catalog.
FRESHNESS_AS_OF = _dt.datetime(2024, 1, 31, 0, 7, 30)

RUNNING_STATS = ("dttm", "pair_address", "num_minutes", "avg_price", "cumulative_fees", "avg_liquidity",
                 "liquidity_std_dev", "num_minutes_with_volume")
TICKS = ("dttm", "pair_address", "price", "num_tick_up", "num_tick_down", "pct_tick_up")
PRICE_RANGE_BINS = ("dttm", "pair_address", "bin_step", "min_price", "max_price", "pct_price_range", "bins_range",
                    "num_positions_range", "pct_below_max", "bins_below_max", "near_max")
VOLATILITY = ("dttm", "pair_address", "liquidity_volatility_ratio", "std_dev_price", "price_volatility_ratio",
              "std_dev_pct_geek_fees_liquidity_24h", "pct_geek_fees_liquidity_24h_volatility_ratio")


def _view_cols(cols) -> Query:
    return lambda s, d: M.metrics_view(*_ev(s, d), 30).select(*cols)


def _events_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base_tokens(
        td.customer_pairs(spark, sf_dir),
        td.customer_tokens(spark, sf_dir),
        quote_mints=td.EVENTS_QUOTE_MINTS,
        preferred=(td.EVENTS_QUOTE_MINTS[0], td.EVENTS_QUOTE_MINTS[2]),
    )


def _details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.pair_details(*_ev(spark, sf_dir), DETAIL_CUSTOMER, 30)


QUERIES.update(
    {
        "update_count": lambda s, d: SN.update_count(td.events_history(s, d)),
        "eligible_timeframes": lambda s, d: SN.eligible_timeframes(td.events_history(s, d)),
        "eligible_timeframes_lineitem": lambda s, d: SN.eligible_timeframes(td.lineitem_history(s, d)),
        "latest_snapshots": lambda s, d: SN.latest_snapshots(td.events_history(s, d), 15).select(
            "created_at", "recency"
        ),
        "running_stats": _view_cols(RUNNING_STATS),
        "ticks": _view_cols(TICKS),
        "price_range_bins": _view_cols(PRICE_RANGE_BINS),
        "volatility": _view_cols(VOLATILITY),
        "base_tokens": _events_base,
        "token_scores": lambda s, d: token_scores(td.nation_score_payloads(s, d)),
        "opportunities": lambda s, d: opportunities(M.summary(*_li(s, d), 60)),
        "opportunities_custom": lambda s, d: opportunities(M.summary(*_ev(s, d), 15), CUSTOM_FILTER),
        "chart_fee_liquidity": lambda s, d: chart_series(_details(s, d), FEE_LIQUIDITY_LABELS),
        "chart_price_fees": lambda s, d: chart_series(_details(s, d), PRICE_FEES_LABELS),
        "price_axis": lambda s, d: price_axis(_details(s, d)),
        "pair_header": lambda s, d: pair_header(
            M.summary(*_ev(s, d), 30), _events_base(s, d), token_scores(td.nation_score_payloads(s, d))
        ),
        "freshness": lambda s, d: freshness(td.events_history(s, d), M.summary(*_ev(s, d), 30), FRESHNESS_AS_OF),
    }
)


# ---------------------------------------------------------------------------
# Streaming: the events feed replayed through the staging stream.
# ---------------------------------------------------------------------------


# Fixed value: the replayed day.
STREAM_REPLAY_DAY = "2024-01-20"


def _q_stream_fee_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed files, some of them late by more than the state's delay, and a replayed
    day -> staging stream (replays dropped, late rows kept) -> batch staging and
    counter deltas.  Same rows as ``fee_delta``."""
    root = f"{checkpoint_dir(spark)}/tidepool-stream-{uuid.uuid4().hex}"
    parts = _delivery(spark, sf_dir, root)
    day = F.col("created_at") == F.lit(STREAM_REPLAY_DAY).cast("timestamp_ntz")
    again = spark.read.schema(parts[0].schema).parquet(f"{root}/delivery").filter(day)
    # A part is an epoch, however many files it has: the stream takes what has come
    # and goes on from its checkpoint.
    for part in (*parts, again):
        part.write.mode("append").parquet(f"{root}/feed")
        q = stage_stream(spark, f"{root}/feed", f"{root}/staged", f"{root}/_checkpoint", delay="2 days", state_partitions=8)
        q.awaitTermination()
    staged = I.stage_snapshot(spark.read.parquet(f"{root}/staged"))
    empty = spark.createDataFrame([], COUNTERS)
    h = I.fee_deltas(staged, empty)
    return h.select(
        "created_at",
        F.col("address").alias("pair_address"),
        F.col("price").cast("double").alias("price"),
        F.col("liquidity").cast("double").alias("liquidity"),
        F.col("fees").cast("double").alias("fees"),
    )


# Fixed value: blocks of four days for a history of daily snapshots.
STREAM_BLOCK_SECONDS = 4 * 86400
# Fixed value: epochs between two refreshes of the summaries.
STREAM_REFRESH_EVERY = 10


def _q_stream_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events history fed to ``history_stream`` snapshot by snapshot (30 epochs),
    blocks sealed on the way; the summaries are those of the last refresh.  Same
    rows as ``summaries_all``."""
    root = f"{checkpoint_dir(spark)}/tidepool-current-{uuid.uuid4().hex}"
    history = td.events_history(spark, sf_dir)
    # One file a snapshot.
    day = F.col("created_at").cast("date").alias("day")
    history.repartition("created_at").select("*", day).write.partitionBy("day").parquet(f"{root}/feed")
    tables = Tables(f"{root}/tables")
    pairs = td.customer_pairs(spark, sf_dir).select(*PAIRS.fieldNames())
    tables.write(pairs, "pairs", 0)
    q = history_stream(
        spark, f"{root}/feed", tables, f"{root}/_checkpoint", max_files_per_trigger=1,
        block_seconds=STREAM_BLOCK_SECONDS, refresh_every=STREAM_REFRESH_EVERY,
    )
    q.awaitTermination()
    return current_summaries(spark, tables, tables.last_loaded(spark) + 1, STREAM_BLOCK_SECONDS)


def _q_summary_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with several rows at the newest snapshot: a summary row for each."""
    return M.summary(td.events_history_peers(spark, sf_dir), td.customer_pairs(spark, sf_dir), 15)


QUERIES.update(
    {
        "stream_fee_delta": _q_stream_fee_delta,
        "stream_summaries": _q_stream_summaries,
        "summary_duplicates": _q_summary_duplicates,
        "readiness": lambda s, d: SN.readiness(td.events_history(s, d)),
        "readiness_young": lambda s, d: SN.readiness(td.events_history_young(s, d)),
    }
)


# ---------------------------------------------------------------------------
# The payload as the feed delivers it, a dirty feed accounted for, and an export.
# ---------------------------------------------------------------------------


def _q_load_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day's pages written as ``{pairs: [...]}`` files (kept many in one, each
    beside its path), read as that day's poll (page from the file's path, snapshot from
    the argument) and loaded with the activity cut-off."""
    root = f"{checkpoint_dir(spark)}/tidepool-pages-{uuid.uuid4().hex}"
    raw = td.events_raw_snapshots(spark, sf_dir)
    day = F.col("created_at").cast("date").cast("string").alias("day")
    pages = raw.groupBy(day, "page").agg(F.collect_list(F.struct(*RAW_ENTRY.fieldNames())).alias("pairs"))
    path = F.format_string("day=%s/page=%d/page.json", "day", "page").alias("file_path")
    pages.select("day", path, "pairs").write.partitionBy("day").json(f"{root}/feed")
    # The days are those of the folders: no file is opened.
    folders = spark.read.format("binaryFile").load(f"{root}/feed").select(F.col("day").cast("string")).distinct()
    days = [r["day"] for r in folders.collect()]
    polls = [read_payload(spark, f"{root}/feed/day={d}", created_at=d) for d in sorted(days)]
    tables = Tables(f"{root}/tables")
    load_snapshot(spark, reduce(DataFrame.unionByName, polls), tables, 1)
    return _history_by_pair(spark, tables)


def _q_load_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of a feed that breaks every rule, late rows and replays included:
    where each row went, counted while the batches were written."""
    tables = Tables(f"{checkpoint_dir(spark)}/tidepool-dirty-{uuid.uuid4().hex}")
    feed = td.events_dirty_feed(spark, sf_dir)
    found = []
    for batch in (1, 2):
        part = feed.filter(F.col("batch") == batch).drop("batch")
        counts = load_snapshot(spark, part, tables, batch, report=True)
        found += [(batch, outcome, int(n)) for outcome, n in counts.items()]
    return spark.createDataFrame(found, "batch int, outcome string, rows long")


def _q_constraint_report_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = td.events_dirty_feed(spark, sf_dir)
    return constraint_report(*td.unguarded_tables(feed), raw=feed)


def _q_export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary exported as CSV (S13) and read back."""
    out = M.summary(*_ev(spark, sf_dir), 30)
    path = f"{checkpoint_dir(spark)}/tidepool-export-{uuid.uuid4().hex}"
    export(out, path)
    return spark.read.schema(out.schema).option("header", True).csv(path)


def _q_stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events feed loaded by ``ingest_stream`` in four epochs, one of them late:
    the counter state merged from its changes (T2, T3)."""
    root = f"{checkpoint_dir(spark)}/tidepool-ingest-{uuid.uuid4().hex}"
    tables = Tables(f"{root}/tables")
    # A part is an epoch, however many files it has: the stream takes what has come
    # and goes on from its checkpoint.
    for part in _delivery(spark, sf_dir, root):
        # All in one page batch: the cut-off keeps them.
        part.withColumn("page", F.lit(0)).write.mode("append").parquet(f"{root}/feed")
        ingest_stream(spark, f"{root}/feed", tables, f"{root}/_checkpoint").awaitTermination()
    return tables.counters(spark).join(_pair_names(spark, tables), "pair_id").select(
        "pair_address", F.col("cumulative_fee_volume").cast("double").alias("cumulative_fee_volume"), "updated_at"
    )


QUERIES.update(
    {
        "load_pages": _q_load_pages,
        "load_accounting": _q_load_accounting,
        "constraint_report_dirty": _q_constraint_report_dirty,
        "export_roundtrip": _q_export_roundtrip,
        "stream_counters": _q_stream_counters,
    }
)


# ---------------------------------------------------------------------------
# Metrics over the tables written by the loader (ingest -> metrics), reading
# the time axis from the per-snapshot table instead of the fact table.
# ---------------------------------------------------------------------------


def _loaded_inputs(spark: SparkSession, sf_dir: str):
    t = _loaded(spark, sf_dir)
    return t.history(spark), t.pairs(spark), t.snapshots(spark)


def _q_summary_loaded(n: int) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        h, p, s = _loaded_inputs(spark, sf_dir)
        return M.summary(h, p, n, snapshots=s)

    return q


def _q_summaries_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    h, p, s = _loaded_inputs(spark, sf_dir)
    return M.summaries(h, p, snapshots=s)


QUERIES.update(
    {
        "summary_loaded_15": _q_summary_loaded(15),
        "summaries_loaded": _q_summaries_loaded,
        "update_count_loaded": lambda s, d: SN.update_count(_loaded(s, d).snapshots(s)),
    }
)


def _q_stage_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw feed written as JSON lines and read back through the feed
    reader (S1), then staged: same rows as ``stage_snapshot``."""
    root = f"{checkpoint_dir(spark)}/tidepool-json-{uuid.uuid4().hex}"
    td.events_raw_snapshots(spark, sf_dir).write.json(root)
    staged = I.stage_snapshot(read_entries(spark, root, fmt="json"))
    return staged.select(
        "created_at",
        "address",
        F.col("counter").cast("double").alias("cumulative_fee_volume"),
        "current_price",
        "liquidity",
        "name",
        "x",
        "y",
        "mint_x",
        "mint_y",
        "bin_step",
        F.col("base_fee_percentage").cast("double").alias("base_fee_percentage"),
        "hide",
        "is_blacklisted",
    )


QUERIES["stage_snapshot_json"] = _q_stage_json


def _q_view_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The named view (S12) queried with Spark SQL."""
    register_views(spark, td.lineitem_history(spark, sf_dir), td.supplier_pairs(spark, sf_dir), n=60)
    return spark.sql("SELECT * FROM v_pair_history")


QUERIES.update(
    {
        "chart_price_layer": lambda s, d: legend_rows(chart_series(_details(s, d), PRICE_FEES_LABELS), "Price"),
        "pair_row": lambda s, d: pair_row(M.summary(*_li(s, d), 60), ROW_SUPPLIER),
        "metrics_view_sql": _q_view_sql,
    }
)

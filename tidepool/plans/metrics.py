"""Trailing-window pool metrics: summary (Q2), pair detail (Q3), view (Q4),
all-timeframe summaries (Q6).

Physical shape
--------------
* The snapshot set is the top-N distinct ``created_at`` of the whole history
  (or of the loader's per-snapshot table): at most N <= 1440 rows, fetched
  once and broadcast into the fact scan.  That one join does the
  ``IN (subquery)`` restriction and tags each row with its recency, so the
  global latest snapshot (recency 1) needs no second scan; its oldest
  timestamp becomes a literal range filter that prunes the history scan.
* **Window form** (detail, view, and the exact reference semantics): one hash
  exchange + sort on ``pair_id``; both window levels share it.  A pair holds at
  most one row per snapshot (the loader keeps one entry per address and
  snapshot; ``constraint_report`` checks it), so a window partition is bounded
  by N rows.
* **Aggregate form** (summary default): at the newest rows a running window over
  the pair's series equals a plain group aggregate over the same rows, and the
  lag there is the price at the pair's previous snapshot.  So the summary is a
  partial + final hash aggregate by pair — no sort, and a hot pair is
  pre-combined map-side before the shuffle.  The pair's rows at the latest
  snapshot are read beside it and the statistics fanned back to them.
* Pairs are joined after aggregation (one row per pair instead of one per
  history row); Spark picks broadcast or shuffle from the measured size.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidepool.operators.measures import cached_columns, first_level, project, second_level
from tidepool.operators.moments import PARTIAL, band_of, by_timeframe, moment_columns, statistics
from tidepool.operators.snapshots import latest_snapshots
from tidepool.schema import PRESENCE_SHARE, TIMEFRAMES

PAIR_COLUMNS = ("name", "pair_address", "bin_step", "base_fee_percentage")


def _snapshot_set(axis: DataFrame, n: int) -> tuple[DataFrame, Column | None, Column | None]:
    """The latest ``n`` snapshots, plus range filters for the fact scan.

    The set, ``n`` rows at most, is fetched once and re-enters the plan as a small
    local relation; its oldest timestamp becomes a literal ``created_at >=`` filter
    that parquet pushes down and that prunes ``snapshot_date`` folders at planning
    time.
    """
    snaps = latest_snapshots(axis, n)
    rows = snaps.collect()
    local = axis.sparkSession.createDataFrame(rows, snaps.schema)
    if not rows:
        return local, None, None
    oldest = min(r["created_at"] for r in rows)
    lo = F.lit(oldest.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.broadcast(local), lo, F.lit(oldest.date().isoformat()).cast("date")


def _open_snapshot_set(axis: DataFrame, n: int) -> tuple[DataFrame, Column | None, Column | None]:
    """``_snapshot_set`` without its fetch: the set and its oldest timestamp are
    part of the plan, so each run of a view takes the snapshots of its time.  The
    bound is a scalar subquery, which prunes ``snapshot_date`` folders at run time."""
    snaps = latest_snapshots(axis, n)
    lo = snaps.agg(F.min("created_at")).scalar()
    return F.broadcast(snaps), lo, snaps.agg(F.min("created_at").cast("date")).scalar()


def _facts(history: DataFrame, snaps: DataFrame, lo: Column | None, lo_date: Column | None) -> DataFrame:
    """History restricted to the snapshot set, values widened to double.

    The range filter ``created_at >= oldest snapshot of the set`` goes in front
    of the join: it drops older history before any upstream work, and on a
    stored history it prunes ``snapshot_date`` partitions.
    """
    if lo is not None:
        history = history.filter(F.col("created_at") >= lo)
        if "snapshot_date" in history.columns:
            history = history.filter(F.col("snapshot_date") >= lo_date)
    return widened(history).join(snaps, "created_at")


def widened(history: DataFrame) -> DataFrame:
    """History rows with their values as doubles."""
    return history.select(
        "created_at",
        "pair_id",
        F.col("price").cast("double").alias("price"),
        F.col("liquidity").cast("double").alias("liquidity"),
        F.col("fees").cast("double").alias("fees"),
    )


def _live_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.filter(~F.col("is_blacklisted")).select(
        F.col("id").alias("pair_id"),
        "name",
        "pair_address",
        "bin_step",
        F.col("base_fee_percentage").cast("double").alias("base_fee_percentage"),
    )


def _presence(n: Column | float) -> Column:
    return F.col("num_minutes") >= n


# ---------------------------------------------------------------------------
# Window form
# ---------------------------------------------------------------------------


def _pair_window() -> Window:
    # ORDER BY without a frame = RANGE UNBOUNDED PRECEDING .. CURRENT ROW, so rows
    # with equal created_at in a pair are peers, as in the reference.
    return Window.partitionBy("pair_id").orderBy("created_at")


def running_metrics(rows: DataFrame) -> DataFrame:
    """First-level running statistics (W1-W11) and measures per row."""
    stats = rows.select("*", *cached_columns("running_stats", _running_columns))
    return first_level(stats)


def _running_columns() -> list[Column]:
    w = _pair_window()
    price, liq, fees = F.col("price"), F.col("liquidity"), F.col("fees")
    return [
        F.count(F.lit(1)).over(w).alias("num_minutes"),
        F.avg(price).over(w).alias("avg_price"),
        F.sum(fees).over(w).alias("cumulative_fees"),
        F.avg(liq).over(w).alias("avg_liquidity"),
        F.stddev_samp(liq).over(w).alias("liquidity_sd_raw"),
        F.count(F.when(fees > F.lit(0.0), F.lit(1))).over(w).alias("num_minutes_with_volume"),
        F.lag(price).over(w).alias("prev_price"),
        F.min(price).over(w).alias("min_price"),
        F.max(price).over(w).alias("max_price"),
        F.stddev_samp(price).over(w).alias("std_dev_price"),
    ]


def series_second_level(df: DataFrame) -> DataFrame:
    """W12-W14 over whatever rows ``df`` holds, then M12, M13."""
    def build() -> dict[str, Column]:
        w = _pair_window()
        return second_level(
            F.stddev_samp("pct_geek_fees_liquidity_24h").over(w),
            F.sum(F.col("tick_up").cast("int")).over(w),
            F.sum(F.col("tick_down").cast("int")).over(w),
        )

    return df.withColumns(cached_columns("second_level_series", build))


def _axis(history: DataFrame, snapshots: DataFrame | None) -> DataFrame:
    """Where the snapshot axis is read from: a per-snapshot table when the
    store keeps one, else the ``created_at`` column of the history."""
    return history if snapshots is None else snapshots


def _window_rows(history: DataFrame, pairs: DataFrame, n: int, snapshots: DataFrame | None = None, frozen: bool = True) -> DataFrame:
    snaps, lo, lo_date = (_snapshot_set if frozen else _open_snapshot_set)(_axis(history, snapshots), n)
    return _facts(history, snaps, lo, lo_date).join(_live_pairs(pairs), "pair_id")


def _window_summary(history: DataFrame, pairs: DataFrame, n: int, second: str, snapshots: DataFrame | None) -> DataFrame:
    df = running_metrics(_window_rows(history, pairs, n, snapshots))
    keep = (F.col("recency") == F.lit(1)) & _presence(n * PRESENCE_SHARE)
    if second == "latest":
        # The second-level windows sit in the same SELECT as the outer WHERE,
        # which runs first: they see only the rows that survive the filter.
        df = series_second_level(df.filter(keep))
    else:
        df = series_second_level(df).filter(keep)
    return project(df.withColumnRenamed("created_at", "dttm"))


# ---------------------------------------------------------------------------
# Aggregate form
# ---------------------------------------------------------------------------


def newest_rows(facts: DataFrame) -> DataFrame:
    """Per pair its rows at the latest snapshot, as an array in the order of their
    values: one, or peers where the history holds several."""
    row = F.struct("price", "liquidity", "fees", "created_at")
    return facts.filter(F.col("recency") == F.lit(1)).groupBy("pair_id").agg(F.array_sort(F.collect_list(row)).alias("newest"))


def _finish_aggregate(agg: DataFrame, newest: DataFrame, pairs: DataFrame, threshold: Column | float, keys: tuple[str, ...]) -> DataFrame:
    """From statistics per pair (and key) to the summary: pairs at the latest
    snapshot, one row for each of their rows there.  Such peers share all running
    statistics (the frame ends behind them); each one's lag is the peer before it."""
    kept = agg.filter(_presence(threshold)).join(newest, "pair_id").join(_live_pairs(pairs), "pair_id")
    at = F.col("newest")
    before = F.transform(at, lambda x, i: F.when(i == 0, F.col("prev_price")).otherwise(F.get(at, i - 1)["price"]))
    kept = kept.withColumn("before", before)
    kept = kept.withColumn("moves", F.zip_with("before", at, lambda b, x: F.when(b < x["price"], F.lit(1)).when(b > x["price"], F.lit(-1)).otherwise(F.lit(0))))
    rows = kept.select("*", F.posexplode(at).alias("peer", "row"))
    rows = rows.select(
        *keys,
        "pair_id",
        F.col("row.created_at").alias("dttm"),
        *PAIR_COLUMNS,
        F.col("row.price").alias("price"),
        F.col("row.liquidity").alias("liquidity"),
        F.col("row.fees").alias("fees"),
        "num_minutes",
        "avg_price",
        "cumulative_fees",
        "avg_liquidity",
        "liquidity_sd_raw",
        "num_minutes_with_volume",
        F.get("before", F.col("peer")).alias("prev_price"),
        "min_price",
        "max_price",
        "std_dev_price",
        F.size("newest").alias("peers"),
        F.size(F.filter("moves", lambda m: m > 0)).alias("ups"),
        F.size(F.filter("moves", lambda m: m < 0)).alias("downs"),
    )
    df = first_level(rows)
    # The outer windows see a pair's peers only: the sample stddev of one value is
    # NULL and that of equal ones 0; the running tick sums are over the peers.
    second = cached_columns(
        "second_level_latest",
        lambda: second_level(
            F.when((F.col("peers") > 1) & F.col("pct_geek_fees_liquidity_24h").isNotNull(), F.lit(0.0)), F.col("ups"), F.col("downs")
        ),
    )
    return project(df, keys, second)


def _aggregate_summary(history: DataFrame, pairs: DataFrame, n: int, snapshots: DataFrame | None) -> DataFrame:
    snaps, lo, lo_date = _snapshot_set(_axis(history, snapshots), n)
    facts = _facts(history, snaps, lo, lo_date)
    parts = cached_columns("summary_moments", lambda: moment_columns(F.col("recency") == F.lit(1)))
    agg = facts.groupBy("pair_id").agg(*parts)
    agg = agg.select("pair_id", F.struct(*PARTIAL).alias("stats")).select("pair_id", *statistics("stats"))
    return _finish_aggregate(agg, newest_rows(facts), pairs, n * PRESENCE_SHARE, ())


# ---------------------------------------------------------------------------
# Public plans
# ---------------------------------------------------------------------------


def summary(
    history: DataFrame,
    pairs: DataFrame,
    n: int,
    second_level: str = "latest",
    method: str = "aggregate",
    snapshots: DataFrame | None = None,
) -> DataFrame:
    """Opportunity summary for a timeframe of ``n`` snapshots (Q2).

    One row per non-blacklisted pair that has a row at the global newest
    snapshot and is present in at least 90% of the timeframe's snapshots.

    ``second_level='latest'`` (reference behaviour) evaluates the
    std-dev-of-24h-ratio and tick counts over the surviving row only;
    ``'series'`` evaluates them over the pair's whole series in the timeframe.
    ``method='aggregate'`` (default) is the group-aggregate plan; ``'window'`` is
    the literal running-window plan.  A pair with several rows at the latest
    snapshot has a row for each; in which order they follow one another for the lag
    is open in the window plan, by price, liquidity and fees in the other.
    ``'series'`` always uses the window plan.
    ``snapshots`` (optional) is a table with one row per loaded snapshot
    (``Tables.snapshots``); it spares the scan of the history's time column.
    """
    if second_level not in ("latest", "series"):
        raise ValueError("second_level must be 'latest' or 'series'")
    if method not in ("aggregate", "window"):
        raise ValueError("method must be 'aggregate' or 'window'")
    if second_level == "series" or method == "window":
        return _window_summary(history, pairs, n, second_level, snapshots)
    return _aggregate_summary(history, pairs, n, snapshots)


def pair_details(
    history: DataFrame, pairs: DataFrame, pair_address: str, n: int, snapshots: DataFrame | None = None
) -> DataFrame:
    """Full running series of one pair over the timeframe, oldest first (Q3).

    The pair filter is applied to ``pairs`` *before* the windows: the window
    partition key and ``pair_address`` are one-to-one, so filtering first gives
    the same rows while computing windows for a single pair.
    """
    one = pairs.filter(F.col("pair_address") == F.lit(pair_address))
    # The address is unique, so the lookup returns one id (a table that breaks
    # the rule: all of them); as a literal, the id filter reaches the parquet reader and skips row
    # groups of other pairs (the loader sorts files by pair_id).
    # The time axis still comes from the whole history.
    ids = [r["id"] for r in one.select("id").distinct().collect()]
    own = history.filter(F.col("pair_id").isin(ids) if ids else F.lit(False))
    rows = _window_rows(own, one, n, _axis(history, snapshots))
    df = series_second_level(running_metrics(rows)).withColumnRenamed("created_at", "dttm")
    return project(df).orderBy("dttm")


def metrics_view(history: DataFrame, pairs: DataFrame, n: int = 60, snapshots: DataFrame | None = None, frozen: bool = True) -> DataFrame:
    """All rows of all pairs with running metrics over ``n`` snapshots (Q4).
    ``frozen`` fetches the snapshot set now; a named view leaves it to each run."""
    df = series_second_level(running_metrics(_window_rows(history, pairs, n, snapshots, frozen)))
    return project(df.withColumnRenamed("created_at", "dttm"))


def summaries(
    history: DataFrame,
    pairs: DataFrame,
    timeframes: Iterable[int] = TIMEFRAMES,
    snapshots: DataFrame | None = None,
) -> DataFrame:
    """Summaries for every eligible timeframe in one pass (Q6).

    A row is aggregated once, into its pair's moments of the band of recency that
    its snapshot is in (as many bands as timeframes); a timeframe merges the bands
    it covers, 8 partials a pair at most.  A timeframe is eligible when the history
    has at least that many snapshots.  Output: ``timeframe`` + the summary columns.
    """
    tfs = sorted(set(int(t) for t in timeframes))
    snaps, lo, lo_date = _snapshot_set(_axis(history, snapshots), max(tfs))
    facts = _facts(history, snaps, lo, lo_date)
    parts = cached_columns("summary_moments", lambda: moment_columns(F.col("recency") == F.lit(1)))
    partials = facts.groupBy("pair_id", band_of(F.col("recency"), tfs).alias("band"), "snapshots_kept").agg(*parts)
    return merged_summaries(partials, newest_rows(facts), pairs, tfs)


def merged_summaries(partials: DataFrame, newest: DataFrame, pairs: DataFrame, timeframes: list[int]) -> DataFrame:
    """Summaries of all eligible timeframes from partials by ``(pair_id, band)``;
    ``newest`` holds each pair's rows at the latest snapshot."""
    agg = by_timeframe(partials, timeframes).select("pair_id", "timeframe", *statistics("stats"))
    return _finish_aggregate(agg, newest, pairs, F.col("timeframe") * F.lit(PRESENCE_SHARE), ("timeframe",))

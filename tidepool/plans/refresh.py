"""Summaries kept current (T4): sealed moments of closed blocks of time.

The time axis is cut into blocks of ``block_seconds``.  Once a newer block has begun,
a block is sealed: one row of moments a pair (``operators.moments``), stored under the
batch that sealed it.  A refresh of all timeframes then reads the sealed rows of the
blocks that lie whole in one band of recency, and history rows only of the others: the
open block and at most one block for each timeframe's start.  So with hourly blocks
and a snapshot a minute it merges some 24 rows a pair and reads at most nine hours of
history instead of a day's.

A block whose rows change afterwards (late rows) is sealed again by that batch; the
newest seal of a block counts.  What is handled on the driver are snapshots and blocks
of the largest timeframe, 1440 at most.
"""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.moments import band_of, moment_columns
from tidepool.operators.snapshots import latest_snapshots
from tidepool.plans.metrics import merged_summaries, newest_rows, widened
from tidepool.schema import HISTORY, SUMMARIES, TIMEFRAMES
from tidepool.sources.tables import Tables

#: Length of a block: an hour of minute snapshots.
BLOCK_SECONDS = 3600

_EPOCH = dt.datetime(1970, 1, 1)


def _at(t: dt.datetime) -> Column:
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def _block(t: dt.datetime, seconds: int) -> int:
    return int((t - _EPOCH).total_seconds() // seconds)


def _begin(block: int, seconds: int) -> dt.datetime:
    return _EPOCH + dt.timedelta(seconds=block * seconds)


def block_of(at: Column, seconds: int) -> Column:
    """The block of a snapshot: whole blocks since 1970."""
    return F.floor(F.unix_timestamp(at.cast("timestamp")) / F.lit(seconds)).cast("long")


def _within(history: DataFrame, blocks: Iterable[int], seconds: int) -> DataFrame:
    """History rows of some blocks; the bounds reach the parquet reader and prune
    ``snapshot_date`` folders."""
    runs: list[list[int]] = []
    for b in sorted(set(blocks)):
        if runs and b == runs[-1][1] + 1:
            runs[-1][1] = b
        else:
            runs.append([b, b])
    if not runs:
        return history.filter(F.lit(False))
    inside = F.lit(False)
    for lo, hi in runs:
        first, end = _begin(lo, seconds), _begin(hi + 1, seconds)
        part = (F.col("created_at") >= _at(first)) & (F.col("created_at") < _at(end))
        if "snapshot_date" in history.columns:
            last = (end - dt.timedelta(microseconds=1)).date()
            part = part & F.col("snapshot_date").between(F.lit(first.date()), F.lit(last))
        inside = inside | part
    return history.filter(inside)


def _axis(spark: SparkSession, tables: Tables, before: int, timeframes: Iterable[int]) -> list[dt.datetime]:
    """The snapshots of the largest timeframe, newest first."""
    rows = latest_snapshots(tables.snapshots(spark, before=before), max(timeframes)).collect()
    return [r["created_at"] for r in sorted(rows, key=lambda r: r["recency"])]


def seal_blocks(
    spark: SparkSession, tables: Tables, batch_id: int, block_seconds: int = BLOCK_SECONDS, timeframes: Iterable[int] = TIMEFRAMES
) -> list[int]:
    """Seal the closed blocks of the largest timeframe that are not sealed yet, and
    those sealed ones that batch ``batch_id`` has added rows to.  Returns them."""
    axis = _axis(spark, tables, batch_id + 1, timeframes)
    if not axis:
        return []
    open_block = _block(axis[0], block_seconds)
    closed = {_block(t, block_seconds) for t in axis} - {open_block}
    done = tables.sealed(spark, before=batch_id)
    sealed = set() if done is None else {r["block"] for r in done.filter(F.col("block") >= min(closed, default=open_block)).select("block").distinct().collect()}
    touched = {_block(r["created_at"], block_seconds) for r in tables.batch(spark, "snapshots", "created_at timestamp_ntz, rows long", batch_id).filter(F.col("created_at") >= _at(_begin(min(closed, default=open_block), block_seconds))).select("created_at").distinct().collect()}
    touched |= {_block(t, block_seconds) for t in tables.repaired(spark, batch_id)}
    todo = sorted(closed - sealed | closed & touched)
    if todo:
        rows = widened(_within(tables.history(spark, before=batch_id + 1), todo, block_seconds))
        parts = rows.groupBy("pair_id", block_of(F.col("created_at"), block_seconds).alias("block")).agg(*moment_columns())
        tables.write(parts, "moments", batch_id)
    blocks = spark.range(0, 1, 1, 1).select(F.explode(F.array(*[F.lit(b) for b in todo]).cast("array<long>")).alias("block"))
    if todo:
        tables.write(blocks, "sealed", batch_id)
    else:
        tables.clear(blocks, "sealed", batch_id)
    return todo


def current_summaries(
    spark: SparkSession, tables: Tables, before: int, block_seconds: int = BLOCK_SECONDS, timeframes: Iterable[int] = TIMEFRAMES
) -> DataFrame:
    """``summaries`` over the tables as of the batches below ``before``, from sealed
    moments where blocks allow it."""
    tfs = sorted(set(int(t) for t in timeframes))
    axis = _axis(spark, tables, before, tfs)
    if not axis:
        return spark.createDataFrame([], SUMMARIES)
    history = tables.history(spark, before=before)
    bands = defaultdict(set)
    for recency, t in enumerate(axis, 1):
        bands[_block(t, block_seconds)].add(next(k for k, n in enumerate(tfs) if recency <= n))
    sealed = tables.sealed(spark, before=before)
    lowest = min(bands)
    known = {} if sealed is None else {r["block"]: r["by"] for r in sealed.filter(F.col("block") >= lowest).groupBy("block").agg(F.max("batch_id").alias("by")).collect()}
    # The oldest block may begin before the largest timeframe does; the newest
    # snapshot is set apart in its partial.
    whole = {b: by for b, by in known.items() if b in bands and len(bands[b]) == 1 and b not in (lowest, max(bands))}
    rest = _within(history, set(bands) - set(whole), block_seconds)
    kept = F.lit(len(axis))
    snaps = spark.createDataFrame([(t, k) for k, t in enumerate(axis, 1)], "created_at timestamp_ntz, recency int")
    facts = widened(rest).join(F.broadcast(snaps), "created_at")
    parts = facts.groupBy("pair_id", band_of(F.col("recency"), tfs).alias("band")).agg(*moment_columns(F.col("recency") == F.lit(1)))
    if whole:
        # Blocks of the largest timeframe: at most as many as it has snapshots.
        use = spark.createDataFrame([(b, by, next(iter(bands[b]))) for b, by in whole.items()], "block long, batch_id long, band int")
        held = tables.moments(spark, before=before, batches=sorted(set(whole.values()))).join(F.broadcast(use), ["block", "batch_id"])
        parts = parts.unionByName(held.select(*parts.columns))
    return merged_summaries(parts.withColumn("snapshots_kept", kept), newest_rows(facts), pairs=tables.pairs(spark, before=before), timeframes=tfs)


def append_history(spark: SparkSession, rows: DataFrame, tables: Tables, batch_id: int) -> None:
    """Store rows that carry their fees already (``HISTORY``) as a batch: for feeds
    whose counters were differenced upstream."""
    facts = rows.select(*HISTORY.fieldNames(), F.lit(None).cast("float").alias("counter"), F.to_date("created_at").alias("snapshot_date"))
    tables.write(facts.sortWithinPartitions("snapshot_date", "pair_id"), "history", batch_id, partition_by=("snapshot_date",))
    added = tables.batch(spark, "history", facts.schema, batch_id).groupBy("created_at").agg(F.count(F.lit(1)).alias("rows"))
    tables.write(added, "snapshots", batch_id)

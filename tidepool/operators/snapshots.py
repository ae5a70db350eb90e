"""Snapshot-axis operators.

The time axis is counted in *distinct snapshots*, not clock minutes: a
timeframe of N is the latest N distinct ``created_at`` values of the whole
history (before any blacklist filter or join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidepool.schema import MIN_SNAPSHOTS, TIMEFRAME_LABELS, TIMEFRAMES


def update_count(history: DataFrame) -> DataFrame:
    """One row: number of distinct snapshots in the history (exact)."""
    return history.agg(F.countDistinct("created_at").alias("update_count"))


def latest_snapshots(history: DataFrame, n: int) -> DataFrame:
    """The latest ``n`` distinct snapshots with their recency (1 = newest).

    ``distinct`` is a partial aggregation on ``created_at`` and the ``limit`` runs
    as a top-k per partition, so at most ``n`` rows ever leave the executors.
    The ranking window below has no partition key on purpose: it sees at most
    ``n`` rows (``n`` is a timeframe, at most 1440), and it also carries how
    many snapshots were kept, which decides which timeframes are eligible.
    """
    snaps = history.select("created_at").distinct().orderBy(F.col("created_at").desc()).limit(n)
    w = Window.orderBy(F.col("created_at").desc())
    return snaps.select(
        "created_at",
        F.row_number().over(w).alias("recency"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("snapshots_kept"),
    )


def readiness(history: DataFrame) -> DataFrame:
    """One row, whatever the history holds: its number of snapshots and whether they
    are enough to show a summary (P14: at least five)."""
    return update_count(history).select("update_count", (F.col("update_count") >= F.lit(MIN_SNAPSHOTS)).alias("ready"))


def eligible_timeframes(history: DataFrame, timeframes=TIMEFRAMES) -> DataFrame:
    """Timeframes that have enough snapshots (P12) plus the readiness gate.

    One row per eligible timeframe: ``timeframe``, ``label``, ``update_count``,
    ``ready`` (at least five snapshots) and ``is_default`` (the preselected
    choice: the last option when fewer than four, else the third).
    """
    tfs = F.array(*[F.lit(t) for t in timeframes])
    labels = F.create_map(*[x for t in timeframes for x in (F.lit(t), F.lit(TIMEFRAME_LABELS.get(t, str(t))))])
    counted = update_count(history)
    options = F.filter(tfs, lambda t: t <= F.col("update_count"))
    n_opts = F.size(options)
    default = F.when(n_opts < 4, n_opts).otherwise(F.lit(3))
    exploded = counted.select(
        "update_count",
        F.posexplode(options).alias("pos", "timeframe"),
        default.alias("default_pos"),
    )
    return exploded.select(
        "timeframe",
        F.element_at(labels, F.col("timeframe")).alias("label"),
        "update_count",
        (F.col("update_count") >= F.lit(MIN_SNAPSHOTS)).alias("ready"),
        (F.col("pos") + 1 == F.col("default_pos")).alias("is_default"),
    )

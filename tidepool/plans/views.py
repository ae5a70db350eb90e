"""Named views (S12) and single-row lookups.

``register_views`` publishes the stored tables and the metrics view under the
reference's names, so SQL users can query them with ``spark.sql``.  The snapshot
set of ``v_pair_history`` is part of its plan, so it moves with the history.  A
table read by path lists its files once; ``refresh_views``, which the loader calls
after each load, lists them anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.plans.metrics import metrics_view

VIEWS = ("pair_history", "pairs", "tokens", "v_pair_history")


def register_views(
    spark: SparkSession, history: DataFrame, pairs: DataFrame, tokens: DataFrame | None = None, n: int = 60, snapshots: DataFrame | None = None
) -> None:
    """``snapshots`` (``Tables.snapshots``) spares the view its scans of the history for
    the time axis."""
    history.createOrReplaceTempView("pair_history")
    pairs.createOrReplaceTempView("pairs")
    if tokens is not None:
        tokens.createOrReplaceTempView("tokens")
    metrics_view(history, pairs, n, snapshots, frozen=False).createOrReplaceTempView("v_pair_history")


def refresh_views(spark: SparkSession) -> None:
    """Let the registered views see files written since they were registered."""
    for name in VIEWS:
        if spark.catalog.tableExists(name):
            spark.catalog.refreshTable(name)


def pair_row(summary: DataFrame, pair_address: str) -> DataFrame:
    """The summary row of one pair (at most one row)."""
    return summary.filter(F.col("pair_address") == F.lit(pair_address)).limit(1)

"""Dashboard data (Q7-Q10): opportunity table, pair header facts, chart
series and the freshness line, all as DataFrames over the summary."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.text import minutes_since
from tidepool.operators.filters import opportunities
from tidepool.operators.reshape import chart_series, price_axis
from tidepool.operators.snapshots import update_count
from tidepool.schema import MIN_SNAPSHOTS

__all__ = ["chart_series", "freshness", "opportunities", "pair_header", "price_axis"]

# Data older than this many minutes offers a refresh.
STALE_MINUTES = 5


def pair_header(summary: DataFrame, base: DataFrame, scores: DataFrame) -> DataFrame:
    """Header facts per summary row (Q9): rounded pool facts, base token and
    its score.  ``base`` is ``base_tokens(...)``; ``scores`` is
    ``token_scores(...)``.  Rounding is half to even, like the display."""
    s = summary.select(
        "pair_address",
        "name",
        "bin_step",
        F.bround(F.col("base_fee_percentage"), 2).alias("base_fee_percentage"),
        F.bround(F.col("pct_below_max"), 0).cast("bigint").alias("pct_below_max"),
        "bins_below_max",
        "bins_range",
    )
    s = s.join(base, "pair_address", "left").join(scores, "mint", "left")
    shown = F.when(F.col("pct_below_max") > 0, -F.col("pct_below_max")).otherwise(F.lit(0)).cast("bigint")
    return s.select(
        "pair_address",
        "name",
        "bin_step",
        "base_fee_percentage",
        "pct_below_max",
        "bins_below_max",
        "bins_range",
        F.col("symbol").alias("base_symbol"),
        F.col("mint").alias("base_mint"),
        "organic_score",
        shown.alias("below_max_shown"),
    )


def freshness(history: DataFrame, summary: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """One row: snapshot count, newest summary time, minutes since it (-1 when
    the summary is empty), and whether the line shows and offers a refresh."""
    # A wall-clock literal: text cast to TIMESTAMP_NTZ, independent of time zones.
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz") if as_of is not None else F.localtimestamp()
    count = update_count(history).scalar()
    row = summary.agg(F.max("dttm").alias("last_update")).select(
        count.alias("update_count"), "last_update", minutes_since(F.col("last_update"), now).alias("minutes_ago")
    )
    shown = (F.col("update_count") >= F.lit(MIN_SNAPSHOTS)) & (F.col("minutes_ago") >= F.lit(0))
    return row.select(
        "update_count",
        "last_update",
        "minutes_ago",
        shown.alias("shown"),
        (shown & (F.col("minutes_ago") >= F.lit(STALE_MINUTES))).alias("offer_refresh"),
    )

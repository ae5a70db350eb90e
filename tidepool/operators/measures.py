"""Derived measures M1-M13 over running (or grouped) statistics.

Inputs are the statistic columns named below; every formula is NULL-safe (an
undefined ratio is NULL) and rounding is half away from zero.  The same
function serves the window form (one value per row) and the aggregate form
(one value per pair), so the formulas exist once.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.numeric import bins_between, ceil_long, nz, round_half_away, safe_div
from tidepool.schema import BINS_PER_POSITION, METRIC_COLUMNS, NEAR_MAX_BINS

# Statistic columns the first level needs.
STAT_COLUMNS = (
    "num_minutes",
    "avg_price",
    "cumulative_fees",
    "avg_liquidity",
    "liquidity_sd_raw",
    "num_minutes_with_volume",
    "prev_price",
    "min_price",
    "max_price",
    "std_dev_price",
)

# Output columns of every metrics frame, in the reference's order.
OUTPUT_COLUMNS = METRIC_COLUMNS


_EXPRESSIONS: dict[str, tuple[Any, Any]] = {}


def cached_columns(name: str, build: Callable[[], Any]) -> Any:
    """Build a set of unresolved ``Column`` expressions once per SparkContext.

    The formulas do not depend on any DataFrame, so every query reuses the same
    expression objects instead of rebuilding them call by call on the driver.
    A new SparkContext (after a stop) rebuilds them.
    """
    sc = SparkContext._active_spark_context
    hit = _EXPRESSIONS.get(name)
    if hit is None or hit[0] is not sc:
        hit = (sc, build())
        _EXPRESSIONS[name] = hit
    return hit[1]


def first_level(df: DataFrame) -> DataFrame:
    """Add M1-M11 and the tick flags from the statistic columns.

    ``liquidity_std_dev`` is rounded to cents first and the rounded value feeds
    both ratios that use it; the 24h ratio is rounded and later measured again.
    """
    layers = cached_columns("first_level", _first_level_layers)
    for layer in layers:
        df = df.withColumns(layer)
    return df


def _first_level_layers() -> list[dict[str, Column]]:
    c = F.col
    one = (
        {
            "liquidity_std_dev": round_half_away(c("liquidity_sd_raw"), 2),
            "tick_up": F.coalesce(c("prev_price") < c("price"), F.lit(False)),
            "tick_down": F.coalesce(c("prev_price") > c("price"), F.lit(False)),
            "pct_minutes_with_volume": round_half_away(
                safe_div(F.lit(100.0) * c("num_minutes_with_volume"), c("num_minutes")), 0
            ),
            "pct_price_range": round_half_away(
                safe_div(F.lit(100.0) * (c("max_price") - c("min_price")), c("min_price")), 2
            ),
            "bins_range": bins_between(safe_div(c("max_price"), c("min_price")), c("bin_step")),
            "pct_below_max": safe_div(F.lit(100.0) * (c("max_price") - c("price")), c("max_price")),
            "price_volatility_ratio": safe_div(c("std_dev_price"), c("avg_price")),
        }
    )
    two = (
        {
            "liquidity_volatility_ratio": round_half_away(
                safe_div(c("liquidity_std_dev"), c("avg_liquidity")), 2
            ),
            "pct_geek_fees_liquidity": F.when(c("avg_liquidity") == F.lit(0.0), F.lit(0.0)).otherwise(
                safe_div(F.lit(100.0) * c("cumulative_fees"), c("avg_liquidity") + c("liquidity_std_dev"))
            ),
            "num_positions_range": ceil_long(c("bins_range") / F.lit(float(BINS_PER_POSITION))),
            "bins_below_max": bins_between(F.lit(1.0) + c("pct_below_max") / F.lit(100.0), c("bin_step")),
        }
    )
    three = (
        {
            "pct_geek_fees_liquidity_24h": round_half_away(
                safe_div(F.lit(1440.0) * c("pct_geek_fees_liquidity"), c("num_minutes")), 2
            ),
            "near_max": c("bins_below_max") <= F.lit(NEAR_MAX_BINS),
        }
    )
    return [one, two, three]


def second_level(sd_24h: Column, num_tick_up: Column, num_tick_down: Column) -> dict[str, Column]:
    """M12, M13 and the three second-level statistics as named columns."""
    up = num_tick_up.cast("bigint")
    down = num_tick_down.cast("bigint")
    return {
        "std_dev_pct_geek_fees_liquidity_24h": sd_24h.cast("double"),
        "pct_geek_fees_liquidity_24h_volatility_ratio": sd_24h.cast("double")
        / nz(F.col("pct_geek_fees_liquidity_24h")),
        "num_tick_up": up,
        "num_tick_down": down,
        "pct_tick_up": round_half_away(safe_div(F.lit(100.0) * up, up + down), 0),
    }


def project(df: DataFrame, extra: tuple[str, ...] = (), computed: dict[str, Column] | None = None) -> DataFrame:
    """Final projection: the 33 output columns (plus ``extra`` keys first);
    ``computed`` supplies columns defined in this same projection."""
    computed = computed or {}
    return df.select(*extra, *[computed[c].alias(c) if c in computed else F.col(c) for c in OUTPUT_COLUMNS])

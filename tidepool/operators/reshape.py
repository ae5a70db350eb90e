"""Chart-ready long form of a pair's detail series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.text import clock_label

# Legend labels of the two detail charts.
FEE_LIQUIDITY_LABELS = {"pct_geek_fees_liquidity_24h": "Avg Geek 24h Fee / TVL", "liquidity": "Liquidity"}
PRICE_FEES_LABELS = {"price": "Price", "fees": "Fees"}
# The price axis starts this far below the lowest price.
PRICE_AXIS_LOW = 0.95


def chart_series(details: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Unpivot ``labels``' columns to ``dttm, Legend, Value, Time``."""
    cols = list(labels)
    long = details.select("dttm", *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        "dttm", cols, "metric", "Value"
    )
    legend = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), F.lit(v))])
    return long.select(
        "dttm",
        F.element_at(legend, F.col("metric")).alias("Legend"),
        "Value",
        clock_label(F.col("dttm")).alias("Time"),
    )


def legend_rows(series: DataFrame, legend: str) -> DataFrame:
    """Rows of one legend entry (one chart layer)."""
    return series.filter(F.col("Legend") == F.lit(legend))


def price_axis(details: DataFrame) -> DataFrame:
    """Price axis domain: ``[0.95 * min(price), max(price)]`` (one row)."""
    return details.agg(
        (F.min("price") * F.lit(PRICE_AXIS_LOW)).alias("axis_min"), F.max("price").alias("axis_max")
    )

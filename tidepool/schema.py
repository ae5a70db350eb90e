"""Schemas of the raw snapshot feed and of the stored tables.

Stored tables follow the reference data model: a ``tokens`` and a ``pairs``
dimension (natural keys ``mint`` and ``pair_address``, frozen at first sight),
an append-only ``pair_history`` fact, and the last cumulative fee counter per
pair (kept apart from ``pairs`` so the dimension stays append-only).
"""

from __future__ import annotations

from pyspark.sql import types as T

# One record of a snapshot page, as delivered under the ``pairs`` key.
RAW_ENTRY = T.StructType(
    [
        T.StructField("address", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("mint_x", T.StringType()),
        T.StructField("mint_y", T.StringType()),
        T.StructField("bin_step", T.IntegerType()),
        T.StructField("base_fee_percentage", T.StringType()),
        T.StructField("hide", T.BooleanType()),
        T.StructField("is_blacklisted", T.BooleanType()),
        T.StructField("cumulative_fee_volume", T.StringType()),
        T.StructField("current_price", T.DoubleType()),
        T.StructField("liquidity", T.DoubleType()),
        T.StructField("fees", T.StructType([T.StructField("min_30", T.DoubleType())])),
    ]
)

# A page file: ``{"page": n, "created_at": ts, "pairs": [entry, ...]}``.
RAW_PAGE = T.StructType(
    [
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("page", T.IntegerType()),
        T.StructField("pairs", T.ArrayType(RAW_ENTRY)),
    ]
)

# A page as the feed delivers it; ``file_path`` where many page files are kept in one.
PAYLOAD = T.StructType([T.StructField("file_path", T.StringType()), T.StructField("pairs", T.ArrayType(RAW_ENTRY))])

# Flattened entry with its snapshot time and page number.
RAW_SNAPSHOT = T.StructType(
    [T.StructField("created_at", T.TimestampNTZType()), T.StructField("page", T.IntegerType())]
    + list(RAW_ENTRY.fields)
)

#: Where the JSON readers put the text of a record that does not parse; only
#: JSON reads ask for it.
CORRUPT = T.StructField("_corrupt_record", T.StringType())


def read_schema(schema: T.StructType, fmt: str) -> T.StructType:
    """The schema to read ``schema`` with from files of format ``fmt``."""
    return T.StructType([*schema.fields, CORRUPT]) if fmt == "json" else schema


TOKENS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("mint", T.StringType(), False),
        T.StructField("symbol", T.StringType()),
    ]
)

PAIRS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("pair_address", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("mint_x_id", T.LongType(), False),
        T.StructField("mint_y_id", T.LongType(), False),
        T.StructField("bin_step", T.IntegerType(), False),
        T.StructField("base_fee_percentage", T.FloatType(), False),
        T.StructField("hide", T.BooleanType(), False),
        T.StructField("is_blacklisted", T.BooleanType(), False),
    ]
)

# Last cumulative fee counter seen per pair (FLOAT, like the reference
# column) and the snapshot it came from.
COUNTERS = T.StructType(
    [
        T.StructField("pair_id", T.LongType(), False),
        T.StructField("cumulative_fee_volume", T.FloatType(), False),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

HISTORY = T.StructType(
    [
        T.StructField("created_at", T.TimestampNTZType(), False),
        T.StructField("pair_id", T.LongType(), False),
        T.StructField("price", T.FloatType(), False),
        T.StructField("liquidity", T.FloatType(), False),
        T.StructField("fees", T.FloatType()),
    ]
)

# The fact as stored: with the counter each fee was taken from (NULL in rows stored
# before it was kept), so that a late neighbour can be differenced against it.
STORED_HISTORY = T.StructType([*HISTORY.fields, T.StructField("counter", T.FloatType()), T.StructField("snapshot_date", T.DateType())])

# Moments of a pair's rows in a block of time (``operators.moments``).
MOMENTS = T.StructType(
    [
        T.StructField("pair_id", T.LongType()),
        T.StructField("block", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("n_price", T.LongType()),
        T.StructField("sum_price", T.DoubleType()),
        T.StructField("m2_price", T.DoubleType()),
        T.StructField("n_liquidity", T.LongType()),
        T.StructField("sum_liquidity", T.DoubleType()),
        T.StructField("m2_liquidity", T.DoubleType()),
        T.StructField("sum_fees", T.DoubleType()),
        T.StructField("n_volume", T.LongType()),
        T.StructField("min_price", T.DoubleType()),
        T.StructField("max_price", T.DoubleType()),
        T.StructField("last_at", T.TimestampNTZType()),
        T.StructField("last_price", T.DoubleType()),
    ]
)

SNAPSHOTS = T.StructType([T.StructField("created_at", T.TimestampNTZType()), T.StructField("rows", T.LongType())])


def _metric_type(name: str) -> T.DataType:
    if name == "dttm":
        return T.TimestampNTZType()
    if name in ("name", "pair_address"):
        return T.StringType()
    if name == "bin_step":
        return T.IntegerType()
    if name == "near_max":
        return T.BooleanType()
    if name.startswith("num_") or name in ("bins_range", "bins_below_max"):
        return T.LongType()
    return T.DoubleType()


# The output of the metrics plans (summary, detail, view), 33 columns.
METRIC_COLUMNS = (
    "dttm", "name", "pair_address", "bin_step", "base_fee_percentage", "price", "liquidity", "fees",
    "num_minutes", "avg_price", "cumulative_fees", "avg_liquidity", "liquidity_std_dev",
    "liquidity_volatility_ratio", "pct_geek_fees_liquidity", "pct_geek_fees_liquidity_24h",
    "std_dev_pct_geek_fees_liquidity_24h", "pct_geek_fees_liquidity_24h_volatility_ratio",
    "num_minutes_with_volume", "pct_minutes_with_volume", "num_tick_up", "num_tick_down", "pct_tick_up",
    "min_price", "max_price", "pct_price_range", "bins_range", "num_positions_range", "pct_below_max",
    "bins_below_max", "near_max", "std_dev_price", "price_volatility_ratio",
)
METRICS = T.StructType([T.StructField(c, _metric_type(c)) for c in METRIC_COLUMNS])
SUMMARIES = T.StructType([T.StructField("timeframe", T.IntegerType())] + list(METRICS.fields))

# Token score payload (one search result list per mint).
SCORES = T.StructType(
    [
        T.StructField("mint", T.StringType()),
        T.StructField(
            "payload",
            T.StructType(
                [
                    T.StructField(
                        "tokens",
                        T.ArrayType(T.StructType([T.StructField("organicScore", T.DoubleType())])),
                    )
                ]
            ),
        ),
    ]
)

# Analysis windows in snapshots, and their labels.
TIMEFRAMES = (5, 15, 30, 60, 120, 360, 720, 1440)
TIMEFRAME_LABELS = {
    5: "5 minutes",
    15: "15 minutes",
    30: "30 minutes",
    60: "1 hour",
    120: "2 hours",
    360: "6 hours",
    720: "12 hours",
    1440: "24 hours",
}

# A timeframe needs this many snapshots before the summary shows.
MIN_SNAPSHOTS = 5
# A pair must be present in this share of the timeframe's snapshots.
PRESENCE_SHARE = 0.9
# Bins one position can cover, and "near max" bin distance.
BINS_PER_POSITION = 69
NEAR_MAX_BINS = 7

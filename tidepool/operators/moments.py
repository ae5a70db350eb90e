"""Mergeable moments of a pair's rows (A5, Q6, T4).

A partial holds, for some of a pair's rows, what the summary's statistics can be
merged from: counts, sums, sums of squared deviations, extremes, and the newest row
that is not at the latest snapshot.  Variances are merged by the pairwise update
(Chan et al.): the deviations of two partials and that of their means.  Partials may
cover a band of recency or a block of time; a timeframe is a fold over a few of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.schema import MOMENTS

PARTIAL = tuple(f.name for f in MOMENTS.fields if f.name not in ("pair_id", "block"))
STATE = "struct<" + ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in MOMENTS.fields if f.name in PARTIAL) + ">"


def moment_columns(newest: Column | None = None) -> list[Column]:
    """Aggregates of a partial.  Rows where ``newest`` holds do not count as the
    last one: a lag at the latest snapshot looks behind it.  All buffers have a fixed
    width, so the aggregate is a hash aggregate."""
    price, liquidity, fees, at = F.col("price"), F.col("liquidity"), F.col("fees"), F.col("created_at")
    behind = at if newest is None else F.when(~newest, at)

    def deviations(x: Column) -> Column:
        return F.var_pop(x) * F.count(x)

    return [
        F.count(F.lit(1)).alias("n"),
        F.count(price).alias("n_price"),
        F.sum(price).alias("sum_price"),
        deviations(price).alias("m2_price"),
        F.count(liquidity).alias("n_liquidity"),
        F.sum(liquidity).alias("sum_liquidity"),
        deviations(liquidity).alias("m2_liquidity"),
        F.sum(fees).alias("sum_fees"),
        F.count(F.when(fees > F.lit(0.0), F.lit(1))).alias("n_volume"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.max(behind).alias("last_at"),
        F.max_by(price, behind).alias("last_price"),
    ]


def _plus(a: Column, b: Column) -> Column:
    return F.coalesce(a + b, a, b)


def _deviations(x: Column, y: Column, value: str) -> Column:
    n, m, s, t = x[f"n_{value}"], y[f"n_{value}"], x[f"sum_{value}"], y[f"sum_{value}"]
    apart = t / m - s / n
    return F.when(n == 0, y[f"m2_{value}"]).when(m == 0, x[f"m2_{value}"]).otherwise(x[f"m2_{value}"] + y[f"m2_{value}"] + apart * apart * n * m / (n + m))


def merged(x: Column, y: Column) -> Column:
    """The partial of the rows of two."""
    later = x["last_at"].isNull() | (y["last_at"] > x["last_at"])
    parts = {
        **{c: x[c] + y[c] for c in ("n", "n_price", "n_liquidity", "n_volume")},
        **{c: _plus(x[c], y[c]) for c in ("sum_price", "sum_liquidity", "sum_fees")},
        "m2_price": _deviations(x, y, "price"),
        "m2_liquidity": _deviations(x, y, "liquidity"),
        "min_price": F.least(x["min_price"], y["min_price"]),
        "max_price": F.greatest(x["max_price"], y["max_price"]),
        "last_at": F.greatest(x["last_at"], y["last_at"]),
        "last_price": F.when(later, y["last_price"]).otherwise(x["last_price"]),
    }
    return F.struct(*[parts[c].alias(c) for c in PARTIAL])


def folded(parts: Column) -> Column:
    """The partial of all rows of an array of partials (at least one)."""
    rest = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.aggregate(rest, F.get(parts, F.lit(0)).cast(STATE), lambda x, y: merged(x, y).cast(STATE))


def statistics(p: str) -> list[Column]:
    """The summary's statistic columns from a merged partial ``p``."""
    def mean(value: str) -> Column:
        return F.try_divide(F.col(f"{p}.sum_{value}"), F.col(f"{p}.n_{value}"))

    def deviation(value: str) -> Column:
        return F.sqrt(F.when(F.col(f"{p}.n_{value}") > 1, F.col(f"{p}.m2_{value}") / (F.col(f"{p}.n_{value}") - 1)))

    return [
        F.col(f"{p}.n").alias("num_minutes"),
        mean("price").alias("avg_price"),
        F.col(f"{p}.sum_fees").alias("cumulative_fees"),
        mean("liquidity").alias("avg_liquidity"),
        deviation("liquidity").alias("liquidity_sd_raw"),
        F.col(f"{p}.n_volume").alias("num_minutes_with_volume"),
        F.col(f"{p}.last_price").alias("prev_price"),
        F.col(f"{p}.min_price").alias("min_price"),
        F.col(f"{p}.max_price").alias("max_price"),
        deviation("price").alias("std_dev_price"),
    ]


def band_of(recency: Column, timeframes: list[int]) -> Column:
    """The smallest timeframe that holds a snapshot of this recency: its place."""
    band = F.lit(None).cast("int")
    for k in reversed(range(len(timeframes))):
        band = F.when(recency <= F.lit(timeframes[k]), F.lit(k)).otherwise(band)
    return band


def by_timeframe(partials: DataFrame, timeframes: list[int]) -> DataFrame:
    """``(pair_id, timeframe, stats)`` from partials with a ``band`` and the number of
    ``snapshots_kept``: a timeframe folds the partials of its own band and the bands
    before it, each row of the history being in one.  Timeframes longer than there are
    snapshots are left out.  An array holds one pair's partials."""
    one = F.struct("band", F.struct(*PARTIAL).cast(STATE).alias("p"))
    held = partials.groupBy("pair_id").agg(F.array_sort(F.collect_list(one)).alias("parts"), F.max("snapshots_kept").alias("kept"))
    frames = F.array(*[F.struct(F.lit(t).alias("timeframe"), F.lit(k).alias("band")) for k, t in enumerate(timeframes)])
    rows = held.select("pair_id", "parts", F.explode(F.filter(frames, lambda f: f["timeframe"] <= F.col("kept"))).alias("frame"))
    inside = F.transform(F.filter("parts", lambda x: x["band"] <= F.col("frame.band")), lambda x: x["p"])
    rows = rows.select("pair_id", F.col("frame.timeframe").alias("timeframe"), inside.alias("inside")).filter(F.size("inside") > 0)
    return rows.select("pair_id", "timeframe", folded(F.col("inside")).alias("stats"))

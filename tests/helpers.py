"""Small builders for hand-made fixtures."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidepool.schema import HISTORY, PAIRS

T0 = dt.datetime(2024, 1, 1, 12, 0)


def minute(i: int) -> dt.datetime:
    return T0 + dt.timedelta(minutes=i)


def history(spark, rows):
    """rows: (minute_index, pair_id, price, liquidity, fees)."""
    data = [(minute(m), p, float(pr), float(lq), None if f is None else float(f)) for m, p, pr, lq, f in rows]
    return spark.createDataFrame(data, HISTORY)


def pairs(spark, rows):
    """rows: (id, address, bin_step, blacklisted)."""
    data = [(i, a, f"{a}-USDC", 1, 2, bs, 0.25, False, bl) for i, a, bs, bl in rows]
    return spark.createDataFrame(data, PAIRS)


def by_key(df, key="pair_address"):
    return {r[key]: r.asDict() for r in df.collect()}


def raw_entries(spark, rows):
    """rows: dicts with created_at minute index and entry fields (defaults filled)."""
    from tidepool.schema import RAW_SNAPSHOT

    full = []
    for r in rows:
        e = {
            "created_at": minute(r.get("m", 0)),
            "page": r.get("page", 0),
            "address": r["address"],
            "name": r.get("name", "AAA-BBB"),
            "mint_x": r.get("mint_x", "mintA"),
            "mint_y": r.get("mint_y", "mintB"),
            "bin_step": r.get("bin_step", 10),
            "base_fee_percentage": r.get("base_fee_percentage", "0.25"),
            "hide": r.get("hide", False),
            "is_blacklisted": r.get("is_blacklisted", False),
            "cumulative_fee_volume": r.get("counter", "0"),
            "current_price": r.get("price", 1.0),
            "liquidity": r.get("liquidity", 100.0),
            "fees": {"min_30": r.get("min_30", 1.0)},
        }
        full.append(tuple(e[f.name] for f in RAW_SNAPSHOT.fields))
    return spark.createDataFrame(full, RAW_SNAPSHOT)


__all__ = ["F", "history", "pairs", "by_key", "raw_entries", "minute"]

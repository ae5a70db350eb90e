"""Joins on keys of which a few hold a large part of the rows.

A sketch of the most frequent keys (``approx_top_k``: a fixed number of counters a
task, merged) names the heavy ones, ``MOST`` at most.  Their rows meet the other
side's few rows where they lie; all other keys are joined by shuffle as usual.  The
sketch only decides which way a key's rows go: results do not depend on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that can be heavy, and the counters of the sketch.
MOST, COUNTERS = 64, 4096
#: Share of the rows from which on a key counts as heavy.
SHARE = 0.01


def heavy_keys(rows: DataFrame, key: str) -> list:
    """Keys that hold at least ``SHARE`` of the rows: ``MOST`` at most."""
    found = rows.filter(F.col(key).isNotNull()).agg(F.expr(f"approx_top_k({key}, {MOST}, {COUNTERS})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [t["item"] for t in found["top"] or [] if t["count"] >= SHARE * found["n"]]


def join_heavy(rows: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Inner join of many ``rows`` with a ``side`` that holds a key once."""
    heavy = heavy_keys(rows, key)
    if not heavy:
        return rows.join(side, key)
    # The side holds a key once, so MOST rows at most are broadcast.
    few = rows.filter(F.col(key).isin(heavy)).join(F.broadcast(side.filter(F.col(key).isin(heavy))), key)
    return few.unionByName(rows.filter(~F.col(key).isin(heavy)).join(side, key))

"""Key-rule report (S14): the NOT NULL / UNIQUE / FK rules of the stored
tables, checked as aggregations instead of enforced on insert.

One row per rule: ``(table_name, rule, violations)``; ``violations`` counts
offending rows (for uniqueness: rows beyond the first per key).  Each table is
scanned once by one aggregate holding all its rules; foreign keys are anti
joins of distinct keys.  Nothing is collected to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _extra_rows(*keys: str) -> Column:
    """Rows beyond the first per key; rows with a NULL key are not counted
    here (the null rules count them)."""
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    return F.count(F.when(complete, F.lit(1))) - F.count_distinct(*[F.col(k) for k in keys])


def _nulls(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def _rules(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """One aggregate pass over ``df``, unpivoted to one row per rule."""
    agg = df.agg(*[v.cast("bigint").alias(k) for k, v in rules.items()])
    return agg.unpivot([], list(rules), "rule", "violations").select(
        F.lit(table).alias("table_name"), "rule", "violations"
    )


def _orphans(child: DataFrame, key: Column, parent: DataFrame, parent_key: str, table: str, rule: str) -> DataFrame:
    """Rows whose key is in no parent row; those without a key break a null rule.
    Both sides become a row a key where they lie, before they meet: the rows of a
    key that most of them share (a quote mint) are in no task together."""
    keys = parent.select(F.col(parent_key).alias("_k")).distinct()
    rows = child.filter(key.isNotNull()).groupBy(key.alias("_c")).agg(F.count(F.lit(1)).alias("_rows"))
    missing = rows.join(keys, rows["_c"] == keys["_k"], "left_anti")
    return missing.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "violations"
    )


def constraint_report(
    tokens: DataFrame,
    pairs: DataFrame,
    history: DataFrame,
    counters: DataFrame,
    raw: DataFrame | None = None,
) -> DataFrame:
    parts = [
        _rules(
            tokens,
            "tokens",
            {
                "null_id": _nulls(F.col("id").isNull()),
                "null_mint": _nulls(F.col("mint").isNull()),
                "duplicate_mint": _extra_rows("mint"),
                "duplicate_id": _extra_rows("id"),
            },
        ),
        _rules(
            pairs,
            "pairs",
            {
                "null_id": _nulls(F.col("id").isNull()),
                "null_pair_address": _nulls(F.col("pair_address").isNull()),
                **{f"null_{c}": _nulls(F.col(c).isNull()) for c in ("name", "mint_x_id", "mint_y_id", "bin_step", "base_fee_percentage", "hide", "is_blacklisted")},
                "duplicate_pair_address": _extra_rows("pair_address"),
                "duplicate_id": _extra_rows("id"),
            },
        ),
        _orphans(pairs, F.col("mint_x_id"), tokens, "id", "pairs", "orphan_mint_x"),
        _orphans(pairs, F.col("mint_y_id"), tokens, "id", "pairs", "orphan_mint_y"),
        _orphans(history, F.col("pair_id"), pairs, "id", "pair_history", "orphan_pair"),
        _rules(
            history,
            "pair_history",
            {
                "null_created_at": _nulls(F.col("created_at").isNull()),
                "null_pair_id": _nulls(F.col("pair_id").isNull()),
                "duplicate_pair_snapshot": _extra_rows("pair_id", "created_at"),
                "null_price_or_liquidity": _nulls(F.col("price").isNull() | F.col("liquidity").isNull()),
            },
        ),
        _orphans(counters, F.col("pair_id"), pairs, "id", "counters", "orphan_pair"),
        _rules(
            counters,
            "counters",
            {
                "null_pair_id": _nulls(F.col("pair_id").isNull()),
                "null_counter": _nulls(F.col("cumulative_fee_volume").isNull()),
                "duplicate_pair": _extra_rows("pair_id"),
            },
        ),
    ]
    if raw is not None:
        parts.append(
            _rules(
                raw,
                "feed",
                {
                    "duplicate_address_in_snapshot": _extra_rows("created_at", "address"),
                    "unparsed_counter": _nulls(F.col("cumulative_fee_volume").try_cast("float").isNull()),
                },
            )
        )
    return reduce(DataFrame.unionByName, parts)

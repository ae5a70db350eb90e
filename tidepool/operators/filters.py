"""Opportunity-table filters.

A filter model is the grid's JSON document ``{column: condition}``; each
condition is ``{filterType, type, filter[, filterTo]}`` or a combination
``{filterType, operator: AND|OR, conditions: [...]}``.  It folds into one
``Column`` predicate, so the filter runs inside the scan stage.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The default filter model of the opportunity table.
DEFAULT_FILTER_MODEL: dict[str, Any] = {
    "liquidity": {"filterType": "number", "type": "greaterThanOrEqual", "filter": 1000},
    "pct_minutes_with_volume": {"filterType": "number", "type": "greaterThan", "filter": 50},
    "pct_geek_fees_liquidity_24h": {"filterType": "number", "type": "greaterThan", "filter": 0},
}

# Columns shown in the opportunity table (pair_address is the
# hidden row key) and the default sort.
DISPLAY_COLUMNS = (
    "name",
    "bin_step",
    "base_fee_percentage",
    "liquidity",
    "pct_minutes_with_volume",
    "pct_geek_fees_liquidity_24h",
    "pair_address",
)
SORT_COLUMN = "pct_geek_fees_liquidity_24h"


def _condition(col: Column, cond: dict[str, Any]) -> Column:
    if "conditions" in cond:
        parts = [_condition(col, c) for c in cond["conditions"]]
        op = str(cond.get("operator", "AND")).upper()
        return reduce((lambda a, b: a | b) if op == "OR" else (lambda a, b: a & b), parts)
    kind = cond.get("type", "equals")
    value = cond.get("filter")
    if cond.get("filterType", "number") == "text":
        text, v = F.lower(col.cast("string")), F.lower(F.lit(value))
        ops = {
            "contains": lambda: text.contains(v),
            "notContains": lambda: ~text.contains(v),
            "equals": lambda: text == v,
            "notEqual": lambda: text != v,
            "startsWith": lambda: text.startswith(v),
            "endsWith": lambda: text.endswith(v),
        }
    else:
        v = F.lit(value)
        ops = {
            "equals": lambda: col == v,
            "notEqual": lambda: col != v,
            "greaterThan": lambda: col > v,
            "greaterThanOrEqual": lambda: col >= v,
            "lessThan": lambda: col < v,
            "lessThanOrEqual": lambda: col <= v,
            "inRange": lambda: (col >= v) & (col <= F.lit(cond.get("filterTo"))),
        }
    ops["blank"] = lambda: col.isNull()
    ops["notBlank"] = lambda: col.isNotNull()
    if kind not in ops:
        raise ValueError(f"unsupported filter type {kind!r}")
    return ops[kind]()


def filter_predicate(model: dict[str, Any]) -> Column:
    """Fold a filter model into one predicate (rows with NULL fail it)."""
    model = model.get("filterModel", model)
    preds = [F.coalesce(_condition(F.col(c), cond), F.lit(False)) for c, cond in model.items()]
    return reduce(lambda a, b: a & b, preds, F.lit(True))


def apply_filter_model(df: DataFrame, model: dict[str, Any] | None = None) -> DataFrame:
    return df.filter(filter_predicate(DEFAULT_FILTER_MODEL if model is None else model))


def sort_columns(sort_model: list[dict[str, str]] | None = None) -> list[Column]:
    """Grid sort model ``[{colId, sort: asc|desc}, ...]`` as sort keys; the
    default ranks by the 24h fee ratio, descending.  ``pair_address`` breaks
    ties so the order is total."""
    sort_model = sort_model or [{"colId": SORT_COLUMN, "sort": "desc"}]
    keys = [
        F.col(m["colId"]).desc_nulls_last() if m.get("sort", "asc") == "desc" else F.col(m["colId"]).asc_nulls_first()
        for m in sort_model
    ]
    return keys + [F.col("pair_address")]


def opportunities(
    summary: DataFrame,
    model: dict[str, Any] | None = None,
    top: int | None = None,
    sort_model: list[dict[str, str]] | None = None,
) -> DataFrame:
    """The opportunity table (Q7): filter, project, rank (by default on the
    24h fee ratio, descending).

    ``top`` keeps the first rows of the ranking (a top-k report); by default
    every row that passes the filter is returned, in rank order.
    """
    df = apply_filter_model(summary, model).select(*DISPLAY_COLUMNS)
    df = df.orderBy(*sort_columns(sort_model))
    return df.limit(top) if top is not None else df

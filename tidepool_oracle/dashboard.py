"""Oracle SQL for the snapshot axis, metric sub-views and dashboard data."""

from __future__ import annotations

from tidepool_oracle import common as C

DETAIL = "Customer#000000007"


def _view_cols(cols: str) -> str:
    return f"SELECT {cols} FROM ({C.view_sql(30)})"


EV_COUNT = f"WITH {C.EVENTS_HISTORY} SELECT count(DISTINCT created_at) AS c FROM history"

ELIGIBLE = """WITH {history}, cnt AS (SELECT count(DISTINCT created_at) AS update_count FROM history),
tf(timeframe, label) AS (VALUES (5, '5 minutes'), (15, '15 minutes'), (30, '30 minutes'), (60, '1 hour'),
  (120, '2 hours'), (360, '6 hours'), (720, '12 hours'), (1440, '24 hours')),
opts AS (SELECT tf.timeframe, tf.label, cnt.update_count,
                row_number() OVER (ORDER BY tf.timeframe) AS pos,
                count(*) OVER () AS n_opts
         FROM tf, cnt WHERE tf.timeframe <= cnt.update_count)
SELECT timeframe, label, update_count, update_count >= 5 AS ready,
       pos = CASE WHEN n_opts < 4 THEN n_opts ELSE 3 END AS is_default
FROM opts"""

BASE = """pairs_b AS (
  SELECT c.c_name AS pair_address, c.c_mktsegment AS mint_x, n.n_name AS mint_y
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
), cand AS (
  SELECT pair_address, 0 AS side, mint_x AS mint FROM pairs_b
  UNION ALL
  SELECT pair_address, 1 AS side, mint_y AS mint FROM pairs_b WHERE mint_y <> mint_x
), ranked AS (
  SELECT pair_address, mint AS symbol, mint,
         row_number() OVER (PARTITION BY pair_address ORDER BY
           CASE WHEN mint NOT IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY') THEN 0
                WHEN mint = 'BUILDING' THEN 1 WHEN mint = 'MACHINERY' THEN 2 ELSE 3 END, side) AS rn
  FROM cand
), base AS (SELECT pair_address, symbol, mint FROM ranked WHERE rn = 1)"""

SCORES = """ev_first AS (
  SELECT n.n_nationkey, n.n_name, arg_min(TRY_CAST(json_extract_string(e.props, '$.k') AS INTEGER), e.event_id) AS k
  FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY n.n_nationkey, n.n_name
), payloads AS (
  SELECT n_name AS mint,
         CASE WHEN n_nationkey % 5 = 0 THEN '{"tokens": []}'
              ELSE '{"tokens": [{"organicScore": ' || CAST(k AS VARCHAR) || '.5}, {"organicScore": 1.0}]}' END AS payload
  FROM ev_first
), scores AS (
  SELECT mint, CAST(round_even(CAST(json_extract(payload, '$.tokens[0].organicScore') AS DOUBLE), 0) AS BIGINT) AS organic_score
  FROM payloads
)"""


def _chart(a: str, la: str, b: str, lb: str) -> str:
    d = C.detail_sql(DETAIL, 30)
    return f"""WITH d AS ({d})
SELECT dttm, '{la}' AS Legend, CAST({a} AS DOUBLE) AS Value, strftime(dttm, '%I:%M %p') AS Time FROM d
UNION ALL
SELECT dttm, '{lb}' AS Legend, CAST({b} AS DOUBLE) AS Value, strftime(dttm, '%I:%M %p') AS Time FROM d"""


ORACLE: dict[str, str] = {
    "update_count": f"WITH {C.EVENTS_HISTORY} SELECT count(DISTINCT created_at) AS update_count FROM history",
    "eligible_timeframes": ELIGIBLE.format(history=C.EVENTS_HISTORY),
    "eligible_timeframes_lineitem": ELIGIBLE.format(history=C.LINEITEM_HISTORY),
    "latest_snapshots": f"""WITH {C.EVENTS_HISTORY}, u AS (
  SELECT DISTINCT created_at FROM history ORDER BY created_at DESC LIMIT 15)
SELECT created_at, CAST(row_number() OVER (ORDER BY created_at DESC) AS INTEGER) AS recency FROM u""",
    "running_stats": _view_cols(
        "dttm, pair_address, num_minutes, avg_price, cumulative_fees, avg_liquidity, liquidity_std_dev, num_minutes_with_volume"
    ),
    "ticks": _view_cols("dttm, pair_address, price, num_tick_up, num_tick_down, pct_tick_up"),
    "price_range_bins": _view_cols(
        "dttm, pair_address, bin_step, min_price, max_price, pct_price_range, bins_range, num_positions_range, pct_below_max, bins_below_max, near_max"
    ),
    "volatility": _view_cols(
        "dttm, pair_address, liquidity_volatility_ratio, std_dev_price, price_volatility_ratio, std_dev_pct_geek_fees_liquidity_24h, pct_geek_fees_liquidity_24h_volatility_ratio"
    ),
    "base_tokens": f"WITH {BASE} SELECT * FROM base",
    "token_scores": f"WITH {SCORES} SELECT mint, organic_score FROM scores",
    "opportunities": f"""SELECT name, bin_step, base_fee_percentage, liquidity, pct_minutes_with_volume,
       pct_geek_fees_liquidity_24h, pair_address
FROM ({C.summary_sql(60, history=C.LINEITEM_HISTORY, pairs=C.SUPPLIER_PAIRS)})
WHERE liquidity >= 1000 AND pct_minutes_with_volume > 50 AND pct_geek_fees_liquidity_24h > 0""",
    "opportunities_custom": f"""SELECT name, bin_step, base_fee_percentage, liquidity, pct_minutes_with_volume,
       pct_geek_fees_liquidity_24h, pair_address
FROM ({C.summary_sql(15)})
WHERE liquidity BETWEEN 100 AND 900
  AND (lower(name) LIKE '%build%' OR ends_with(lower(name), '_3'))
  AND pct_minutes_with_volume >= 20""",
    "chart_fee_liquidity": _chart("pct_geek_fees_liquidity_24h", "Avg Geek 24h Fee / TVL", "liquidity", "Liquidity"),
    "chart_price_fees": _chart("price", "Price", "fees", "Fees"),
    "price_axis": f"SELECT min(price) * 0.95e0 AS axis_min, max(price) AS axis_max FROM ({C.detail_sql(DETAIL, 30)})",
    "pair_header": f"""WITH {BASE}, {SCORES}, s AS ({C.summary_sql(30)})
SELECT s.pair_address, s.name, s.bin_step, round_even(s.base_fee_percentage, 2) AS base_fee_percentage,
       CAST(round_even(s.pct_below_max, 0) AS BIGINT) AS pct_below_max, s.bins_below_max, s.bins_range,
       b.symbol AS base_symbol, b.mint AS base_mint, sc.organic_score,
       CAST(CASE WHEN round_even(s.pct_below_max, 0) > 0 THEN -round_even(s.pct_below_max, 0) ELSE 0 END AS BIGINT) AS below_max_shown
FROM s LEFT JOIN base b ON s.pair_address = b.pair_address LEFT JOIN scores sc ON b.mint = sc.mint""",
    "freshness": f"""WITH s AS ({C.summary_sql(30)}), c AS ({EV_COUNT}),
f AS (SELECT (SELECT c FROM c) AS update_count, max(dttm) AS last_update FROM s),
g AS (SELECT *, CAST(coalesce(floor(date_diff('second', last_update, TIMESTAMP '2024-01-31 00:07:30') / 60e0), -1) AS BIGINT) AS minutes_ago FROM f)
SELECT update_count, last_update, minutes_ago,
       update_count >= 5 AND minutes_ago >= 0 AS shown,
       update_count >= 5 AND minutes_ago >= 0 AND minutes_ago >= 5 AS offer_refresh
FROM g""",
}

ORACLE.update(
    {
        "chart_price_layer": f"""SELECT dttm, 'Price' AS Legend, CAST(price AS DOUBLE) AS Value, strftime(dttm, '%I:%M %p') AS Time
FROM ({C.detail_sql(DETAIL, 30)})""",
        "pair_row": f"""SELECT * FROM ({C.summary_sql(60, history=C.LINEITEM_HISTORY, pairs=C.SUPPLIER_PAIRS)})
WHERE pair_address = 'Supplier#000000006'""",
        "metrics_view_sql": C.view_sql(60, history=C.LINEITEM_HISTORY, pairs=C.SUPPLIER_PAIRS),
    }
)

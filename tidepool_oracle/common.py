"""Shared SQL fragments for the DuckDB oracle.

Numeric rules, identical to the Spark helpers: an undefined ratio is NULL
(``nullif``), rounding is ``sign(x) * floor(|x| * 10^k + 0.5) / 10^k`` on
doubles, ``ceil`` is cast to BIGINT, logs are base 10 and guarded.
"""

from __future__ import annotations


def R(x: str, k: int) -> str:
    s = f"{10 ** k}e0"
    return f"(sign({x}) * floor(abs({x}) * {s} + 0.5e0) / {s})"


def NZ(x: str) -> str:
    return f"nullif({x}, 0)"


def BINS(ratio: str, bin_step: str) -> str:
    return (
        f"CAST(ceil(CASE WHEN ({ratio}) > 0 AND {bin_step} > 0 "
        f"THEN log10({ratio}) / log10(1e0 + {bin_step} / 10000e0) END) AS BIGINT)"
    )


EVENTS_HISTORY = """history AS (
  SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS created_at,
         user_id AS pair_id,
         CAST(avg(value) AS FLOAT) AS price,
         CAST(sum(value) AS FLOAT) AS liquidity,
         CAST(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0e0 END) AS FLOAT) AS fees
  FROM events
  GROUP BY 1, 2
)"""

EVENTS_HISTORY_PEERS = """history AS (
  SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS created_at, user_id AS pair_id,
         CAST(avg(value) AS FLOAT) AS price, CAST(sum(value) AS FLOAT) AS liquidity,
         CAST(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0e0 END) AS FLOAT) AS fees
  FROM events
  GROUP BY 1, 2, CASE WHEN CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) THEN event_type END
)"""

EVENTS_HISTORY_YOUNG = """history AS (
  SELECT DISTINCT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS created_at
  FROM events WHERE CAST(ts AS DATE) < (SELECT min(CAST(ts AS DATE)) + 4 FROM events)
)"""

CUSTOMER_PAIRS = """pairs AS (
  SELECT c.c_custkey AS id,
         c.c_name AS pair_address,
         c.c_mktsegment || '-' || n.n_name AS name,
         c.c_mktsegment AS mint_x,
         n.n_name AS mint_y,
         c.c_nationkey + 1 AS bin_step,
         CAST((c.c_nationkey % 4 + 1) * 0.25e0 AS FLOAT) AS base_fee_percentage,
         c.c_acctbal < 0 AS is_blacklisted
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

LINEITEM_HISTORY = """history AS (
  SELECT CAST(date_trunc('month', CAST(l_shipdate AS DATE)) AS TIMESTAMP) AS created_at,
         l_suppkey AS pair_id,
         CAST(avg(l_extendedprice / nullif(l_quantity, 0)) AS FLOAT) AS price,
         CAST(sum(l_extendedprice) AS FLOAT) AS liquidity,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice * l_discount ELSE 0e0 END) AS FLOAT) AS fees
  FROM lineitem
  GROUP BY 1, 2
)"""

SUPPLIER_PAIRS = """pairs AS (
  SELECT s.s_suppkey AS id,
         s.s_name AS pair_address,
         'SUP' || CAST(s.s_nationkey % 5 AS VARCHAR) || '-' || n.n_name AS name,
         s.s_nationkey + 1 AS bin_step,
         CAST((s.s_nationkey % 4 + 1) * 0.25e0 AS FLOAT) AS base_fee_percentage,
         s.s_acctbal < 0 AS is_blacklisted
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
)"""

OUTPUT = """dttm, name, pair_address, bin_step, base_fee_percentage, price, liquidity, fees,
  num_minutes, avg_price, cumulative_fees, avg_liquidity, liquidity_std_dev,
  liquidity_volatility_ratio, pct_geek_fees_liquidity, pct_geek_fees_liquidity_24h,
  std_dev_pct_geek_fees_liquidity_24h, pct_geek_fees_liquidity_24h_volatility_ratio,
  num_minutes_with_volume, pct_minutes_with_volume, num_tick_up, num_tick_down, pct_tick_up,
  min_price, max_price, pct_price_range, bins_range, num_positions_range, pct_below_max,
  bins_below_max, near_max, std_dev_price, price_volatility_ratio"""


def metric_ctes(n: int) -> str:
    """CTEs ``updates`` .. ``m3``: rows of the timeframe with first-level metrics.

    Needs ``history`` and ``pairs`` CTEs before it.
    """
    return f"""updates AS (
  SELECT DISTINCT created_at FROM history ORDER BY created_at DESC LIMIT {n}
), facts AS (
  SELECT h.created_at, p.id AS pair_id, p.name, p.pair_address, p.bin_step,
         CAST(p.base_fee_percentage AS DOUBLE) AS base_fee_percentage,
         CAST(h.price AS DOUBLE) AS price,
         CAST(h.liquidity AS DOUBLE) AS liquidity,
         CAST(h.fees AS DOUBLE) AS fees
  FROM history h JOIN pairs p ON h.pair_id = p.id
  WHERE NOT p.is_blacklisted
    AND h.created_at IN (SELECT created_at FROM updates)
), stats AS (
  SELECT *,
    count(*) OVER w AS num_minutes,
    avg(price) OVER w AS avg_price,
    sum(fees) OVER w AS cumulative_fees,
    avg(liquidity) OVER w AS avg_liquidity,
    stddev_samp(liquidity) OVER w AS liquidity_sd_raw,
    count(*) FILTER (WHERE fees > 0) OVER w AS num_minutes_with_volume,
    lag(price) OVER (PARTITION BY pair_id ORDER BY created_at, price, liquidity, fees) AS prev_price,
    min(price) OVER w AS min_price,
    max(price) OVER w AS max_price,
    stddev_samp(price) OVER w AS std_dev_price
  FROM facts
  WINDOW w AS (PARTITION BY pair_id ORDER BY created_at)
), m1 AS (
  SELECT *,
    {R('liquidity_sd_raw', 2)} AS liquidity_std_dev,
    coalesce(prev_price < price, false) AS tick_up,
    coalesce(prev_price > price, false) AS tick_down,
    {R('100e0 * num_minutes_with_volume / ' + NZ('num_minutes'), 0)} AS pct_minutes_with_volume,
    {R('100e0 * (max_price - min_price) / ' + NZ('min_price'), 2)} AS pct_price_range,
    {BINS('max_price / ' + NZ('min_price'), 'bin_step')} AS bins_range,
    100e0 * (max_price - price) / {NZ('max_price')} AS pct_below_max,
    std_dev_price / {NZ('avg_price')} AS price_volatility_ratio
  FROM stats
), m2 AS (
  SELECT *,
    {R('liquidity_std_dev / ' + NZ('avg_liquidity'), 2)} AS liquidity_volatility_ratio,
    CASE WHEN avg_liquidity = 0 THEN 0e0
         ELSE 100e0 * cumulative_fees / {NZ('avg_liquidity + liquidity_std_dev')} END AS pct_geek_fees_liquidity,
    CAST(ceil(bins_range / 69e0) AS BIGINT) AS num_positions_range,
    {BINS('1e0 + pct_below_max / 100e0', 'bin_step')} AS bins_below_max
  FROM m1
), m3 AS (
  SELECT *,
    {R('1440e0 * pct_geek_fees_liquidity / ' + NZ('num_minutes'), 2)} AS pct_geek_fees_liquidity_24h,
    bins_below_max <= 7 AS near_max
  FROM m2
)"""


def second_level_ctes(src: str) -> str:
    """CTEs ``s1``, ``s2``: W12-W14, M12, M13 over the rows of ``src``."""
    return f"""s1 AS (
  SELECT *,
    stddev_samp(pct_geek_fees_liquidity_24h) OVER w2 AS std_dev_pct_geek_fees_liquidity_24h,
    CAST(sum(CAST(tick_up AS INTEGER)) OVER w2 AS BIGINT) AS num_tick_up,
    CAST(sum(CAST(tick_down AS INTEGER)) OVER w2 AS BIGINT) AS num_tick_down
  FROM {src}
  WINDOW w2 AS (PARTITION BY pair_address ORDER BY created_at)
), s2 AS (
  SELECT *, created_at AS dttm,
    std_dev_pct_geek_fees_liquidity_24h / {NZ('pct_geek_fees_liquidity_24h')} AS pct_geek_fees_liquidity_24h_volatility_ratio,
    {R('100e0 * num_tick_up / ' + NZ('num_tick_up + num_tick_down'), 0)} AS pct_tick_up
  FROM s1
)"""


def summary_sql(
    n: int,
    history: str = EVENTS_HISTORY,
    pairs: str = CUSTOMER_PAIRS,
    second: str = "latest",
    timeframe_column: bool = False,
) -> str:
    keep = f"created_at = (SELECT max(created_at) FROM history) AND num_minutes >= {n * 0.9}"
    cols = (f"{n} AS timeframe, " if timeframe_column else "") + OUTPUT
    # A timeframe is only offered once the history has that many snapshots.
    eligible = f"{n} <= (SELECT count(DISTINCT created_at) FROM history)" if timeframe_column else "true"
    if second == "latest":
        return f"""WITH {history}, {pairs}, {metric_ctes(n)},
kept AS (SELECT * FROM m3 WHERE {keep}),
{second_level_ctes('kept')}
SELECT {cols} FROM s2 WHERE {eligible}"""
    return f"""WITH {history}, {pairs}, {metric_ctes(n)},
{second_level_ctes('m3')}
SELECT {cols} FROM s2 WHERE {keep} AND {eligible}"""


def detail_sql(address: str, n: int, history: str = EVENTS_HISTORY, pairs: str = CUSTOMER_PAIRS) -> str:
    return f"""WITH {history}, {pairs}, {metric_ctes(n)},
{second_level_ctes('m3')}
SELECT {OUTPUT} FROM s2 WHERE pair_address = '{address}' ORDER BY created_at"""


def view_sql(n: int, history: str = EVENTS_HISTORY, pairs: str = CUSTOMER_PAIRS) -> str:
    return f"""WITH {history}, {pairs}, {metric_ctes(n)},
{second_level_ctes('m3')}
SELECT {OUTPUT} FROM s2"""


TIMEFRAMES = (5, 15, 30, 60, 120, 360, 720, 1440)


def summaries_sql(history: str = EVENTS_HISTORY, pairs: str = CUSTOMER_PAIRS) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT * FROM ({summary_sql(t, history, pairs, timeframe_column=True)})" for t in TIMEFRAMES
    )

"""Oracle SQL for the ingest path over the events feed."""

from __future__ import annotations

SPLIT = "TIMESTAMP '2024-01-10'"
DRIFT = "TIMESTAMP '2024-01-15'"

RAW = f"""ev AS (
  SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS created_at, user_id, event_type, value,
         CAST(round(value * 100e0) AS BIGINT) AS cents
  FROM events
), daily AS (
  SELECT user_id, created_at,
         sum(CASE WHEN event_type = 'purchase' THEN cents ELSE 0 END) AS day_cents
  FROM ev GROUP BY user_id, created_at
), before_day AS (
  SELECT user_id, created_at,
         coalesce(sum(day_cents) OVER (PARTITION BY user_id ORDER BY created_at
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_cents
  FROM daily
), raw AS (
  SELECT ev.created_at,
         CAST(floor(ev.user_id / 25) AS INTEGER) AS page,
         c.c_name AS address,
         CASE WHEN ev.created_at >= {DRIFT} AND c.c_mktsegment = 'HOUSEHOLD'
              THEN c.c_mktsegment || n.n_name
              ELSE c.c_mktsegment || '-' || n.n_name END AS name,
         c.c_mktsegment AS mint_x,
         n.n_name AS mint_y,
         c.c_nationkey + 1 AS bin_step,
         CAST((c.c_nationkey % 4 + 1) * 0.25e0 AS VARCHAR) AS base_fee_percentage,
         false AS hide,
         (c.c_acctbal < 0) OR (ev.created_at >= {DRIFT} AND c.c_acctbal < 200) AS is_blacklisted,
         CAST(CAST(floor((b.before_cents + ev.cents) / 100) AS BIGINT) AS VARCHAR) || '.' ||
           lpad(CAST((b.before_cents + ev.cents) % 100 AS VARCHAR), 2, '0') AS cumulative_fee_volume,
         ev.value AS current_price,
         abs(c.c_acctbal) + ev.value * 10e0 AS liquidity,
         CASE WHEN ev.event_type = 'error' AND ev.value < 5 THEN 0e0 ELSE ev.value END AS min_30
  FROM ev JOIN before_day b ON ev.user_id = b.user_id AND ev.created_at = b.created_at
  JOIN customer c ON ev.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

STAGED = RAW + """, typed AS (
  SELECT created_at, address,
         TRY_CAST(cumulative_fee_volume AS FLOAT) AS counter,
         CAST(current_price AS DOUBLE) AS current_price,
         CAST(liquidity AS DOUBLE) AS liquidity,
         name, mint_x, mint_y, bin_step,
         TRY_CAST(base_fee_percentage AS FLOAT) AS base_fee_percentage,
         hide, is_blacklisted
  FROM raw
), ranked AS (
  SELECT *, row_number() OVER (
      PARTITION BY created_at, address
      ORDER BY counter NULLS FIRST, current_price NULLS FIRST, liquidity NULLS FIRST, name NULLS FIRST,
               mint_x NULLS FIRST, mint_y NULLS FIRST, bin_step NULLS FIRST,
               base_fee_percentage NULLS FIRST, hide NULLS FIRST, is_blacklisted NULLS FIRST) AS rn
  FROM typed WHERE counter IS NOT NULL
), staged AS (
  SELECT * EXCLUDE (rn),
         CASE WHEN strpos(name, '-') > 0 THEN substr(name, 1, strpos(name, '-') - 1) ELSE name END AS x,
         CASE WHEN strpos(name, '-') > 0 THEN substr(name, strpos(name, '-') + 1) END AS y
  FROM ranked WHERE rn = 1
)"""

ORACLE: dict[str, str] = {
    "activity_cutoff": f"""WITH {RAW}, stops AS (
  SELECT created_at, min(floor(page / 3)) AS stop_batch
  FROM raw WHERE page % 3 = 2 AND min_30 = 0 GROUP BY created_at
)
SELECT r.created_at, r.page, r.address, r.cumulative_fee_volume, r.current_price, r.min_30
FROM raw r LEFT JOIN stops s ON r.created_at = s.created_at
WHERE s.stop_batch IS NULL OR floor(r.page / 3) <= s.stop_batch""",
    "stage_snapshot": f"""WITH {STAGED}
SELECT created_at, address, CAST(counter AS DOUBLE) AS cumulative_fee_volume, current_price, liquidity,
       name, x, y, mint_x, mint_y, bin_step, CAST(base_fee_percentage AS DOUBLE) AS base_fee_percentage,
       hide, is_blacklisted
FROM staged""",
    "new_tokens": f"""WITH {STAGED}, sides AS (
  SELECT created_at, mint_x AS mint, 0 AS side, x AS symbol FROM staged
  UNION ALL
  SELECT created_at, mint_y AS mint, 1 AS side, y AS symbol FROM staged
), firsts AS (
  SELECT *, row_number() OVER (PARTITION BY mint ORDER BY created_at, side, symbol NULLS FIRST) AS rn
  FROM sides WHERE mint IS NOT NULL
)
SELECT mint, symbol, CASE WHEN created_at < {SPLIT} THEN 1 ELSE 2 END AS batch
FROM firsts WHERE rn = 1""",
    "new_pairs": f"""WITH {STAGED}, firsts AS (
  SELECT *, row_number() OVER (PARTITION BY address ORDER BY created_at) AS rn FROM staged
)
SELECT address AS pair_address, name, mint_x, mint_y, bin_step,
       CAST(base_fee_percentage AS DOUBLE) AS base_fee_percentage, hide, is_blacklisted,
       CASE WHEN created_at < {SPLIT} THEN 1 ELSE 2 END AS batch
FROM firsts WHERE rn = 1""",
    "fee_delta": f"""WITH {STAGED}
SELECT created_at, address AS pair_address,
       CAST(CAST(current_price AS FLOAT) AS DOUBLE) AS price,
       CAST(CAST(liquidity AS FLOAT) AS DOUBLE) AS liquidity,
       CAST(counter - coalesce(lag(counter) OVER (PARTITION BY address ORDER BY created_at), counter) AS DOUBLE) AS fees
FROM staged""",
    "counter_upsert": f"""WITH {STAGED}
SELECT address AS pair_address, CAST(arg_max(counter, created_at) AS DOUBLE) AS cumulative_fee_volume
FROM staged GROUP BY address""",
}

# Every rule of the report over tables of these names and natural keys.
_CHECKS = """checks AS (
  SELECT 'tokens' AS table_name, 'null_id' AS rule, count(*) FILTER (WHERE id IS NULL) AS violations FROM tokens
  UNION ALL SELECT 'tokens', 'null_mint', count(*) FILTER (WHERE mint IS NULL) FROM tokens
  UNION ALL SELECT 'tokens', 'duplicate_mint', count(mint) - count(DISTINCT mint) FROM tokens
  UNION ALL SELECT 'tokens', 'duplicate_id', count(id) - count(DISTINCT id) FROM tokens
  UNION ALL SELECT 'pairs', 'null_id', count(*) FILTER (WHERE id IS NULL) FROM pairs
  UNION ALL SELECT 'pairs', 'null_pair_address', count(*) FILTER (WHERE pair_address IS NULL) FROM pairs
  UNION ALL SELECT 'pairs', 'null_name', count(*) FILTER (WHERE name IS NULL) FROM pairs
  UNION ALL SELECT 'pairs', 'null_mint_x_id', count(*) FILTER (WHERE mint_x_id IS NULL) FROM pairs
  UNION ALL SELECT 'pairs', 'null_mint_y_id', count(*) FILTER (WHERE mint_y_id IS NULL) FROM pairs
  UNION ALL SELECT 'pairs', 'null_bin_step', count(*) FILTER (WHERE bin_step IS NULL) FROM pairs
  UNION ALL SELECT 'pairs', 'null_base_fee_percentage', count(*) FILTER (WHERE base_fee_percentage IS NULL) FROM pairs
  UNION ALL SELECT 'pairs', 'null_hide', count(*) FILTER (WHERE hide IS NULL) FROM pairs
  UNION ALL SELECT 'pairs', 'null_is_blacklisted', count(*) FILTER (WHERE is_blacklisted IS NULL) FROM pairs
  UNION ALL SELECT 'pairs', 'duplicate_pair_address', count(pair_address) - count(DISTINCT pair_address) FROM pairs
  UNION ALL SELECT 'pairs', 'duplicate_id', count(id) - count(DISTINCT id) FROM pairs
  UNION ALL SELECT 'pairs', 'orphan_mint_x', count(*) FROM pairs WHERE mint_x_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM tokens t WHERE t.id = pairs.mint_x_id)
  UNION ALL SELECT 'pairs', 'orphan_mint_y', count(*) FROM pairs WHERE mint_y_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM tokens t WHERE t.id = pairs.mint_y_id)
  UNION ALL SELECT 'pair_history', 'orphan_pair', count(*) FROM history h WHERE h.pair_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM pairs p WHERE p.id = h.pair_id)
  UNION ALL SELECT 'pair_history', 'null_created_at', count(*) FILTER (WHERE created_at IS NULL) FROM history
  UNION ALL SELECT 'pair_history', 'null_pair_id', count(*) FILTER (WHERE pair_id IS NULL) FROM history
  UNION ALL SELECT 'pair_history', 'duplicate_pair_snapshot',
    count(*) FILTER (WHERE pair_id IS NOT NULL AND created_at IS NOT NULL) - count(DISTINCT (pair_id, created_at)) FILTER (WHERE pair_id IS NOT NULL AND created_at IS NOT NULL) FROM history
  UNION ALL SELECT 'pair_history', 'null_price_or_liquidity', count(*) FILTER (WHERE price IS NULL OR liquidity IS NULL) FROM history
  UNION ALL SELECT 'counters', 'orphan_pair', count(*) FROM counters c WHERE c.pair_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM pairs p WHERE p.id = c.pair_id)
  UNION ALL SELECT 'counters', 'null_pair_id', count(*) FILTER (WHERE pair_id IS NULL) FROM counters
  UNION ALL SELECT 'counters', 'null_counter', count(*) FILTER (WHERE counter IS NULL) FROM counters
  UNION ALL SELECT 'counters', 'duplicate_pair', count(pair_id) - count(DISTINCT pair_id) FROM counters
  UNION ALL SELECT 'feed', 'duplicate_address_in_snapshot',
    count(*) FILTER (WHERE address IS NOT NULL AND created_at IS NOT NULL) - count(DISTINCT (created_at, address)) FILTER (WHERE address IS NOT NULL AND created_at IS NOT NULL) FROM raw
  UNION ALL SELECT 'feed', 'unparsed_counter', count(*) FILTER (WHERE TRY_CAST(cumulative_fee_volume AS FLOAT) IS NULL) FROM raw
)
SELECT table_name, rule, CAST(violations AS BIGINT) AS violations FROM checks"""

ORACLE["constraint_report"] = f"""WITH {STAGED}, tokens AS (
  SELECT DISTINCT mint AS id, mint FROM (SELECT mint_x AS mint FROM staged UNION ALL SELECT mint_y FROM staged) WHERE mint IS NOT NULL
), pairs AS (
  SELECT address AS id, address AS pair_address, name, mint_x AS mint_x_id, mint_y AS mint_y_id, bin_step, base_fee_percentage, hide, is_blacklisted
  FROM (SELECT *, row_number() OVER (PARTITION BY address ORDER BY created_at) AS nth FROM staged) WHERE nth = 1
), history AS (
  SELECT created_at, address AS pair_id, current_price AS price, liquidity FROM staged
), counters AS (
  SELECT address AS pair_id, arg_max(counter, created_at) AS counter FROM staged GROUP BY address
), {_CHECKS}"""

_BROKEN = ("created_at", "address", "cumulative_fee_volume", "mint_x", "mint_y", "name", "bin_step",
           "base_fee_percentage", "current_price", "liquidity", "page", "hide", "is_blacklisted")
_TEXT = {"cumulative_fee_volume": "'n/a'", "base_fee_percentage": "'free'"}
# The feed with some entries broken, in two batches: late days and a day sent twice.
DIRTY = RAW.replace("), raw AS (", "), clean AS (") + """, placed AS (
  SELECT *, CAST(round(current_price * 100e0) AS BIGINT) % 61 AS broken, b.batch
  FROM clean JOIN (VALUES (1), (2)) b(batch)
    ON CASE WHEN created_at >= TIMESTAMP '2024-01-10' AND created_at < TIMESTAMP '2024-01-20' THEN b.batch = 2
            WHEN created_at = TIMESTAMP '2024-01-05' THEN true ELSE b.batch = 1 END
), raw AS (
  SELECT batch, min_30, """ + ", ".join(f"CASE WHEN broken = {i} THEN {_TEXT.get(c, 'NULL')} ELSE {c} END AS {c}" for i, c in enumerate(_BROKEN)) + """
  FROM placed
)"""

ORACLE["constraint_report_dirty"] = f"""WITH {DIRTY}, tokens AS (
  SELECT mint_x AS id, mint_x AS mint FROM raw
), pairs AS (
  SELECT address AS id, address AS pair_address, name, mint_x AS mint_x_id, mint_y AS mint_y_id, bin_step,
         TRY_CAST(base_fee_percentage AS FLOAT) AS base_fee_percentage, hide, is_blacklisted FROM raw
), history AS (
  SELECT created_at, address AS pair_id, current_price AS price, liquidity FROM raw
), counters AS (
  SELECT address AS pair_id, TRY_CAST(cumulative_fee_volume AS FLOAT) AS counter FROM raw
), {_CHECKS}"""

# Rows as the activity cut-off leaves them, per batch of a feed.
_CUT = """, stops AS (
  SELECT batch, created_at, min(floor(page / 3)) AS stop_batch
  FROM raw WHERE page % 3 = 2 AND min_30 = 0 GROUP BY batch, created_at
), kept AS (
  SELECT r.* FROM raw r LEFT JOIN stops s ON r.batch = s.batch AND r.created_at = s.created_at
  WHERE s.stop_batch IS NULL OR floor(r.page / 3) <= s.stop_batch
)"""

_FLOAT = "TRY_CAST(cumulative_fee_volume AS FLOAT)"
ORACLE["load_accounting"] = f"""WITH {DIRTY}{_CUT}, reasoned AS (
  SELECT *, CASE WHEN created_at IS NULL THEN 'created_at' WHEN address IS NULL THEN 'address'
    WHEN {_FLOAT} IS NULL THEN 'counter' WHEN name IS NULL THEN 'name' WHEN bin_step IS NULL THEN 'bin_step'
    WHEN TRY_CAST(base_fee_percentage AS FLOAT) IS NULL THEN 'base_fee_percentage'
    WHEN current_price IS NULL THEN 'current_price' WHEN liquidity IS NULL THEN 'liquidity'
    WHEN page IS NULL THEN 'page' END AS reason FROM raw
), reasons(reason) AS (
  VALUES ('json'), ('created_at'), ('address'), ('counter'), ('name'), ('bin_step'), ('base_fee_percentage'), ('current_price'), ('liquidity'), ('page')
), valid AS (
  SELECT * FROM kept WHERE created_at IS NOT NULL AND address IS NOT NULL AND {_FLOAT} IS NOT NULL AND name IS NOT NULL
    AND bin_step IS NOT NULL AND TRY_CAST(base_fee_percentage AS FLOAT) IS NOT NULL AND current_price IS NOT NULL
    AND liquidity IS NOT NULL AND page IS NOT NULL
), staged AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch, created_at, address
      ORDER BY {_FLOAT}, current_price, liquidity, name, mint_x NULLS FIRST, mint_y NULLS FIRST) AS nth FROM valid) WHERE nth = 1
), seen AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch, address ORDER BY created_at, name) AS first FROM staged) WHERE first = 1
), made AS (
  SELECT address, min(batch) AS since FROM seen WHERE mint_x IS NOT NULL AND mint_y IS NOT NULL GROUP BY address
), paired AS (
  SELECT s.* FROM staged s JOIN made m ON m.address = s.address AND m.since <= s.batch
), state AS (
  SELECT address, max(created_at) AS at FROM paired WHERE batch = 1 GROUP BY address
), placed2 AS (
  SELECT p.*, p.batch = 2 AND p.created_at <= s.at AS behind,
         EXISTS (SELECT 1 FROM paired q WHERE q.batch = 1 AND q.address = p.address AND q.created_at = p.created_at) AS held
  FROM paired p LEFT JOIN state s ON s.address = p.address
), n AS (SELECT unnest([1, 2]) AS batch),
counted AS (
  SELECT batch, 'rows_in' AS outcome, (SELECT count(*) FROM raw r WHERE r.batch = n.batch) AS rows FROM n
  UNION ALL SELECT n.batch, 'rejected_' || x.reason, (SELECT count(*) FROM reasoned r WHERE r.batch = n.batch AND r.reason = x.reason) FROM n, reasons x
  UNION ALL SELECT batch, 'cut', (SELECT count(*) FROM reasoned r WHERE r.batch = n.batch AND r.reason IS NULL) - (SELECT count(*) FROM valid v WHERE v.batch = n.batch) FROM n
  UNION ALL SELECT batch, 'duplicate', (SELECT count(*) FROM valid v WHERE v.batch = n.batch) - (SELECT count(*) FROM staged s WHERE s.batch = n.batch) FROM n
  UNION ALL SELECT batch, 'unpaired', (SELECT count(*) FROM staged s WHERE s.batch = n.batch) - (SELECT count(*) FROM paired p WHERE p.batch = n.batch) FROM n
  UNION ALL SELECT batch, 'loaded', (SELECT count(*) FROM placed2 p WHERE p.batch = n.batch AND NOT coalesce(p.behind, false)) FROM n
  UNION ALL SELECT batch, 'late', (SELECT count(*) FROM placed2 p WHERE p.batch = n.batch AND p.behind AND NOT p.held) FROM n
  UNION ALL SELECT batch, 'replay', (SELECT count(*) FROM placed2 p WHERE p.batch = n.batch AND p.behind AND p.held) FROM n
)
SELECT CAST(batch AS INTEGER) AS batch, outcome, CAST(rows AS BIGINT) AS rows FROM counted"""

ORACLE["load_pages"] = f"""WITH {STAGED.replace("FROM raw", "FROM kept", 1).replace(", typed AS (", ", stops AS (SELECT created_at, min(floor(page / 3)) AS stop_batch FROM raw WHERE page % 3 = 2 AND min_30 = 0 GROUP BY created_at), kept AS (SELECT r.* FROM raw r LEFT JOIN stops s ON r.created_at = s.created_at WHERE s.stop_batch IS NULL OR floor(r.page / 3) <= s.stop_batch), typed AS (", 1)}
SELECT created_at, address AS pair_address,
       CAST(CAST(current_price AS FLOAT) AS DOUBLE) AS price,
       CAST(CAST(liquidity AS FLOAT) AS DOUBLE) AS liquidity,
       CAST(counter - coalesce(lag(counter) OVER (PARTITION BY address ORDER BY created_at), counter) AS DOUBLE) AS fees
FROM staged"""

ORACLE["stream_counters"] = f"""WITH {STAGED}
SELECT address AS pair_address, CAST(arg_max(counter, created_at) AS DOUBLE) AS cumulative_fee_volume, max(created_at) AS updated_at
FROM staged GROUP BY address"""

# History and pairs as the loader writes them from the staged feed: fees from
# the counter delta, pair attributes frozen at first sight.
LOADED_HISTORY = STAGED + """, history AS (
  SELECT created_at, address AS pair_id,
         CAST(current_price AS FLOAT) AS price,
         CAST(liquidity AS FLOAT) AS liquidity,
         counter - coalesce(lag(counter) OVER (PARTITION BY address ORDER BY created_at), counter) AS fees
  FROM staged
)"""

LOADED_PAIRS = """pairs AS (
  SELECT address AS id, address AS pair_address, name, bin_step, base_fee_percentage, is_blacklisted
  FROM (SELECT *, row_number() OVER (PARTITION BY address ORDER BY created_at) AS rn FROM staged)
  WHERE rn = 1
)"""

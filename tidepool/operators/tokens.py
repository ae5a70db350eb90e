"""Token-side operators: base token of each pair (J4, J5) and token scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators.heavy import join_heavy

# Quote-token mints of the live feed.
SOL_MINT = "So11111111111111111111111111111111111111112"
USDC_MINT = "EPjFWdd5AufqSSqeM2qN1xzybapC8G4wEGGkZwyTDt1v"
USDT_MINT = "Es9vMFrzaCERmJfrF4H2FYD4KCoNkY11McCe8BenwNYB"
QUOTE_MINTS = (SOL_MINT, USDC_MINT, USDT_MINT)
# When both mints are quotes, prefer SOL, then USDT.
PREFERRED_QUOTES = (SOL_MINT, USDT_MINT)

SCORE_PAYLOAD = T.StructType(
    [T.StructField("tokens", T.ArrayType(T.StructType([T.StructField("organicScore", T.DoubleType())])))]
)


def base_tokens(
    pairs: DataFrame,
    tokens: DataFrame,
    quote_mints: tuple[str, ...] = QUOTE_MINTS,
    preferred: tuple[str, ...] = PREFERRED_QUOTES,
) -> DataFrame:
    """The token a pair is "about", for every pair at once (Q5).

    Choice order: the first mint that is not a quote mint (x side before y);
    else the first preferred quote present, in order; else the x-side token.
    The pair-to-token match is ``id = mint_x_id OR id = mint_y_id``: it is run
    as an equi join on the distinct ids of the pair, so a pair whose two mints
    are the same token yields one candidate, as the OR join does.
    Output: ``pair_address, symbol, mint``.
    """
    x = F.struct(F.lit(0).alias("side"), F.col("mint_x_id").alias("tid"))
    y = F.struct(F.lit(1).alias("side"), F.col("mint_y_id").alias("tid"))
    both = F.when(F.col("mint_x_id") == F.col("mint_y_id"), F.array(x)).otherwise(F.array(x, y))
    sides = pairs.select("pair_address", F.explode(both).alias("c")).select("pair_address", "c.side", "c.tid")
    # A quote token is in most pairs: its rows must not meet in one task.
    cand = join_heavy(sides, tokens.select(F.col("id").alias("tid"), "mint", "symbol"), "tid")
    prio = F.when(~F.col("mint").isin(*quote_mints), F.lit(0))
    for i, m in enumerate(preferred):
        prio = prio.when(F.col("mint") == F.lit(m), F.lit(i + 1))
    prio = prio.otherwise(F.lit(len(preferred) + 1))
    best = cand.groupBy("pair_address").agg(
        F.min_by(F.struct("symbol", "mint"), F.struct(prio.alias("p"), F.col("side"))).alias("b")
    )
    return best.select("pair_address", F.col("b.symbol").alias("symbol"), F.col("b.mint").alias("mint"))


def token_scores(payloads: DataFrame) -> DataFrame:
    """Score of a token: the first search hit's ``organicScore``, rounded half
    to even; NULL when there is no hit or the document does not parse.

    Input ``mint, payload`` (JSON text or an already-parsed struct).
    Output ``mint, organic_score`` (BIGINT).
    """
    payload = F.col("payload")
    if isinstance(payloads.schema["payload"].dataType, T.StringType):
        payload = F.from_json(payload, SCORE_PAYLOAD)
    first = F.get(payload.getField("tokens"), 0).getField("organicScore")
    return payloads.select("mint", F.bround(first, 0).cast("bigint").alias("organic_score"))

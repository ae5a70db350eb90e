"""Map the driver's generated tables onto the pool data model.

Two mappings, both pure DataFrame transformations of the given parquet tables:

* events  -> one snapshot per day (30 snapshots), one pool per user
  (``customer``), price = average event value, liquidity = summed value,
  fees = summed purchase value.  Also a raw page feed (one entry per event,
  so an address repeats inside a snapshot) for the ingest path, and a token
  score payload per nation.
* lineitem -> one snapshot per ship month (83 snapshots), one pool per
  supplier; used where a timeframe of 60 snapshots must be meaningful.

Every id is a natural key of the source table, so the oracle SQL can rebuild
the same relations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidepool.functions.numeric import safe_div


# The three token mints that play the quote-token role in the
# events mapping (the real feed uses the SOL, USDC and USDT mints).
EVENTS_QUOTE_MINTS = ("BUILDING", "AUTOMOBILE", "MACHINERY")
# Page size of the synthetic feed, in users, and the day from
# which some attributes drift (to show that dimensions freeze at first sight).
EVENTS_PAGE_USERS = 25
EVENTS_DRIFT_DAY = "2024-01-15"
# The events feed is loaded as two batches split on this day.
EVENTS_SPLIT_DAY = "2024-01-10"


_TABLES: dict[str, tuple[SparkSession, DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The generated table ``name`` (the read is reused within a session)."""
    path = f"{sf_dir}/{name}.parquet"
    hit = _TABLES.get(path)
    if hit is None or hit[0] is not spark or hit[1].sparkSession is not spark:
        hit = (spark, spark.read.parquet(path))
        _TABLES[path] = hit
    return hit[1]


def _day(ts: str):
    return F.col(ts).cast("date").cast("timestamp_ntz")


def events_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pair_history`` from events: one row per (user, day)."""
    ev = table(spark, sf_dir, "events")
    return (
        ev.groupBy(_day("ts").alias("created_at"), F.col("user_id").alias("pair_id"))
        .agg(
            F.avg("value").cast("float").alias("price"),
            F.sum("value").cast("float").alias("liquidity"),
            F.sum(F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(F.lit(0.0)))
            .cast("float")
            .alias("fees"),
        )
    )


def events_history_peers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events_history`` with several rows a pair at the newest snapshot: one for
    each type of its events there."""
    ev = table(spark, sf_dir, "events")
    day = _day("ts")
    newest = ev.agg(F.max(day)).scalar()
    peers = ev.filter(day == newest).groupBy(day.alias("created_at"), F.col("user_id").alias("pair_id"), "event_type").agg(
        F.avg("value").cast("float").alias("price"),
        F.sum("value").cast("float").alias("liquidity"),
        F.sum(F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(F.lit(0.0))).cast("float").alias("fees"),
    )
    older = events_history(spark, sf_dir).filter(F.col("created_at") < newest)
    return older.unionByName(peers.drop("event_type"))


def events_history_young(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events history as it was on its fourth day."""
    h = events_history(spark, sf_dir)
    return h.filter(F.col("created_at") < table(spark, sf_dir, "events").agg(F.min(_day("ts")) + F.expr("INTERVAL 4 DAYS")).scalar())


def _customer_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation is a fixed 25-row reference table.
    return cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey)


def customer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pairs`` dimension from customer x nation (id = c_custkey)."""
    c = _customer_attrs(spark, sf_dir)
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("pair_address"),
        F.concat_ws("-", "c_mktsegment", "n_name").alias("name"),
        F.xxhash64("c_mktsegment").alias("mint_x_id"),
        F.xxhash64("n_name").alias("mint_y_id"),
        (F.col("c_nationkey") + 1).alias("bin_step"),
        (((F.col("c_nationkey") % 4) + 1) * F.lit(0.25)).cast("float").alias("base_fee_percentage"),
        F.lit(False).alias("hide"),
        (F.col("c_acctbal") < 0).alias("is_blacklisted"),
    )


def customer_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tokens`` dimension: segments (x side) and nation names (y side)."""
    c = _customer_attrs(spark, sf_dir)
    mints = c.select(F.col("c_mktsegment").alias("mint")).unionByName(
        c.select(F.col("n_name").alias("mint"))
    ).distinct()
    return mints.select(F.xxhash64("mint").alias("id"), "mint", F.col("mint").alias("symbol"))


def lineitem_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pair_history`` from lineitem: one row per (supplier, ship month)."""
    li = table(spark, sf_dir, "lineitem")
    month = F.trunc(F.col("l_shipdate").cast("date"), "month").cast("timestamp_ntz")
    return li.groupBy(month.alias("created_at"), F.col("l_suppkey").alias("pair_id")).agg(
        F.avg(safe_div(F.col("l_extendedprice"), F.col("l_quantity"))).cast("float").alias("price"),
        F.sum("l_extendedprice").cast("float").alias("liquidity"),
        F.sum(
            F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice") * F.col("l_discount")).otherwise(
                F.lit(0.0)
            )
        )
        .cast("float")
        .alias("fees"),
    )


def supplier_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pairs`` dimension from supplier x nation (id = s_suppkey)."""
    s = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    s = s.join(F.broadcast(nation), s.s_nationkey == nation.n_nationkey)
    return s.select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("pair_address"),
        F.concat(F.lit("SUP"), (F.col("s_nationkey") % 5).cast("string"), F.lit("-"), F.col("n_name")).alias(
            "name"
        ),
        F.xxhash64(F.concat(F.lit("SUP"), (F.col("s_nationkey") % 5).cast("string"))).alias("mint_x_id"),
        F.xxhash64("n_name").alias("mint_y_id"),
        (F.col("s_nationkey") + 1).alias("bin_step"),
        (((F.col("s_nationkey") % 4) + 1) * F.lit(0.25)).cast("float").alias("base_fee_percentage"),
        F.lit(False).alias("hide"),
        (F.col("s_acctbal") < 0).alias("is_blacklisted"),
    )


def events_raw_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw page feed: one entry per event, keyed by the user's address.

    The cumulative fee counter of an event is the user's purchases (in cents)
    through the previous day plus the event's own value, rendered as decimal
    text like the real feed.  Duplicate addresses inside a snapshot therefore
    carry different counters, and the smallest one must be kept.
    """
    ev = table(spark, sf_dir, "events")
    cents = F.round(F.col("value") * F.lit(100.0)).cast("bigint")
    ev = ev.select(
        _day("ts").alias("created_at"),
        "user_id",
        "event_type",
        "value",
        cents.alias("cents"),
    )
    # Purchases per user-day (partial aggregation), then a running sum over the
    # user's days; a user has at most one row per snapshot here.
    daily = ev.groupBy("user_id", "created_at").agg(
        F.sum(F.when(F.col("event_type") == "purchase", F.col("cents")).otherwise(F.lit(0))).alias("day_cents")
    )
    w = Window.partitionBy("user_id").orderBy("created_at").rowsBetween(Window.unboundedPreceding, -1)
    daily = daily.select(
        "user_id", "created_at", F.coalesce(F.sum("day_cents").over(w), F.lit(0)).alias("before_cents")
    )
    c = _customer_attrs(spark, sf_dir)
    drift = F.col("created_at") >= F.lit(EVENTS_DRIFT_DAY).cast("timestamp_ntz")
    total = F.col("before_cents") + F.col("cents")
    counter = F.concat(
        F.floor(total / F.lit(100)).cast("string"), F.lit("."), F.lpad((total % F.lit(100)).cast("string"), 2, "0")
    )
    zero_activity = (F.col("event_type") == "error") & (F.col("value") < F.lit(5.0))
    return (
        ev.join(daily, ["user_id", "created_at"])
        .join(c, ev.user_id == c.c_custkey)
        .select(
            "created_at",
            F.floor(F.col("user_id") / F.lit(EVENTS_PAGE_USERS)).cast("int").alias("page"),
            F.col("c_name").alias("address"),
            # After the drift day the name loses its dash for one segment.
            F.when(drift & (F.col("c_mktsegment") == "HOUSEHOLD"), F.concat("c_mktsegment", "n_name"))
            .otherwise(F.concat_ws("-", "c_mktsegment", "n_name"))
            .alias("name"),
            F.col("c_mktsegment").alias("mint_x"),
            F.col("n_name").alias("mint_y"),
            (F.col("c_nationkey") + 1).alias("bin_step"),
            (((F.col("c_nationkey") % 4) + 1) * F.lit(0.25)).cast("string").alias("base_fee_percentage"),
            F.lit(False).alias("hide"),
            ((F.col("c_acctbal") < 0) | (drift & (F.col("c_acctbal") < 200))).alias("is_blacklisted"),
            counter.alias("cumulative_fee_volume"),
            F.col("value").alias("current_price"),
            (F.abs(F.col("c_acctbal")) + F.col("value") * F.lit(10.0)).alias("liquidity"),
            F.struct(F.when(zero_activity, F.lit(0.0)).otherwise(F.col("value")).alias("min_30")).alias("fees"),
        )
    )


# Which entries of the dirty feed lack or break which field, by the
# cents of their price modulo ``DIRTY_CYCLE``.
DIRTY_CYCLE = 61
DIRTY_FIELDS = ("created_at", "address", "cumulative_fee_volume", "mint_x", "mint_y", "name", "bin_step",
                "base_fee_percentage", "current_price", "liquidity", "page", "hide", "is_blacklisted")
# The dirty feed's second batch, these days, and a day sent twice.
DIRTY_LATE_DAYS = ("2024-01-10", "2024-01-20")
DIRTY_REPLAY_DAY = "2024-01-05"


def events_dirty_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw feed with every rule of the stored tables broken by some entries, as
    two batches (``batch``): the second one brings late days and a replayed one."""
    raw = events_raw_snapshots(spark, sf_dir)
    case = F.round(F.col("current_price") * F.lit(100.0)).cast("bigint") % F.lit(DIRTY_CYCLE)
    day = F.col("created_at")
    late = (day >= F.lit(DIRTY_LATE_DAYS[0]).cast("timestamp_ntz")) & (day < F.lit(DIRTY_LATE_DAYS[1]).cast("timestamp_ntz"))
    twice = day == F.lit(DIRTY_REPLAY_DAY).cast("timestamp_ntz")
    batches = F.when(late, F.array(F.lit(2))).when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    marked = raw.withColumn("case", case).withColumn("batch", F.explode(batches))
    text = {"cumulative_fee_volume": "n/a", "base_fee_percentage": "free"}
    broken = {c: F.when(F.col("case") == i, F.lit(text.get(c))).otherwise(F.col(c)).alias(c) for i, c in enumerate(DIRTY_FIELDS)}
    return marked.select(*[broken.get(c, F.col(c)) for c in raw.columns], "batch")


def unguarded_tables(feed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Tokens, pairs, history and counters as the entries of a feed would make them
    without any rule: one row an entry, x-side tokens only."""
    def ident(c: str):
        return F.when(F.col(c).isNotNull(), F.xxhash64(c))

    tokens = feed.select(ident("mint_x").alias("id"), F.col("mint_x").alias("mint"), "name")
    pairs = feed.select(
        ident("address").alias("id"), F.col("address").alias("pair_address"), "name", ident("mint_x").alias("mint_x_id"),
        ident("mint_y").alias("mint_y_id"), "bin_step", F.col("base_fee_percentage").try_cast("float").alias("base_fee_percentage"),
        "hide", "is_blacklisted",
    )
    history = feed.select("created_at", ident("address").alias("pair_id"), F.col("current_price").alias("price"), "liquidity")
    counters = feed.select(ident("address").alias("pair_id"), F.col("cumulative_fee_volume").try_cast("float").alias("cumulative_fee_volume"))
    return tokens, pairs, history, counters


def nation_score_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token score search results as JSON text, one document per nation mint.

    The first hit's score is ``k + 0.5`` where ``k`` is the ``props`` value of
    the earliest event of a customer of that nation; every fifth nation has an
    empty result list.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "props")
    c = _customer_attrs(spark, sf_dir).select("c_custkey", "n_nationkey", "n_name")
    k = F.get_json_object("props", "$.k").try_cast("int")
    # A user's first event before the join: it takes a row a user, not a row an event.
    users = ev.groupBy("user_id").agg(F.min_by(k, F.col("event_id")).alias("k"), F.min("event_id").alias("event_id"))
    first = (
        users.join(c, users.user_id == c.c_custkey)
        .groupBy("n_nationkey", "n_name")
        .agg(F.min_by("k", F.col("event_id")).alias("k"))
    )
    hit = F.concat(
        F.lit('{"tokens": [{"organicScore": '),
        F.col("k").cast("string"),
        F.lit('.5}, {"organicScore": 1.0}]}'),
    )
    return first.select(
        F.col("n_name").alias("mint"),
        F.when(F.col("n_nationkey") % 5 == 0, F.lit('{"tokens": []}')).otherwise(hit).alias("payload"),
    )


__all__ = [
    "EVENTS_QUOTE_MINTS",
    "customer_pairs",
    "customer_tokens",
    "events_history",
    "events_raw_snapshots",
    "lineitem_history",
    "nation_score_payloads",
    "supplier_pairs",
    "table",
]

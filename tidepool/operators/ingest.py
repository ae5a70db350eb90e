"""Snapshot ingest as DataFrame transformations.

Every function is pure (DataFrames in, DataFrames out); ``plans.load`` writes
the results.  A batch may hold one snapshot or many: first sight, the x-before-y
symbol priority and the counter deltas are all resolved by ``created_at``
inside the batch, seeded from the stored state.

Skew: the groupings are by (snapshot, address), by address, by mint and by
(snapshot, page batch); all are aggregations or first-row windows that Spark
reduces map-side, so a hot address, mint or snapshot shrinks before any shuffle.
The counter lag is a window by pair after the per-snapshot dedupe, so a partition
holds at most one row per snapshot of the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidepool.functions.text import split_name

# Pages are fetched this many at a time (one batch); the feed
# stops after the first batch whose last page shows a pool with no activity.
PAGES_PER_BATCH = 3


def pair_id(address) -> F.Column:
    """Surrogate pair id: a 64-bit hash of the natural key (collisions are
    reported by ``constraint_report``)."""
    return F.xxhash64(address)


def token_id(mint) -> F.Column:
    return F.xxhash64(mint)


def flatten_pages(pages: DataFrame) -> DataFrame:
    """Page documents ``{created_at, page, pairs: [...]}`` -> one row per entry.

    A document without ``pairs``, or one that does not parse (whole or in part),
    gives a row without entry fields, which ``rejected_entries`` lists: the second
    with its text in ``_corrupt_record``.  Entries that such a document still
    yields go on as entries."""
    corrupt = [c for c in ("_corrupt_record",) if c in pages.columns]
    lost = F.col("pairs").isNull()
    for c in corrupt:
        lost = lost | F.col(c).isNotNull()
    with_self = F.transform(F.coalesce("pairs", F.array()), lambda e: F.struct(e.alias("e"), F.lit(False).alias("lost")))
    itself = F.array(F.struct(F.lit(None).alias("e"), F.lit(True).alias("lost")))
    rows = pages.select("created_at", "page", *corrupt, F.explode(F.when(lost, F.concat(with_self, itself)).otherwise(with_self)).alias("x"))
    return rows.select("created_at", "page", "x.e.*", *[F.when(F.col("x.lost"), F.col(c)).alias(c) for c in corrupt])


def activity_cutoff(raw: DataFrame, pages_per_batch: int = PAGES_PER_BATCH) -> DataFrame:
    """Keep the pages the paginated fetch would have kept.

    Pages are read in batches of ``pages_per_batch``; only the **last page of
    each batch** is inspected, and the feed stops after the first batch whose
    last page holds an entry with ``fees.min_30 == 0`` (that batch is kept
    whole).  A snapshot where no batch qualifies keeps everything.

    Entries are matched back on (snapshot, page batch), not on the snapshot
    alone: a live micro-batch is often a single snapshot, and one join key
    would put every entry in one task.  A page batch holds at most
    ``pages_per_batch`` pages, so the keys spread a large snapshot out.
    """
    batch = F.floor(F.col("page") / F.lit(pages_per_batch)).alias("page_batch")
    is_last = F.col("page") % F.lit(pages_per_batch) == F.lit(pages_per_batch - 1)
    stop = is_last & (F.col("fees.min_30") == F.lit(0.0))
    per_batch = raw.groupBy("created_at", batch).agg(F.max(stop).alias("stops_here"))
    # One row per snapshot (partial aggregation, so a large snapshot is
    # pre-combined); joined back on the snapshot, where AQE broadcasts it or
    # splits a skewed snapshot partition.  A per-snapshot window here would
    # instead put all of a large snapshot's page batches in one task.
    first_stop = (
        per_batch.filter(F.col("stops_here")).groupBy("created_at").agg(F.min("page_batch").alias("stop_batch"))
    )
    kept = (
        per_batch.join(first_stop, "created_at", "left")
        .filter(F.col("stop_batch").isNull() | (F.col("page_batch") <= F.col("stop_batch")))
        .select("created_at", "page_batch")
    )
    return raw.join(kept, (raw["created_at"] == kept["created_at"]) & (batch == kept["page_batch"]), "left_semi")


def stage_snapshot(raw: DataFrame) -> DataFrame:
    """Type, dedupe and split a raw snapshot feed.

    * the counter text is cast to 32-bit FLOAT; entries that break a NOT NULL
      rule are left out (``rejected_entries`` lists them with the reason);
    * one entry per (snapshot, address): the smallest counter wins, ties broken
      by the remaining fields so the choice is deterministic;
    * ``name`` splits on the first dash into the x and y symbols.
    """
    counter = F.col("cumulative_fee_volume").try_cast("float")
    fee_pct = F.col("base_fee_percentage").cast("string").try_cast("float")
    typed = raw.filter(_reason(raw, mints=False).isNull()).select(
        "created_at",
        "address",
        counter.alias("counter"),
        F.col("current_price").cast("double").alias("current_price"),
        F.col("liquidity").cast("double").alias("liquidity"),
        "name",
        "mint_x",
        "mint_y",
        F.col("bin_step").cast("int").alias("bin_step"),
        fee_pct.alias("base_fee_percentage"),
        F.coalesce(F.col("hide"), F.lit(False)).alias("hide"),
        F.coalesce(F.col("is_blacklisted"), F.lit(False)).alias("is_blacklisted"),
    )
    fields = [c for c in typed.columns if c not in ("created_at", "address")]
    x, y = split_name(F.col("name"))
    return _first(typed, ["created_at", "address"], fields).select("created_at", "address", *fields, x.alias("x"), y.alias("y"))


def _first(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key: Spark keeps one row a key and task before the
    shuffle (a group limit), so a frequent key is reduced where it lies."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("nth", F.row_number().over(w)).filter(F.col("nth") == 1).drop("nth")


# Why an entry cannot be loaded, in the order in which they are looked at.
REASONS = ("json", "created_at", "address", "counter", "mint", "name", "bin_step", "base_fee_percentage", "current_price", "liquidity", "page")


def reject_reason(raw: DataFrame, cutoff: bool, mints: bool = True) -> Column:
    """The first of ``REASONS`` that holds for an entry, or NULL."""
    reason = _reason(raw, mints)
    return F.coalesce(reason, F.when(F.col("page").isNull(), F.lit("page"))) if cutoff else reason


def _reason(raw: DataFrame, mints: bool = True) -> Column:
    """Why a raw entry cannot be loaded, or NULL: the one definition that
    ``stage_snapshot`` and ``rejected_entries`` share.  Every NOT NULL rule of the
    stored tables is in it.  An entry without one of its mints gets no pair, but
    its other mint is a token, so staging keeps it (``mints=False``)."""
    corrupt = F.when(F.col("_corrupt_record").isNotNull(), F.lit("json")) if "_corrupt_record" in raw.columns else F.lit(None).cast("string")
    missing = {
        "created_at": F.col("created_at").isNull(),
        "address": F.col("address").isNull(),
        "counter": F.col("cumulative_fee_volume").try_cast("float").isNull(),
        "mint": F.col("mint_x").isNull() | F.col("mint_y").isNull(),
        "name": F.col("name").isNull(),
        "bin_step": F.col("bin_step").isNull(),
        "base_fee_percentage": F.col("base_fee_percentage").cast("string").try_cast("float").isNull(),
        "current_price": F.col("current_price").isNull(),
        "liquidity": F.col("liquidity").isNull(),
    }
    return F.coalesce(corrupt, *[F.when(c, F.lit(n)) for n, c in missing.items() if mints or n != "mint"])


def rejected_entries(raw: DataFrame, cutoff: bool = False) -> DataFrame:
    """Raw entries that cannot be loaded, with the reason; ``stage_snapshot``
    leaves them out.  With ``cutoff`` also those without a page number, which the
    activity cut-off cannot place."""
    return raw.withColumn("reason", reject_reason(raw, cutoff)).filter(F.col("reason").isNotNull())


def new_tokens(staged: DataFrame, tokens: DataFrame) -> DataFrame:
    """Tokens first seen in this batch.

    Within the batch a mint takes the symbol of its earliest snapshot, x side
    before y side, then the smallest symbol.  Mints already stored are skipped
    (their symbol never changes).
    """
    sides = staged.select("created_at", F.col("mint_x").alias("mint"), F.lit(0).alias("side"), F.col("x").alias("symbol")).unionByName(
        staged.select("created_at", F.col("mint_y").alias("mint"), F.lit(1).alias("side"), F.col("y").alias("symbol"))
    )
    first = _first(sides.filter(F.col("mint").isNotNull()), ["mint"], ["created_at", "side", "symbol"])
    fresh = first.join(tokens.select("mint"), "mint", "left_anti")
    return fresh.select(token_id(F.col("mint")).alias("id"), "mint", "symbol")


def new_pairs(staged: DataFrame, tokens: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs first seen in this batch, with attributes of their first snapshot.

    ``tokens`` must already contain this batch's new tokens, and so every mint of
    ``staged``: token ids are hashes of the mints, so they are computed rather than
    joined (a mint that most pairs share would meet in one task), and
    ``constraint_report`` looks for orphans.  Pairs whose address is stored already
    are skipped: stored attributes never change.  A pair needs both its mints.
    """
    attrs = ["name", "mint_x", "mint_y", "bin_step", "base_fee_percentage", "hide", "is_blacklisted"]
    first = _first(staged.select("created_at", "address", *attrs), ["address"], ["created_at", *attrs])
    fresh = first.join(pairs.select(F.col("pair_address").alias("address")), "address", "left_anti")
    return fresh.filter(F.col("mint_x").isNotNull() & F.col("mint_y").isNotNull()).select(
        pair_id(F.col("address")).alias("id"),
        F.col("address").alias("pair_address"),
        "name",
        token_id(F.col("mint_x")).alias("mint_x_id"),
        token_id(F.col("mint_y")).alias("mint_y_id"),
        "bin_step",
        "base_fee_percentage",
        "hide",
        "is_blacklisted",
    )


def with_state(staged: DataFrame, counters: DataFrame) -> DataFrame:
    """Staged rows beside their pair's stored counter (J3): ``stored`` and
    ``stored_at``, NULL at first sight."""
    rows = staged.select(
        "created_at", "address", pair_id(F.col("address")).alias("pair_id"), "counter", "current_price", "liquidity"
    )
    state = counters.select(
        "pair_id", F.col("cumulative_fee_volume").alias("stored"), F.col("updated_at").alias("stored_at")
    )
    return rows.join(state, "pair_id", "left")


def _in_order() -> F.Column:
    return F.col("stored_at").isNull() | (F.col("created_at") > F.col("stored_at"))


def _fact(fees: Column) -> list[Column | str]:
    return [
        "created_at",
        "pair_id",
        "address",
        F.col("current_price").cast("float").alias("price"),
        F.col("liquidity").cast("float").alias("liquidity"),
        fees.cast("float").alias("fees"),
        "counter",
    ]


def deltas_in_order(rows: DataFrame) -> DataFrame:
    """``fee_deltas`` of rows that ``with_state`` has placed."""
    w = Window.partitionBy("pair_id").orderBy("created_at")
    prev = F.coalesce(F.lag("counter").over(w), F.col("stored"), F.col("counter"))
    return rows.filter(_in_order()).select(*_fact(F.col("counter") - prev))


def fee_deltas(staged: DataFrame, counters: DataFrame) -> DataFrame:
    """History rows with per-snapshot fees from the cumulative counter.

    fees = counter - previous counter of the same pair, both as 32-bit FLOAT
    (C10).  The previous counter is the pair's previous snapshot in this batch,
    else the stored last counter (which survives gaps), else the counter
    itself (first sight gives 0).  A counter reset gives negative fees.
    Rows not newer than the pair's stored counter are late and left to
    ``late_entries``.
    """
    return deltas_in_order(with_state(staged, counters))


def late_rows(rows: DataFrame) -> DataFrame:
    """``late_entries`` of rows that ``with_state`` has placed."""
    return rows.filter(~_in_order()).select(*_fact(F.lit(None)))


def late_entries(staged: DataFrame, counters: DataFrame) -> DataFrame:
    """Staged rows at or before their pair's stored counter (a snapshot that
    arrives after a newer one was loaded), or replays of stored ones."""
    return late_rows(with_state(staged, counters))


def neighbours(late: DataFrame, stored: DataFrame) -> DataFrame:
    """Late rows among the stored rows of their pairs: as history rows with
    ``is_late``, and ``after_late`` for the row right behind a late one.

    ``stored`` are the fact rows from the oldest late date on.  Late rows whose
    snapshot and pair are stored are replays and left out.  Fees are taken from
    the row before; where a late row has none, they are NULL (``first_fees``).
    A window holds one pair's rows of those dates."""
    own = stored.join(late.select("pair_id").distinct(), "pair_id", "left_semi")
    fresh = late.join(own.select("pair_id", "created_at"), ["pair_id", "created_at"], "left_anti")
    columns = ["created_at", "pair_id", "price", "liquidity", "fees", "counter"]
    both = own.select(*columns, F.lit(False).alias("is_late")).unionByName(fresh.select(*columns, F.lit(True).alias("is_late")))
    w = Window.partitionBy("pair_id").orderBy("created_at")
    placed = both.withColumn("before", F.lag("counter").over(w)).withColumn("after_late", F.coalesce(F.lag("is_late").over(w), F.lit(False)))
    changed = placed.filter(F.col("is_late") | F.col("after_late"))
    # A stored row whose counter was not kept has nothing to difference.
    fees = F.when(F.col("counter").isNull(), F.col("fees")).otherwise(F.col("counter") - F.col("before"))
    first = F.col("is_late") & F.col("before").isNull()
    return changed.select("created_at", "pair_id", "price", "liquidity", fees.alias("fees"), "counter", "is_late", first.alias("first"))


def first_fees(changed: DataFrame, older: DataFrame) -> DataFrame:
    """Fees of the changed rows that have no row before them among ``neighbours``:
    taken from the pair's newest row in ``older``, else a first sight."""
    last = older.join(changed.filter("first").select("pair_id").distinct(), "pair_id", "left_semi")
    last = last.groupBy("pair_id").agg(F.max_by("counter", "created_at").alias("last"))
    fees = F.when(F.col("first"), F.col("counter") - F.coalesce("last", "counter")).otherwise(F.col("fees"))
    return changed.join(last, "pair_id", "left").withColumn("fees", fees).drop("last")


def newest_counters(rows: DataFrame) -> DataFrame:
    """Each pair's newest counter of rows (``pair_id``, ``created_at``, ``counter``):
    what a batch changes in the counter state."""
    return rows.groupBy("pair_id").agg(
        F.max_by("counter", "created_at").alias("cumulative_fee_volume"), F.max("created_at").alias("updated_at")
    )


def counter_upsert(staged: DataFrame, counters: DataFrame) -> DataFrame:
    """New last-counter state (S10, J7): the batch's newest counter per pair,
    else the stored one; late rows never move the state back."""
    latest = newest_counters(with_state(staged, counters).filter(_in_order())).select(
        "pair_id", F.col("cumulative_fee_volume").alias("new_counter"), F.col("updated_at").alias("new_at")
    )
    merged = counters.join(latest, "pair_id", "full_outer")
    return merged.select(
        "pair_id",
        F.coalesce(F.col("new_counter"), F.col("cumulative_fee_volume")).alias("cumulative_fee_volume"),
        F.coalesce(F.col("new_at"), F.col("updated_at")).alias("updated_at"),
    ).filter(F.col("cumulative_fee_volume").isNotNull())

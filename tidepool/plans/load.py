"""Snapshot load (Q11): stage -> tokens -> pairs -> history -> counters.

The batch's feed is written first (``raw``, before the activity cut-off) and
everything else is computed from that copy.  The order is the reference's:
dimensions before the fact (the fact needs the pair ids), the fact before the
state (the fact reads the *old* counter).  Entries that cannot be loaded go to
``rejected``.  Each step writes its own ``batch_id`` folder, so a replayed batch
rewrites exactly what it wrote before.  Reading back the written feed and stage
cuts the lineage: a lost executor later in the load recomputes from those copies,
not from the source.

Rows of a snapshot older than a pair's stored counter (late arrivals) are merged:
each is differenced against its pair's row before it, the row behind it against
it, and the dates touched are written anew by this batch (``rewrites`` names them;
other dates stay as they are).  A quiet batch only probes for late rows; one that
has some reads the history from the day before the oldest of them on.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.ingest import (
    REASONS,
    activity_cutoff,
    deltas_in_order,
    first_fees,
    late_rows,
    neighbours,
    new_pairs,
    new_tokens,
    newest_counters,
    reject_reason,
    rejected_entries,
    stage_snapshot,
    with_state,
)
from tidepool.plans.views import refresh_views
from tidepool.schema import STORED_HISTORY
from tidepool.session import checkpoint_dir
from tidepool.sources.tables import Tables

_REPAIR = "created_at timestamp_ntz, pair_id long, price float, liquidity float, fees float, counter float, is_late boolean"


def _date(d: dt.date) -> Column:
    return F.lit(d.isoformat()).cast("date")


def _merged(spark: SparkSession, late: DataFrame, oldest: dt.date, tables: Tables, batch_id: int) -> tuple[DataFrame | None, list[dt.date]]:
    """The dates that late rows touch, whole and with all fees right again; None if
    all late rows are replays.  The changed rows are kept as ``repairs``."""
    stored = tables.facts(spark, before=batch_id)
    since = oldest - dt.timedelta(days=1)
    checkpoint_dir(spark)
    changed = neighbours(late, stored.filter(F.col("snapshot_date") >= _date(since))).checkpoint()
    if not changed.filter("first").isEmpty():
        # No row of the pair in those days: only then older dates are read.
        changed = first_fees(changed, stored.filter(F.col("snapshot_date") < _date(since)))
    tables.write(changed.select("created_at", "pair_id", "price", "liquidity", "fees", "counter", "is_late"), "repairs", batch_id)
    repairs = spark.read.schema(_REPAIR).parquet(tables.batch_path("repairs", batch_id)).withColumn("snapshot_date", F.to_date("created_at"))
    dates = sorted(r["snapshot_date"] for r in repairs.select("snapshot_date").distinct().collect())
    if not dates:
        return None, []
    columns = STORED_HISTORY.fieldNames()
    whole = stored.filter(F.col("snapshot_date").isin([_date(d) for d in dates])).select(columns)
    kept = whole.join(repairs.select("pair_id", "created_at"), ["pair_id", "created_at"], "left_anti")
    return kept.unionByName(repairs.select(columns)), dates


#: Rows of a file of a compacted date, about.
ROWS_A_FILE = 4_000_000


def _over(staged: DataFrame, tables: Tables, batch_id: int, anew: list[dt.date]) -> tuple[list[dt.date], int]:
    """The newest stored date if this batch begins a later one (and does not write it
    anew for late rows), and the number of files that its rows make."""
    spark = staged.sparkSession
    stored = tables.snapshots(spark, before=batch_id).groupBy(F.to_date("created_at").alias("d")).agg(F.sum("rows").alias("n"))
    last = stored.orderBy(F.desc("d")).first()
    newest = staged.agg(F.max(F.to_date("created_at"))).first()[0]
    if last is None or newest is None or newest <= last["d"] or last["d"] in anew:
        return [], 1
    return [last["d"]], 1 + int(last["n"]) // ROWS_A_FILE


def load_snapshot(
    spark: SparkSession,
    raw: DataFrame,
    tables: Tables,
    batch_id: int,
    cutoff: bool = True,
    report: bool = False,
    created_at: dt.datetime | str | None = None,
    compact: bool = False,
) -> dict[str, int] | None:
    """Load a batch of raw entries (one or more snapshots) into ``tables``.

    ``raw`` has the flattened entry schema; ``page`` is needed for the cut-off.
    Entries without ``created_at`` (one poll) are stamped with the argument, or as
    those that lack the column with the load's own time.  With ``report`` it returns
    where the batch's rows went (``accounting``), counted while they are written.
    With ``compact``, the first batch of a new date writes the date before it anew:
    in files of disjoint pair ranges, instead of a folder a batch.
    """
    if "created_at" not in raw.columns:
        now = F.localtimestamp() if created_at is None else F.lit(str(created_at)).cast("timestamp_ntz")
        raw = raw.withColumn("created_at", now)
    elif created_at is not None:
        raw = raw.withColumn("created_at", F.coalesce("created_at", F.lit(str(created_at)).cast("timestamp_ntz")))
    tables.check_replay(spark, batch_id)
    tables.claim(spark, batch_id)
    watch = _Watch(report)
    # The uncut feed of this batch is written once (an archive, and the point the
    # rest of the load recomputes from); everything below reads the copy.
    reason = reject_reason(raw, cutoff, mints=False)
    reasons = [F.count(F.when(reason == r, F.lit(1))).alias(f"rejected_{r}") for r in REASONS if r != "mint"]
    tables.write(watch(raw, "feed", F.count(F.lit(1)).alias("rows_in"), *reasons), "raw", batch_id)
    raw = tables.batch(spark, "raw", raw.schema, batch_id)
    # Entries that cannot be loaded are kept aside with the reason, not lost.
    tables.write_if_any(rejected_entries(raw, cutoff), "rejected", batch_id)
    kept = activity_cutoff(raw) if cutoff else raw
    valid = F.count(F.when(reject_reason(kept, cutoff, mints=False).isNull(), F.lit(1)))
    staging = stage_snapshot(watch(kept, "cut", valid.alias("valid")))
    tables.write(watch(staging, "staging", F.count(F.lit(1)).alias("staged")), "staged", batch_id)
    staged = tables.batch(spark, "staged", staging.schema, batch_id)

    tokens_before = tables.tokens(spark, before=batch_id)
    tables.write(new_tokens(staged, tokens_before), "tokens", batch_id)
    tokens_now = tables.tokens(spark, before=batch_id + 1)

    pairs_before = tables.pairs(spark, before=batch_id)
    tables.write(new_pairs(staged, tokens_now, pairs_before), "pairs", batch_id)
    # Only entries whose pair exists are loaded (both mints resolved).
    known = tables.pairs(spark, before=batch_id + 1).select(F.col("id").alias("pair_id"))

    counters_before = tables.counters(spark, before=batch_id)
    placed = with_state(staged, counters_before).join(known, "pair_id", "left_semi")
    columns = STORED_HISTORY.fieldNames()
    hist = deltas_in_order(placed).withColumn("snapshot_date", F.to_date("created_at")).select(columns)
    late = late_rows(placed)
    behind = late.agg(F.min("created_at").alias("oldest"), F.count(F.lit(1)).alias("rows")).first()
    rows, dates = None, []
    if behind["oldest"] is None:
        tables.clear(hist.select("created_at", "pair_id", "price", "liquidity", "fees", "counter", F.lit(True).alias("is_late")), "repairs", batch_id)
    else:
        rows, dates = _merged(spark, late, behind["oldest"].date(), tables, batch_id)
    # Sorted by pair inside each file: parquet min/max statistics on pair_id
    # then let a single-pair read skip most row groups.
    hist = watch(hist, "history", F.count(F.lit(1)).alias("loaded"))
    facts = (hist if rows is None else hist.unionByName(rows)).sortWithinPartitions("snapshot_date", "pair_id")
    if compact:
        over, files = _over(staged, tables, batch_id, dates)
        if over:
            whole = tables.facts(spark, before=batch_id).filter(F.col("snapshot_date").isin([_date(d) for d in over])).select(columns)
            facts = facts.unionByName(whole.repartitionByRange(files, "pair_id").sortWithinPartitions("snapshot_date", "pair_id"))
            dates = sorted([*dates, *over])
    tables.write(facts, "history", batch_id, partition_by=("snapshot_date",))
    days = spark.range(0, 1, 1, 1).select(F.explode(F.array(*[_date(d) for d in dates]).cast("array<date>")).alias("snapshot_date"))
    if dates:
        tables.write(days, "rewrites", batch_id)
    else:
        tables.clear(days, "rewrites", batch_id)
    # The snapshot axis and the state take the rows that this batch has added.
    if not dates:
        hist = tables.batch(spark, "history", STORED_HISTORY, batch_id)
    if rows is None:
        added = hist.select("created_at")
    else:
        inserted = spark.read.schema(_REPAIR).parquet(tables.batch_path("repairs", batch_id)).filter("is_late").select("created_at")
        added = hist.select("created_at").unionByName(watch(inserted, "late", F.count(F.lit(1)).alias("late")))
    tables.write(added.groupBy("created_at").agg(F.count(F.lit(1)).alias("rows")), "snapshots", batch_id)
    # The state covers stored pairs only (an entry without both mints gets no pair).
    tables.write(newest_counters(hist), "counters", batch_id)
    refresh_views(spark)
    return accounting(watch.seen, behind["rows"]) if report else None


class _Watch:
    """Counts of rows that pass through a plan while it is written, if asked for."""

    def __init__(self, on: bool):
        self.on = on
        self.observed: list[Observation] = []

    def __call__(self, df: DataFrame, name: str, *counts: Column) -> DataFrame:
        if not self.on:
            return df
        self.observed.append(Observation(f"{name}-{uuid.uuid4().hex}"))
        return df.observe(self.observed[-1], *counts)

    @property
    def seen(self) -> dict[str, int]:
        return {k: v for o in self.observed for k, v in o.get.items()}


def accounting(seen: dict[str, int], behind: int) -> dict[str, int]:
    """Where each row of a batch went: ``rows_in`` is the sum of all others.

    ``rejected_<reason>``; ``cut`` by the activity cut-off; ``duplicate`` of its
    address and snapshot; ``unpaired`` (no pair for want of a mint); ``loaded``;
    ``late`` (merged behind newer rows); ``replay`` (stored before)."""
    out = {"rows_in": seen["rows_in"], **{k: v for k, v in seen.items() if k.startswith("rejected_")}}
    rejected = sum(v for k, v in out.items() if k.startswith("rejected_"))
    late = seen.get("late", 0)
    return {
        **out,
        "cut": seen["rows_in"] - rejected - seen["valid"],
        "duplicate": seen["valid"] - seen["staged"],
        "unpaired": seen["staged"] - seen["loaded"] - behind,
        "loaded": seen["loaded"],
        "late": late,
        "replay": behind - late,
    }

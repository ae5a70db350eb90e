"""Structured Streaming ingest.

Two forms:

* ``stage_stream``: file source of raw entries, each written once to the staged
  folder.  Replays within the watermark's delay are dropped by a state store of that
  size; entries behind the watermark leave by a side exit and are compared with the
  stored entries of their own dates, so a replay is dropped and a late row is kept,
  however late either comes, and no micro-batch reads the whole sink.
* ``ingest_stream`` (incremental): each micro-batch handed to ``load_snapshot``
  through ``foreachBatch``.  The batch id of an epoch is stored before its load, so
  a replayed epoch rewrites its own folders and no other stream's.  The loader
  merges late rows and drops replays of loaded ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidepool.operators.ingest import flatten_pages
from tidepool.plans.load import load_snapshot
from tidepool.plans.refresh import BLOCK_SECONDS, append_history, current_summaries, seal_blocks
from tidepool.schema import HISTORY, RAW_PAGE, RAW_SNAPSHOT, read_schema
from tidepool.sources.tables import Tables, read_or_none

# Identity of one raw entry: a replayed page repeats all of these.  Entries that
# lack one of them cannot be told apart, so all of them stay.
ENTRY_KEY = ("created_at", "page", "address", "cumulative_fee_volume")


#: Epochs between two foldings of the small tables.
FOLD_EVERY = 60


def _once(batch: DataFrame) -> DataFrame:
    """The entries of a batch without replays.  A row without a whole key has a
    number of its own as part of it."""
    numbered = batch.withColumn("own", F.when(_whole(), F.lit(-1)).otherwise(F.monotonically_increasing_id()))
    return numbered.dropDuplicates([*ENTRY_KEY, "own"]).drop("own")


def read_entries(
    spark: SparkSession,
    source_dir: str,
    fmt: str = "parquet",
    pages: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming DataFrame of flattened raw entries from a folder of files.

    ``pages=True`` reads page documents (``{created_at, page, pairs: [...]}``),
    otherwise files already hold one entry per row.
    """
    reader = spark.readStream.format(fmt).schema(read_schema(RAW_PAGE if pages else RAW_SNAPSHOT, fmt))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.load(source_dir)
    return flatten_pages(df) if pages else df


def _trigger(writer, trigger: str):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


#: Fixed value: Spark's state store on local disk, whose memory does not grow with the keys.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _whole() -> Column:
    whole = F.lit(True)
    for c in ENTRY_KEY:
        whole = whole & F.col(c).isNotNull()
    return whole


def _without(rows: DataFrame, stored: DataFrame) -> DataFrame:
    same = [F.col(f"n.{c}") == F.col(f"s.{c}") for c in ENTRY_KEY]
    return rows.alias("n").join(stored.select(*ENTRY_KEY).alias("s"), same, "left_anti")


def stage_stream(
    spark: SparkSession,
    source_dir: str,
    sink_dir: str,
    checkpoint: str,
    fmt: str = "parquet",
    pages: bool = False,
    max_files_per_trigger: int | None = None,
    trigger: str = "availableNow",
    delay: str = "1 day",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start the staging stream.

    ``delay`` bounds the state: keys of entries that are at most that much older than
    the newest one.  ``state_partitions`` (fixed when the checkpoint is new) defaults
    to the session's shuffle partitions.  The sink is laid out by ``entry_date``,
    ``owner`` (the stream) and ``epoch``; a repeated epoch replaces its own rows.
    """
    # The state store is a setting of a session: one of the stream's own.
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    own.conf.set("spark.sql.session.timeZone", "UTC")
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions or spark.conf.get("spark.sql.shuffle.partitions")))
    entries = read_entries(own, source_dir, fmt, pages, max_files_per_trigger)
    columns = entries.columns
    timed = entries.withColumn("event_time", F.col("created_at").cast("timestamp")).withWatermark("event_time", delay)
    fresh = timed.filter(_whole()).dropDuplicatesWithinWatermark(list(ENTRY_KEY))
    both = fresh.withColumn("fresh", F.lit(True)).unionByName(timed.withColumn("fresh", F.lit(False))).drop("event_time")
    kept_schema = T.StructType(
        [*entries.schema.fields, T.StructField("entry_date", T.DateType()), T.StructField("owner", T.StringType()), T.StructField("epoch", T.LongType())]
    )

    def stage(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        owner = session.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        # The newest entry before this epoch, and so the watermark: what the stateful
        # operator leaves out as late is at or behind it.
        marks = f"{checkpoint}/marks"
        last = read_or_none(session, f"{marks}/epoch={epoch_id - 1}") if epoch_id else None
        newest = None if last is None else last.first()["newest"]
        behind = F.lit(False)
        if newest is not None:
            behind = F.col("created_at") <= F.lit(newest.isoformat(sep=" ")).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}")
        # Without a whole key entries cannot be told apart: all of them stay.
        rows = batch.filter(F.col("fresh") | ~_whole() | behind).persist()
        try:
            late = rows.filter(~F.col("fresh") & _whole()).drop("fresh")
            seen = rows.agg(
                F.max(F.when(_whole(), F.col("created_at"))).alias("newest"),
                F.min(F.when(_whole(), F.to_date("created_at"))).alias("from"),
                F.max(F.when(_whole(), F.to_date("created_at"))).alias("to"),
                F.count(F.when(~F.col("fresh") & _whole(), F.lit(1))).alias("late"),
            ).first()
            out = rows.filter("fresh").drop("fresh")
            stored = read_or_none(session, sink_dir, kept_schema)
            if stored is not None and seen["from"] is not None:
                near = stored.filter(F.col("entry_date").between(F.lit(seen["from"]), F.lit(seen["to"])))
                # Another stream's entries are unknown to this one's state.
                out = _without(out, near.filter(F.col("owner") != owner))
                late = _without(late, near.filter(~((F.col("owner") == owner) & (F.col("epoch") == epoch_id))))
            if seen["late"]:
                out = out.unionByName(_without(late.dropDuplicates(list(ENTRY_KEY)), rows.filter("fresh")))
            out = out.unionByName(rows.filter(~F.col("fresh") & ~_whole()).drop("fresh"))
            out = out.select(*columns, F.to_date("created_at").alias("entry_date"), F.lit(owner).alias("owner"), F.lit(epoch_id).cast("long").alias("epoch"))
            out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("entry_date", "owner", "epoch").parquet(sink_dir)
            newest = max((x for x in (newest, seen["newest"]) if x is not None), default=None)
            session.createDataFrame([(newest,)], "newest timestamp_ntz").coalesce(1).write.mode("overwrite").parquet(f"{marks}/epoch={epoch_id}")
        finally:
            rows.unpersist()

    writer = both.writeStream.foreachBatch(stage).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def _refresh(spark: SparkSession, tables: Tables, batch_id: int, block_seconds: int, keep: int) -> None:
    seal_blocks(spark, tables, batch_id, block_seconds)
    tables.write(current_summaries(spark, tables, batch_id + 1, block_seconds), "summaries", batch_id)
    tables.retain_versions(spark, "summaries", keep=keep)


def history_stream(
    spark: SparkSession,
    source_dir: str,
    tables: Tables,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    trigger: str = "availableNow",
    block_seconds: int = BLOCK_SECONDS,
    refresh_every: int = 1,
    keep_versions: int = 3,
) -> StreamingQuery:
    """Snapshots whose fees were taken upstream (files of ``HISTORY`` rows), kept and
    summarised as they come: blocks are sealed at every epoch, the all-timeframe
    summary is refreshed at every ``refresh_every``-th (T4)."""
    reader = spark.readStream.schema(HISTORY)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))

    def keep(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        owner = session.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        batch_id = tables.batch_of(session, owner, int(epoch_id))
        append_history(session, batch, tables, batch_id)
        if epoch_id % refresh_every:
            seal_blocks(session, tables, batch_id, block_seconds)
        else:
            _refresh(session, tables, batch_id, block_seconds, keep_versions)

    writer = reader.parquet(source_dir).writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def ingest_stream(
    spark: SparkSession,
    source_dir: str,
    tables: Tables,
    checkpoint: str,
    fmt: str = "parquet",
    pages: bool = False,
    max_files_per_trigger: int | None = None,
    trigger: str = "availableNow",
    refresh_summaries: bool = False,
    keep_counter_versions: int = 3,
    block_seconds: int = BLOCK_SECONDS,
) -> StreamingQuery:
    """Start the incremental loader (T1-T4): ``load_snapshot`` per micro-batch.

    With ``refresh_summaries`` closed blocks of ``block_seconds`` are sealed and the
    all-timeframe summary is merged from them and the open block after each load
    (``plans.refresh``) and written as a new version (``Tables.summaries`` reads the
    newest), so readers never see a half-written table (T4).  Dates that are over are
    compacted; the small tables are folded every ``FOLD_EVERY`` epochs, all but the
    newest ``keep_counter_versions`` batches of them.
    """
    entries = read_entries(spark, source_dir, fmt, pages, max_files_per_trigger)

    def load(batch: DataFrame, epoch_id: int) -> None:
        # No watermark: a late row reaches the loader, which merges it.
        owner = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        batch_id = tables.batch_of(batch.sparkSession, owner, int(epoch_id))
        batch = _once(batch)
        load_snapshot(batch.sparkSession, batch, tables, batch_id, compact=True)
        tables.fold(batch.sparkSession, keep=keep_counter_versions, slack=FOLD_EVERY)
        if refresh_summaries:
            _refresh(batch.sparkSession, tables, batch_id, block_seconds, keep_counter_versions)

    writer = entries.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()

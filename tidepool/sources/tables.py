"""Stored tables under one root folder.

Layout (parquet), one folder a batch and table:

* ``raw/batch_id=N``       the batch's feed entries (before the activity cut-off)
* ``rejected/batch_id=N``  feed entries that cannot be loaded, with the reason
* ``epochs/batch_id=N``    which stream and epoch loaded batch N
* ``staged/batch_id=N``    raw entries of batch N after staging
* ``tokens/batch_id=N``    tokens first seen in batch N
* ``pairs/batch_id=N``     pairs first seen in batch N
* ``history/batch_id=N/snapshot_date=D``   fact rows
* ``repairs/batch_id=N``   late rows that batch N inserted, and the stored rows
  behind them whose fees it took anew
* ``rewrites/batch_id=N``  dates that batch N holds whole: rows of earlier batches
  at these dates no longer count
* ``counters/batch_id=N``  last counters of the pairs that batch N has rows of
* ``<name>_base/batch_id=N`` for the counters and other small tables: their batches
  up to N in one (``fold``)
* ``moments/batch_id=N``   a row of moments a pair and block of time that batch N
  sealed, ``sealed/batch_id=N`` these blocks; a block's newest seal counts
* ``snapshots/batch_id=N`` one row per snapshot loaded (``created_at``,
  ``rows``): the time axis without scanning the fact table

Every write replaces its own folder, also with nothing, so re-running a batch after
a failure gives the same tables.  A batch is not visible as a whole at once: a reader
beside a running load asks for the batches ``before`` it.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.schema import COUNTERS, HISTORY, MOMENTS, PAIRS, SNAPSHOTS, STORED_HISTORY, SUMMARIES, TOKENS


def read_or_none(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The parquet table at ``path``, or None before its first write.  A declared
    ``schema`` spares the job that reads it from the files."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def _with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])


_EPOCHS = T.StructType([T.StructField("id", T.LongType()), T.StructField("owner", T.StringType()), T.StructField("epoch", T.LongType())])
_SEALED = T.StructType([T.StructField("block", T.LongType())])
_SNAPSHOT = T.StructType([T.StructField("created_at", T.TimestampNTZType())])
_REWRITES = T.StructType([T.StructField("snapshot_date", T.DateType())])

# Small tables that grow by a folder a batch, and their schemas: ``fold`` merges them.
_FOLDED = {"counters": COUNTERS, "snapshots": SNAPSHOTS, "tokens": TOKENS, "pairs": PAIRS, "epochs": _EPOCHS}


def _newest_version(df: DataFrame) -> DataFrame:
    """Rows of the newest ``batch_id`` of a table written whole per batch.  The
    scalar subquery runs once and prunes the other partitions at run time."""
    return df.filter(F.col("batch_id") == df.agg(F.max("batch_id")).scalar())


@dataclass(frozen=True)
class Tables:
    root: str

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    # -- batches ---------------------------------------------------------
    def batch_path(self, name: str, batch_id: int) -> str:
        return f"{self.path(name)}/batch_id={batch_id}"

    def batch(self, spark: SparkSession, name: str, schema: T.StructType, batch_id: int) -> DataFrame:
        """What batch ``batch_id`` wrote to a table, under its declared schema, read
        from its own folder."""
        return spark.read.schema(schema).parquet(self.batch_path(name, batch_id))

    def last_loaded(self, spark: SparkSession) -> int:
        """The newest batch that has brought snapshots, 0 before the first."""
        newest = self._read(spark, "snapshots", SNAPSHOTS, None).agg(F.max("batch_id")).first()[0]
        return 0 if newest is None else int(newest)

    def check_replay(self, spark: SparkSession, batch_id: int) -> None:
        """Refuse a batch whose state before it is gone (``fold`` has merged it with
        later batches): its fees would come out as first sights."""
        # Stores without counters fold their snapshots alone; both have the same base.
        for name in ("snapshots_base",) if read_or_none(spark, self.path("counters_base"), COUNTERS) is None else ("counters_base",):
            bases = read_or_none(spark, self.path(name), _with_batch(T.StructType([])))
            first = None if bases is None else bases.agg(F.min("batch_id")).first()[0]
            if first is not None and batch_id <= first:
                raise ValueError(f"batch {batch_id} cannot be loaded again: the counter state before it has been removed")

    def batch_of(self, spark: SparkSession, owner: str, epoch: int) -> int:
        """The batch id of a stream's epoch: the stored one if the epoch has been
        seen, else the next free one, stored before the load begins.  So a new
        checkpoint, a second stream or a batch load never reuses an id."""
        own = (F.col("owner") == owner) & (F.col("epoch") == epoch)
        top = self._read(spark, "epochs", _EPOCHS, None).agg(F.max(F.when(own, F.col("id"))).alias("known"), F.max("id").alias("newest")).first()
        if top["known"] is not None:
            return int(top["known"])
        batch_id = int(top["newest"] or 0) + 1
        self.claim(spark, batch_id, owner, epoch)
        return batch_id

    def claim(self, spark: SparkSession, batch_id: int, owner: str = "", epoch: int | None = None) -> None:
        """Note that ``batch_id`` is taken, before anything of it is stored; a batch
        that is taken already stays its owner's."""
        if read_or_none(spark, self.batch_path("epochs", batch_id), _EPOCHS) is None:
            row = [F.lit(batch_id).cast("long").alias("id"), F.lit(owner).alias("owner"), F.lit(epoch).cast("long").alias("epoch")]
            self.write(spark.range(0, 1, 1, 1).select(*row), "epochs", batch_id)

    # -- readers ---------------------------------------------------------
    def _read(self, spark: SparkSession, name: str, schema: T.StructType, before: int | None) -> DataFrame:
        """Rows of the batches below ``before``: the newest base (``fold``) and the
        batches behind it.  Batches inside a base cannot be told apart any more."""
        df = read_or_none(spark, self.path(name), _with_batch(schema))
        bases = read_or_none(spark, self.path(f"{name}_base"), _with_batch(schema)) if name in _FOLDED else None
        if df is None:
            df = spark.createDataFrame([], _with_batch(schema))
        if before is not None:
            df = df.filter(F.col("batch_id") < F.lit(before))
            bases = None if bases is None else bases.filter(F.col("batch_id") < F.lit(before))
        if bases is None:
            return df
        newest = bases.agg(F.coalesce(F.max("batch_id"), F.lit(-1).cast("long"))).scalar()
        return bases.filter(F.col("batch_id") == newest).unionByName(df.filter(F.col("batch_id") > newest))

    def tokens(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        return self._read(spark, "tokens", TOKENS, before).select(*TOKENS.fieldNames())

    def pairs(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        return self._read(spark, "pairs", PAIRS, before).select(*PAIRS.fieldNames())

    def facts(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """Fact rows as stored, with ``counter``, ``snapshot_date`` and ``batch_id``,
        less those that a later batch holds anew."""
        df = self._read(spark, "history", STORED_HISTORY, before)
        anew = read_or_none(spark, self.path("rewrites"), _with_batch(_REWRITES))
        if anew is None:
            return df
        if before is not None:
            anew = anew.filter(F.col("batch_id") < F.lit(before))
        # One row a date that was ever written anew.
        since = F.broadcast(anew.groupBy("snapshot_date").agg(F.max("batch_id").alias("since")))
        kept = df.join(since, "snapshot_date", "left").filter(F.col("since").isNull() | (F.col("batch_id") >= F.col("since")))
        return kept.select(df.columns)

    def history(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """Fact rows; ``snapshot_date`` is kept so date filters prune folders."""
        return self.facts(spark, before).select(*HISTORY.fieldNames(), "snapshot_date")

    def counters(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """Latest counter state written before batch ``before``: the changes of all
        batches merged by pair."""
        both = self._read(spark, "counters", COUNTERS, before).groupBy("pair_id")
        state = both.agg(F.max_by("cumulative_fee_volume", "updated_at").alias("cumulative_fee_volume"), F.max("updated_at").alias("updated_at"))
        return state.select(*COUNTERS.fieldNames())

    def summaries(self, spark: SparkSession) -> DataFrame:
        """The newest all-timeframe summary written by the stream loader."""
        df = read_or_none(spark, self.path("summaries"))
        if df is None:  # nothing eligible yet (fewer snapshots than any timeframe)
            return spark.createDataFrame([], SUMMARIES)
        return _newest_version(df).drop("batch_id")

    def snapshots(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        return self._read(spark, "snapshots", SNAPSHOTS, before).select("created_at", "rows")

    def moments(self, spark: SparkSession, before: int, batches: list[int]) -> DataFrame:
        """Sealed moments with the ``batch_id`` that sealed them, of some batches."""
        df = spark.read.schema(_with_batch(MOMENTS)).parquet(self.path("moments"))
        return df.filter((F.col("batch_id") < before) & F.col("batch_id").isin(batches))

    def sealed(self, spark: SparkSession, before: int) -> DataFrame | None:
        """``(block, batch_id)``: which blocks of time were sealed by which batch."""
        df = read_or_none(spark, self.path("sealed"), _with_batch(_SEALED))
        return None if df is None else df.filter(F.col("batch_id") < before)

    def repaired(self, spark: SparkSession, batch_id: int) -> list:
        """Snapshots at which a batch inserted late rows or took fees anew."""
        df = read_or_none(spark, self.batch_path("repairs", batch_id), _SNAPSHOT)
        return [] if df is None else [r["created_at"] for r in df.select("created_at").distinct().collect()]

    def staged(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        path = self.path("staged")
        df = spark.read.parquet(path)
        if before is not None:
            df = df.filter(F.col("batch_id") < F.lit(before))
        return df

    # -- retention -------------------------------------------------------
    def _folders(self, spark: SparkSession, name: str) -> list[tuple[int, object]]:
        """Batch ids and folders of a table, oldest first.  Only names are listed
        (through the Hadoop FileSystem API, which PySpark does not wrap)."""
        jvm = spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path(name))
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        found = []
        for st in fs.listStatus(root):
            nm = st.getPath().getName()
            if st.isDirectory() and nm.startswith("batch_id="):
                found.append((int(nm.split("=", 1)[1]), (fs, st.getPath())))
        return sorted(found, key=lambda f: f[0])

    def retain_versions(self, spark: SparkSession, name: str = "counters", keep: int = 3) -> list[int]:
        """Delete all but the newest ``keep`` batch versions of a table that is written
        whole per batch; of ``counters``, the changes before them, once they are
        folded into a base.  Returns the batch ids removed."""
        if name == "counters":
            return self.fold(spark, keep, names=("counters",))
        removed = self._folders(spark, name)[:-keep]
        for _, (fs, path) in removed:
            fs.delete(path, True)
        return [b for b, _ in removed]

    def fold(self, spark: SparkSession, keep: int = 3, slack: int = 0, names: tuple[str, ...] = tuple(_FOLDED)) -> list[int]:
        """Merge all but the newest ``keep`` batches of the small tables into a base
        each (``<name>_base``, written before their folders go), once there are more than
        ``slack`` of them; and drop history folders that a batch among them has replaced.
        So a batch's cost follows the batch, whatever their number, and the counter state is
        written whole once in ``slack`` batches.  The kept batches can be loaded again."""
        removed = self._folders(spark, names[0])[:-keep]
        if len(removed) <= slack:
            return []
        newest = removed[-1][0]
        for name in names:
            state = self.counters(spark, before=newest + 1) if name == "counters" else self._read(spark, name, _FOLDED[name], newest + 1).drop("batch_id")
            self.write(state, f"{name}_base", newest)
            gone = [f for f in self._folders(spark, name) if f[0] <= newest] + [f for f in self._folders(spark, f"{name}_base") if f[0] < newest]
            for _, (fs, path) in gone:
                fs.delete(path, True)
        self._drop_replaced(spark, newest)
        return [b for b, _ in removed]

    def _drop_replaced(self, spark: SparkSession, upto: int) -> None:
        anew = read_or_none(spark, self.path("rewrites"), _with_batch(_REWRITES))
        if anew is None:
            return
        # One row a date written anew.
        since = {r["snapshot_date"]: r["since"] for r in anew.filter(F.col("batch_id") <= upto).groupBy("snapshot_date").agg(F.max("batch_id").alias("since")).collect()}
        for batch, (fs, path) in self._folders(spark, "history"):
            if batch > upto:
                break
            for date in (st.getPath() for st in fs.listStatus(path)):
                day = date.getName().partition("snapshot_date=")[2]
                if any(str(d) == day and batch < b for d, b in since.items()):
                    fs.delete(date, True)

    # -- writer ----------------------------------------------------------
    def write_if_any(self, df: DataFrame, name: str, batch_id: int) -> bool:
        """Write a side table (``rejected``, ``rewrites``) only when it has rows:
        these are empty in almost every batch, and a write job per micro-batch
        would cost more than the one-row probe.  What an earlier attempt of the
        batch left is replaced in any case."""
        if df.isEmpty():
            self.clear(df, name, batch_id)
            return False
        self.write(df, name, batch_id)
        return True

    def clear(self, like: DataFrame, name: str, batch_id: int) -> None:
        """Empty a batch's folder of a side table, if an earlier attempt wrote one."""
        if read_or_none(like.sparkSession, self.batch_path(name, batch_id), like.schema) is not None:
            self.write(like.limit(0), name, batch_id)

    def write(self, df: DataFrame, name: str, batch_id: int, partition_by: tuple[str, ...] = ()) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(self.batch_path(name, batch_id))

"""Session helpers.

Library functions never create a session; they take DataFrames.  These helpers
are for tests, the bench and command-line use.  On a cluster the checkpoint
directory comes from ``spark.checkpoint.dir`` (a shared folder); a private
temporary folder is only set when nothing is configured, as in local tests.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that matter for these plans: AQE re-plans joins and coalesces the
# small shuffles of per-pair aggregates; the UI server stays off.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app_name: str = "tidepool", **conf) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    for k, v in {**DEFAULT_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _private_folder(master: str) -> str:
    """A folder of this machine, which only a local session can share with its tasks."""
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="tidepool-ckpt-")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; a private one is set only if it is
    unset and the session is local.  On a cluster an unset folder is an error."""
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        return spark.conf.get("spark.checkpoint.dir", None) or _private_folder(spark.conf.get("spark.master", None) or "")
    current = sc.getCheckpointDir()
    if current:
        return current
    sc.setCheckpointDir(sc.getConf().get("spark.checkpoint.dir", None) or _private_folder(sc.master))
    return sc.getCheckpointDir()

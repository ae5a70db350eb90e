"""Shared folder and small helpers of the training-data operators.

Intermediate tables go below ``spark.checkpoint.dir``, which a cluster sets to
a folder that all executors and the driver share.  Only where it is unset, as
in tests, a private temporary folder is set.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.session import checkpoint_dir

#: Words of the operators: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a cut of the lineage
    that survives lost executors."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(col: str = "text"):
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the Python workers, once an application:
    they need not have it installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for folder, _, files in sorted(os.walk(root)):
            for f in sorted(files):
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    path = os.path.join(tempfile.mkdtemp(prefix="tidepool-code-"), "tidepool_code.zip")
    with open(path, "wb") as f:
        f.write(held.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)

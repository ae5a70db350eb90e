"""Batch sources of raw snapshot feeds (S1, U1) and result export."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.ingest import flatten_pages
from tidepool.schema import PAYLOAD, RAW_PAGE, RAW_SNAPSHOT, read_schema


def read_pages(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Page documents ``{created_at, page, pairs: [...]}`` (JSON lines or
    parquet), flattened to one row per entry.  The explicit schema skips
    inference; a folder of many page files is read as one concatenation.  A JSON
    document that does not parse goes on with its text in ``_corrupt_record``."""
    return flatten_pages(spark.read.schema(read_schema(RAW_PAGE, fmt)).format(fmt).load(path))


def read_payload(spark: SparkSession, path: str, created_at: dt.datetime | str | None = None) -> DataFrame:
    """One poll's pages as the feed delivers them, ``{pairs: [...]}`` documents without
    a time or page of their own, flattened to raw entries.

    A page's number is the last number behind ``page`` in its file's path; the snapshot
    is ``created_at`` or, without it, when the file was written (the poll's own time,
    to the minute: its pages are written one after the other).  Both come from Spark's
    ``_metadata`` columns, so files may lie in any folder.

    Page files may be kept many in one, a document a line beside the path of the file
    it was (``file_path``): a poll of very many small pages is then few files to write,
    list and open.  Such a document's page is taken from that path."""
    pages = spark.read.schema(read_schema(PAYLOAD, "json")).option("recursiveFileLookup", "true").json(path)
    number = F.regexp_extract(F.coalesce("file_path", F.col("_metadata.file_path")), r".*page\D{0,3}(\d+)", 1)
    written = F.date_trunc("minute", F.col("_metadata.file_modification_time")).cast("timestamp_ntz")
    stamp = written if created_at is None else F.lit(str(created_at)).cast("timestamp_ntz")
    return flatten_pages(pages.select(stamp.alias("created_at"), number.try_cast("int").alias("page"), *pages.columns))


def read_entries(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Already-flattened raw entries (``RAW_SNAPSHOT`` schema)."""
    return spark.read.schema(read_schema(RAW_SNAPSHOT, fmt)).format(fmt).load(path)


def export(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a result of any size as files."""
    writer = df.write.mode("overwrite")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)

"""The corpus pipeline: quality rules, near-duplicate removal, secret scan, source
mixing, tokens.  Each stage works on all rows its predecessor kept; ``run`` writes
each stage's result to the session's shared folder and reads it back, which cuts
the lineage.

1. quality: rejected documents go; ties, repeated rows and null ids are judged row by row.
2. near duplicates: documents are linked at a similarity of 0.8 or more (five-word
   shingles); one of each component stays, the one of smallest id; rows equal in id and
   text stay once, other texts under one id and rows with a null id stay.
3. secrets: spans found are replaced by a mark, and ``n_chars`` is that of the new text.
4. mixing: every document stays at least once; sources below their weight are
   repeated by whole and part passes, at most ``REPEAT`` times the least repeated one.
5. BPE: a row for each document and pass, with its tokens.

Empty tables go through all stages as empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import bpe, mixing, near_dup, quality, secret_scan
from tidepool.llm.common import scratch, ship, stored, table
from tidepool.llm.queries import tokenizer_file

REPEAT = 1.5
#: Least similarity, in percent, of near duplicates here (op7's contract has 85).
SIMILAR = 80

#: Neither sketches, hashes nor tokens are SQL's: the run is tested against a
#: brute-force version in tests/llm (test_pipeline_equals_brute_force).
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return quality.accepted(docs, quality.trusted_ids(table(spark, sf_dir, "labels")))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    gone = near_dup.near_duplicates(docs, percent=SIMILAR).filter("not kept").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    # Rows equal in id and text are copies of one document; other texts under an id stay.
    named = left.filter("doc_id is not null")
    if not _repeats(named):
        return left
    return named.dropDuplicates(["doc_id", "text"]).unionByName(left.filter("doc_id is null"))


def _repeats(docs: DataFrame) -> bool:
    """Whether any id and text stand in several rows."""
    return not docs.groupBy("doc_id", F.xxhash64("text")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    out = secret_scan.redacted(docs, scratch(spark, "ledger"))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else out


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return mixing.mixed(docs, entropy=None, repeat_limit=REPEAT)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    out = bpe.encoded(docs, tokenizer_file("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_dup_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"{base}/{k}-{name}")
    return docs

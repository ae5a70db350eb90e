"""Secret scans over an incremental blob ledger (operator 8), with DataFrame
functions only.

A text version is a blob, named by the SHA-256 of its bytes.  The ledger, a
Parquet table in shared storage, has one row for each (blob, rule version) ever
scanned, with its findings.  A scan reads the paths' blobs, takes those that the
ledger has not seen under the present rule version, scans each of them once
whatever number of paths or versions hold it, appends them to the ledger, and
joins the findings back to all paths.  Running it again, or over an overlapping
set of paths, scans only what is new; a new rule version scans all blobs anew.

A finding is (start, end, kind), in code points, end exclusive.  Base kinds are
``assign`` (a credential assigned to a name), ``access`` (access key ids) and
``hex`` (long hex runs); ``pem`` (private key blocks) and ``jwt`` (signed web
tokens) are added.  A key block runs from its BEGIN line over the base64 text to
its END line; where that is missing, over the base64 lines that follow, the last
of which may be short.  Line ends may be written as ``\\n``.  Spans of one kind
never overlap; kinds may.

Nulls count as empty texts: a blob without findings.  Rows are paths one by one,
so repeated rows and null ids keep theirs; other columns are not read.  Empty
tables give empty results.  A text's places are sums over its matches, so long
texts are scanned whole in one pass a rule.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import text_of

#: Matches of a text whose sizes are added up one by one.
BLOCK = 256
#: Changes whenever ``RULES`` do.
RULE_VERSION = 2
#: A private key block: its BEGIN line, the header lines of an encrypted key, and
#: the text up to its END line, else base64 lines.  The repeated group is
#: possessive, so it needs no stack a line.
_LINE_END = r"[\x20\x09]*(?:\r?\n|\r|(?:\\r)?\\n)[\x20\x09]*"
_GAP = r"(?:[\x20\x09-\x0D]|\\r|\\n)"
PEM = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
    rf"(?:{_GAP}{{0,64}}Proc-Type:\x20?4,ENCRYPTED{_GAP}{{1,64}}DEK-Info:\x20?[A-Za-z0-9-]+,[0-9A-Fa-f]+)?"
    r"(?:[A-Za-z0-9+/=\\\x20\x09-\x0D]*-----END [A-Z ]*PRIVATE KEY-----"
    rf"|(?:{_GAP}{{0,64}}[A-Za-z0-9+/]{{16,}}={{0,2}}(?:(?:{_LINE_END}|[\x20\x09]+)[A-Za-z0-9+/]{{16,}}={{0,2}})*+(?:{_LINE_END}[A-Za-z0-9+/]{{1,15}}={{0,2}})?)?)"
)
#: Kind, pattern, group whose length counts, least length.
RULES = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("pem", PEM, 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
)
BASE = ("assign", "access", "hex")
LEDGER = "blob string, rule_version int, findings array<struct<start:int,kind:int,end:int>>"


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sum(sizes: Column) -> Column:
    return F.aggregate(sizes, F.lit(0), lambda acc, x: acc + x)


def _starts(sizes: Column) -> Column:
    """What stands before each size: sums of whole blocks, then within its block, so
    the work on n sizes is n times a block, not n squared."""

    def within(before: Column) -> Column:
        def place(x: Column, i: Column) -> Column:
            k = F.floor(i / F.lit(BLOCK)).cast("int")
            return F.get(before, k) + _sum(F.slice(sizes, k * BLOCK + 1, i - k * BLOCK))

        return F.transform(sizes, place)

    def before(blocks: Column) -> Column:
        return F.transform(blocks, lambda x, k: _sum(F.slice(blocks, F.lit(1), k)))

    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(sizes) / F.lit(BLOCK)).cast("int")), lambda k: _sum(F.slice(sizes, k * BLOCK + 1, F.lit(BLOCK))))
    return _bound(blocks, lambda b: _bound(before(b), within))


def _found(text: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    """Findings of one rule: the matches, and the gaps between them, give the
    places as running sums.  Texts without a match stop at the first search."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def placed(both: Column) -> Column:
        steps = F.transform(both, lambda x: x["gap"] + F.length(x["text"]))

        def spans(starts: Column) -> Column:
            return F.zip_with(both, starts, lambda x, at: F.struct((at + x["gap"]).alias("start"), F.lit(kind).alias("kind"), (at + x["gap"] + F.length(x["text"])).alias("end"), x["text"].alias("text")))

        return _bound(_bound(steps, _starts), spans)

    pairs = _bound(matches, lambda m: F.zip_with(F.slice(gaps, F.lit(1), F.size(m)), m, lambda g, x: F.struct(F.length(g).alias("gap"), x.alias("text"))))
    long = F.filter(_bound(pairs, placed), lambda x: F.length(F.regexp_extract(x["text"], pattern, group)) >= least)
    return F.when(text.rlike(pattern), F.transform(long, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))))


def findings(text: Column) -> Column:
    """All findings of a text, by start, then kind in the order of ``RULES``."""
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    kinds = [F.coalesce(_found(text, i, p, g, least), none) for i, (_, p, g, least) in enumerate(RULES)]
    return F.sort_array(F.concat(*kinds))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's rows; a folder not yet written has none.  A blob that two
    scans added at the same time counts once."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], LEDGER)


def scan(docs: DataFrame, ledger: str, id_col: str = "doc_id", text_col: str = "text", version: str | None = None) -> DataFrame:
    """``(id_col, blob, findings)`` for every row of ``docs``; what the ledger
    lacks is scanned and added to it.  With a ``version`` the ledger also notes which
    paths held which blob in it (the same version again replaces its notes), for
    ``historical``."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("path"), text_of(text_col).alias("text")).withColumn("blob", F.sha2("text", 256))
    if version is not None:
        texts.select("path", "blob").write.mode("overwrite").parquet(f"{ledger}-paths/version={version}")
    seen = read_ledger(spark, ledger).filter(F.col("rule_version") == RULE_VERSION).select("blob")
    # One path speaks for all copies of a blob; copies meet as hashes only.
    new = texts.groupBy("blob").agg(F.min("path").alias("path")).join(seen, "blob", "left_anti")
    to_scan = texts.alias("t").join(new.alias("n"), (F.col("t.blob") == F.col("n.blob")) & F.col("t.path").eqNullSafe(F.col("n.path")), "left_semi")
    rows = to_scan.select("blob", F.lit(RULE_VERSION).alias("rule_version"), findings(F.col("text")).alias("findings"))
    rows.write.mode("append").parquet(ledger)
    known = read_ledger(spark, ledger).filter((F.col("rule_version") == RULE_VERSION) & (F.size("findings") > 0)).select("blob", "findings").dropDuplicates(["blob"])
    out = texts.select("path", "blob").join(known, "blob", "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return out.select(F.col("path").alias(id_col), "blob", F.coalesce("findings", none).alias("findings"))


def historical(spark: SparkSession, ledger: str) -> DataFrame:
    """``(path, version, blob, findings)``: the findings of every path in every version
    that was scanned under a name, from the present rules; blobs without any are left
    out."""
    paths = spark.read.parquet(f"{ledger}-paths").select("path", F.col("version").cast("string").alias("version"), "blob")
    known = read_ledger(spark, ledger).filter((F.col("rule_version") == RULE_VERSION) & (F.size("findings") > 0))
    return paths.join(known.select("blob", "findings").dropDuplicates(["blob"]), "blob").select("path", "version", "blob", "findings")


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(r[0]) for r in RULES])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")


def redacted(docs: DataFrame, ledger: str, id_col: str = "doc_id", text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """Every row of ``docs`` with its findings' spans replaced by ``mark``
    (overlapping spans by one)."""
    cols = docs.columns
    found = scan(docs, ledger, id_col, text_col).filter(F.size("findings") > 0).select("blob", "findings").dropDuplicates(["blob"])
    rows = docs.select(F.struct("*").alias("row"), F.sha2(text_of(text_col), 256).alias("blob"))
    rows = rows.join(found, "blob", "left").withColumn("text", text_of(f"row.{text_col}"))
    empty = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    cut = F.aggregate(
        "findings",
        empty,
        lambda acc, x: F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"),
            F.when(x["start"] >= acc["at"], F.concat(acc["out"], F.col("text").substr(acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark))).otherwise(acc["out"]).alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.col("text").substr(acc["at"] + 1, F.length("text"))),
    )
    clean = F.when(F.col("findings").isNull(), F.col(f"row.{text_col}")).otherwise(cut)
    return rows.select(*[clean.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in cols])

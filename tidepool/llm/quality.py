"""Quality rules (operator 10), with DataFrame functions only.

Base rules count words, symbols, repeated lines and repeated three-word
windows of each text.  The verdict is a log-likelihood ratio: hashed words and
word pairs are counted in ``BUCKETS`` buckets, once over all documents (the raw
corpus) and once over trusted documents (the target); a document's score is the
mean over its words and pairs of log p(target) - log p(raw), smoothed, and a
document stays if it passes the base rules and its score is at least ``THRESHOLD``.

The raw counts cover every document.  The target may be a bounded sample of the
labelled rows (``max_trusted`` ids, those of the smallest hash): its ids are
broadcast, which that bound allows, so no text is shuffled.  Counts are summed
within each task first; what is shuffled is at most ``BUCKETS`` rows a task, and
the model is one array of ``BUCKETS`` numbers.

Nulls and empty texts hold no words: all counts 0, base rules failed.  Rows are
judged one by one, so repeated rows and null ids keep their rows, and other
columns pass through untouched (``flagged``) or are not read.  Empty tables give
empty results; with no trusted document every
score is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import WORD, text_of

BUCKETS = 1 << 16
#: Lowest mean log-likelihood ratio of a document that stays.
THRESHOLD = -0.07
#: Trusted documents that the target is fitted on at most.
MAX_TRUSTED = 20_000
#: Added to every bucket's count in the target, and to what the raw counts
#: expect there: a bucket that few grams fall in says little either way.
SMOOTHING = 40.0


def word_list(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _bucket(*words: Column) -> Column:
    return F.pmod(F.xxhash64(*words), F.lit(BUCKETS)).cast("int")


def _grams(words: Column) -> Column:
    """Buckets of the words, then of the pairs of neighbours."""
    pairs = F.transform(F.slice(words, 2, F.greatest(F.size(words), F.lit(0))), lambda x, i: _bucket(F.get(words, i), x))
    return F.concat(F.transform(words, lambda x: _bucket(x)), pairs)


def log_ratios(texts: DataFrame) -> DataFrame:
    """One row, ``weights``: log p(target) - log p(raw) of each bucket, from a
    table of ``text`` and ``trusted``."""
    words = texts.select("trusted", word_list(F.col("text")).alias("words"))
    grams = words.select("trusted", F.explode(_grams(F.col("words"))).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.sum(F.col("trusted").cast("long")).alias("t"), F.count(F.lit(1)).alias("r"))
    spark = texts.sparkSession
    both = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
    rows = both.select("bucket", F.coalesce("t", F.lit(0)).alias("t"), F.coalesce("r", F.lit(0)).alias("r"))
    one = rows.agg(F.sort_array(F.collect_list(F.struct("bucket", "t", "r"))).alias("c"), F.try_divide(F.sum("t"), F.sum("r")).alias("scale"))
    scale = F.coalesce("scale", F.lit(0.0))
    return one.select(F.transform("c", lambda c: F.log((c["t"] + SMOOTHING) / (c["r"] * scale + SMOOTHING))).alias("weights"))


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """Ids of documents whose label has ``quality`` 1: all of them, or the
    ``max_trusted`` of smallest hash."""
    ids = labels.filter(f"quality = 1 and {id_col} is not null").select(F.col(id_col)).distinct()
    return ids.orderBy(F.xxhash64(id_col), id_col).limit(max_trusted)


def _measures(words: Column, text: Column) -> dict[str, Column]:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": (F.length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    }


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (the input row), ``words`` and the base counts of each row."""
    out = docs.select(F.struct("*").alias("row"), text_of(text_col).alias("text")).withColumn("words", word_list(F.col("text")))
    w = F.col("words")
    out = out.select("row", "words", *[c.alias(n) for n, c in _measures(w, F.col("text")).items()])
    hashes = F.when(
        F.size(w) >= 3,
        F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))),
    )
    out = out.withColumn("windows", hashes)
    # Most texts repeat no window: only the others are sorted.
    h = F.col("windows")
    repeats = F.size(F.array_distinct(h)) < F.size(h)
    out = out.withColumn("sorted", F.when(repeats, F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col("sorted")
    same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
    places = F.sort_array(F.transform(F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"]))
    out = out.withColumn("places", F.when(s.isNotNull(), places)).drop("windows", "sorted")
    p = F.col("places")
    covered = F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x)
    return out.withColumn("n_repeat_words", F.coalesce(F.when(p.isNotNull(), covered), F.lit(0).cast("long"))).drop("places")


def flagged(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``docs`` as ``row``, with its counts, ``score``,
    ``base_failed`` and ``kept``.  ``trusted`` has the ids of the target's
    documents, at most the bound of ``trusted_ids``: they are broadcast."""
    marks = trusted.select(F.col(id_col).alias("_id"), F.lit(True).alias("_trusted"))
    texts = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("text")).join(F.broadcast(marks), "_id", "left")
    texts = texts.select("text", F.coalesce("_trusted", F.lit(False)).alias("trusted"))
    # The model has a fixed size; it goes into the plan as one constant array.
    model = log_ratios(texts).first()["weights"]
    weights = F.split(F.lit(",".join(f"{x:.4f}" for x in model)), ",").cast("array<double>")
    out = measured(docs, text_col)
    w = F.col("words")
    total = F.aggregate(_grams(w), F.lit(0.0), lambda acc, b: acc + F.get(weights, b))
    grams = 2 * F.size(w) - 1
    out = out.withColumn("score", F.when(F.size(w) > 0, total / grams).otherwise(F.lit(0.0))).drop("words")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= F.lit(threshold)))
    # The results pass through a generator: a filter on them is then not pushed
    # into the projections above, which would repeat their expressions.
    judged = [c for c in out.columns if c != "row"]
    return out.select("row", F.explode_outer(F.array(F.struct(*judged))).alias("v")).select("row", "v.*")


def accepted(docs: DataFrame, trusted: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged."""
    return flagged(docs, trusted, **settings).filter("kept").select("row.*")

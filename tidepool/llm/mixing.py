"""Mixing sources to target weights (operator 9), with DataFrame functions only.

Source shares s of the corpus' tokens become weights proportional to s**a
(temperature mixing).  The exponent a in [0, 1] is bisected: the largest one
whose weights have an entropy of at least ``entropy`` times that of equal
weights, or, given ``repeat_limit``, the smallest one that repeats no source's
tokens more than that many times as often as the least repeated source's.

The weights are realised with a token budget.  A source gets budget * weight
tokens: whole passes over all its documents, then part of one more, taken from
the front of a keyed permutation.  That is made of blocks: documents are dealt
by a keyed hash over about tokens / ``block_tokens`` blocks, blocks stand in
keyed order, and only the block that the budget ends in is cut inside, in keyed
order.  So a source of any size is spread over many blocks and only sums per
(source, block) are put in sequence.

``budget`` None: the least with which every document occurs at least once.
Tokens are words of the text.  Null or empty texts hold none, and always belong
to the last pass.  A null source is a source of its own.  Rows are mixed one by
one, so repeated rows and null ids count each; ties of the keyed order go by id,
then text.  An empty table, or one without tokens, gives every row one pass.
``schedule`` reads no other column; ``mixed`` keeps them all.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import WORD, scratch, stored, text_of

#: Sections that one step of the search cuts the range of exponents in.
SECTIONS, STEPS = 64, 5


def exponent(totals: DataFrame, entropy: float | None, repeat_limit: float | None) -> float:
    """Bisect the exponent over a table of ``(source, tokens)``.  Each step
    measures the borders of ``SECTIONS`` sections in one job, whose result has a
    fixed size, and goes on within the section that holds the target."""
    if (entropy is None) == (repeat_limit is None):
        raise ValueError("give entropy or repeat_limit")
    every = totals.agg(F.sum("tokens")).first()[0]
    if not every:
        return 1.0
    shares = totals.filter("tokens > 0").select((F.col("tokens") / F.lit(every)).alias("share"))
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        width = (high - low) / SECTIONS
        tried = shares.select("share", F.explode(F.array([F.lit(low + width * i) for i in range(SECTIONS + 1)])).alias("a"))
        raised = tried.withColumn("p", F.pow("share", "a"))
        found = raised.groupBy("a").agg(
            F.sum("p").alias("z"),
            F.sum(F.col("p") * F.log("p")).alias("plogp"),
            F.count(F.lit(1)).alias("n"),
            (F.max(F.col("p") / F.col("share")) / F.min(F.col("p") / F.col("share"))).alias("spread"),
        )
        rows = found.orderBy("a").collect()  # SECTIONS + 1 rows
        if entropy is not None:
            good = [log(r["z"]) - r["plogp"] / r["z"] >= entropy * log(r["n"]) - 1e-12 for r in rows]
            at = max([i for i, g in enumerate(good) if g], default=0)  # entropy falls as a grows
            if at == SECTIONS:
                return high
            low, high = rows[at]["a"], rows[at + 1]["a"]
        else:
            good = [r["spread"] <= repeat_limit * (1 + 1e-12) for r in rows]  # the spread falls as a grows
            at = min([i for i, g in enumerate(good) if g], default=SECTIONS)
            if at == 0:
                return low
            low, high = rows[at - 1]["a"], rows[at]["a"]
    return low if entropy is not None else high


def share(tokens: Column, p: Column, z: Column, total: Column, whole: bool) -> Column:
    """Tokens of the budget ``total`` for a source of weight p / z.  With ``whole``
    the budget holds one pass of every source at least, and rounding, which grows
    with the source, does not take a token of it away."""
    dealt = F.floor(total * p / z + 1e-6).cast("long")
    return F.greatest(dealt, tokens) if whole else dealt


def schedule(
    docs: DataFrame,
    entropy: float | None = 0.95,
    repeat_limit: float | None = None,
    budget: int | None = None,
    seed: int = 17,
    block_tokens: int = 1 << 20,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``(id_col, source_col, text_key, n_tokens, weight, block, passes)`` for
    every row of ``docs``: its source's weight, its block in the last pass, and
    how often the mix holds it.  ``text_key`` tells rows of one id apart."""
    spark = docs.sparkSession
    base = scratch(spark, "mixing")
    text = text_of(text_col)
    narrow = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        F.xxhash64(text).alias("text_key"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_tokens"),
    )
    narrow = stored(narrow.withColumn("draw", F.xxhash64(F.lit(seed), F.col("id"), F.col("text_key"))), f"{base}/narrow")

    totals = stored(narrow.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), f"{base}/totals")
    a = exponent(totals, entropy, repeat_limit)
    raised = totals.withColumn("p", F.when(F.col("tokens") > 0, F.pow("tokens", F.lit(a))).otherwise(F.lit(0.0)))
    sums = raised.agg(F.sum("p").alias("z"), F.max(F.when(F.col("p") > 0, F.col("tokens") / F.col("p"))).alias("most")).first()
    z = sums["z"] or 1.0
    # The least budget that gives every source one whole pass, if none is named.
    total = float(budget if budget is not None else (sums["most"] or 0.0) * z)
    tokens, some = F.col("tokens"), F.col("tokens") > 0
    source = raised.select(
        "source",
        "tokens",
        (F.col("p") / F.lit(z)).alias("weight"),
        F.greatest(F.lit(1), F.ceil(tokens / F.lit(block_tokens))).cast("long").alias("blocks"),
        share(tokens, F.col("p"), F.lit(z), F.lit(total), budget is None).alias("share"),
    ).select(
        "source",
        "weight",
        "blocks",
        F.when(some, F.floor(F.col("share") / tokens)).otherwise(F.lit(1)).cast("long").alias("whole"),
        F.when(some, F.col("share") % tokens).otherwise(F.lit(0)).cast("long").alias("rest"),
    )
    source = stored(source, f"{base}/source")

    def on(left: DataFrame, right: DataFrame, *more: str) -> DataFrame:
        """Join on the source, null being one too, and on ``more``."""
        cond = F.col("l.source").eqNullSafe(F.col("r.source"))
        for c in more:
            cond = cond & (F.col(f"l.{c}") == F.col(f"r.{c}"))
        extra = [c for c in right.columns if c not in ("source", *more)]
        return left.alias("l").join(right.alias("r"), cond).select("l.*", *[f"r.{c}" for c in extra])

    dealt = on(narrow, source).withColumn("block", F.expr("pmod(draw, blocks)"))
    per_block = stored(dealt.groupBy("source", "block").agg(F.sum("n_tokens").alias("held")), f"{base}/blocks")
    # Blocks in keyed order, with what stands before each: one row per (source, block).
    order = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed + 1), "source", "block"), "block")
    before = F.coalesce(F.sum("held").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = stored(per_block.withColumn("before", before), f"{base}/cut")
    dealt = on(dealt, cut, "block")
    # Only in the blocks that a budget ends in are documents put in order.
    ends = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("held") > F.col("rest"))
    place = Window.partitionBy("source", "block").orderBy(F.xxhash64(F.lit(seed + 2), F.col("id"), F.col("text_key")), "id", "text_key")
    upto = F.col("before") + F.sum("n_tokens").over(place.rowsBetween(Window.unboundedPreceding, 0))
    inside = dealt.filter(ends).withColumn("extra", (upto <= F.col("rest")).cast("int"))
    others = dealt.filter(~ends).withColumn("extra", (F.col("before") + F.col("held") <= F.col("rest")).cast("int"))
    out = inside.unionByName(others)
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "text_key", "n_tokens", "weight", "block", (F.col("whole") + F.col("extra")).alias("passes"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The mix itself: every row of ``docs``, as often as its passes."""
    plan = schedule(docs, id_col=id_col, text_col=text_col, **settings)
    plan = plan.groupBy(F.col(id_col).alias("_id"), F.col("text_key").alias("_key")).agg(F.max("passes").alias("_passes"))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("_rid"), F.xxhash64(text_of(text_col)).alias("_rkey"))
    rows = rows.join(plan, F.col("_rid").eqNullSafe(F.col("_id")) & (F.col("_rkey") == F.col("_key")))
    return rows.filter("_passes > 0").select("row", F.explode(F.expr("sequence(1L, _passes)")).alias("_pass")).select("row.*")

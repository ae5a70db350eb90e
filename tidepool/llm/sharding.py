"""Sharding on a consistent-hash ring with bounded loads (operator 12).

Every shard owns ``VIRTUAL`` points of a ring of 2^64 hash values; the arc up to a
point is the shard's.  A row's key (its text, so copies meet) hashes to a place on the
ring, and the row belongs to the arc there.  A shard takes the rows of its own arcs,
clockwise from zero, until it is full; rows beyond that go on clockwise past full
shards to the first with room.  With ``slack`` 0 the capacities add up to the load:

* law ``rows``: capacities are the row counts, dealt evenly, so shards differ by one
  row at most;
* law ``bytes``: capacities are bytes; a row goes where its first byte falls, so a
  shard misses its capacity by less than one row at each cut.

With ``slack`` above 0 a shard holds up to ``1 + slack`` times its even share, fewer
rows overflow, and fewer move when a shard is added.

What is decided per arc (which part of its rows goes where) is decided on one row of
``shards * VIRTUAL`` loads, whatever the table; it is a fold over the arcs with SQL
functions.  Within an arc rows are in the order of (place, hash of id and text, id, size,
checksum), numbered by two-level prefix sums: an arc, and so a group of copies that
holds any share of the rows, is dealt over blocks of about ``BLOCK`` rows by hash.
Copies therefore stay together wherever their arc is one block and is not cut.

Only ids, sizes and hashes are stored and shuffled, never texts.  Null and empty texts
are keys like others (null: the empty text; size 1).  Null ids sort first; rows that
repeat id and text are interchangeable and each gets a slot of its own.  Other columns
are not read.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidepool.llm.common import scratch, stored, text_of

#: Points of one shard on the ring.
VIRTUAL = 256
#: Rows that one task numbers together, about.
BLOCK = 250_000
#: Cells of the ring's directory: a place finds its arc among those that meet its cell.
CELL_BITS = 12


def _points(spark: SparkSession, shards: int) -> DataFrame:
    """``(point, shard)``: the ring, ``shards * VIRTUAL`` rows.  Two points in one
    place: the smaller shard's counts."""
    label = F.concat_ws("#", F.expr(f"id div {VIRTUAL}"), F.expr(f"id % {VIRTUAL}"))
    rows = spark.range(shards * VIRTUAL).select(F.xxhash64(label).alias("point"), F.expr(f"cast(id div {VIRTUAL} as int)").alias("shard"))
    return rows.groupBy("point").agg(F.min("shard").alias("shard"))


def _cell(place: Column) -> Column:
    return F.shiftrightunsigned(place, 64 - CELL_BITS).cast("int")


def _arcs() -> Column:
    """The ring as one array, clockwise in the order of signed values."""
    return F.array_sort(F.collect_list(F.when(F.col("point").isNotNull(), F.struct("point", "shard"))))


def _directory(points: DataFrame) -> DataFrame:
    """For every cell of places the arcs that meet it: ``(cell, near)``, near an array
    of ``(point, arc)``.  The number of cells and points is fixed by the ring."""
    ring = points.agg(_arcs().alias("ring"))
    half = 1 << (CELL_BITS - 1)
    width = 1 << (64 - CELL_BITS)
    cells = F.explode(F.sequence(F.lit(0), F.lit((1 << CELL_BITS) - 1)))
    # Cells count unsigned places; signed ones from the middle on are negative.
    low = F.when(F.col("cell") < half, F.col("cell").cast("long")).otherwise(F.col("cell").cast("long") - (1 << CELL_BITS)) * F.lit(width)
    numbered = F.transform("ring", lambda x, i: F.struct(x["point"].alias("point"), i.alias("arc")))
    inside = F.filter("all", lambda x: (x["point"] >= F.col("low")) & (x["point"] <= F.col("low") + F.lit(width - 1)))
    after = F.array_min(F.filter("all", lambda x: x["point"] > F.col("low") + F.lit(width - 1)))
    # Behind the last point the ring begins again.
    last = F.coalesce(after, F.struct(F.lit((1 << 63) - 1).alias("point"), F.lit(0).alias("arc")))
    rows = ring.select(numbered.alias("all"), cells.alias("cell")).withColumn("low", low)
    return rows.select("cell", F.concat(inside, F.array(last)).alias("near"))


def keyed(docs: DataFrame, points: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, size, crc, place, arc, mixed)`` of every row."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    rows = rows.select("id", (F.octet_length("text") + 1).cast("long").alias("size"), F.crc32(F.encode("text", "UTF-8")).alias("crc"), F.xxhash64("text").alias("place"))
    rows = rows.withColumn("mixed", F.xxhash64("id", "place", "size", "crc")).withColumn("cell", _cell(F.col("place")))
    found = rows.join(F.broadcast(_directory(points)), "cell")
    arc = F.array_min(F.filter("near", lambda x: x["point"] >= F.col("place")))["arc"]
    return found.select("id", "size", "crc", "place", arc.alias("arc"), "mixed")


def _shares(loads: DataFrame, points: DataFrame, shards: int, slack: float) -> DataFrame:
    """``(arc, part, shard, low, high)``: which stretch of an arc's load goes to which
    shard.  ``loads``: (arc, load), one row an arc at most."""
    both = points.unionByName(loads, allowMissingColumns=True)
    held = F.map_from_entries(F.collect_list(F.when(F.col("arc").isNotNull(), F.struct("arc", "load"))))
    one = both.agg(_arcs().alias("ring"), held.alias("held"), F.coalesce(F.sum("load"), F.lit(0)).alias("total"))
    arcs = F.transform("ring", lambda x, i: F.struct(i.alias("arc"), x["shard"].alias("shard"), F.coalesce(F.col("held")[i], F.lit(0).cast("long")).alias("load")))
    total, count = F.col("total"), F.lit(shards)
    # Even shares, the rest one each from shard 0 on; slack adds to them.
    even = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: (F.floor(total / count) + F.when(s < total % count, F.lit(1)).otherwise(F.lit(0))).cast("long") + F.ceil(total * F.lit(float(slack)) / count).cast("long"),
    )
    one = one.select(arcs.alias("arcs"), even.alias("room")).withColumn("n", F.size("arcs"))

    def taken(room: Column, shard: Column, amount: Column) -> Column:
        return F.transform(room, lambda r, s: F.when(s == shard, r - amount).otherwise(r))

    # Own arcs first: what a shard has room for when it goes round once.
    def own(state: Column, x: Column) -> Column:
        keep = F.least(F.get(state["room"], x["shard"]), x["load"])
        return F.struct(taken(state["room"], x["shard"], keep).alias("room"), F.concat(state["kept"], F.array(keep)).alias("kept"))

    start = F.struct(F.col("room").alias("room"), F.array().cast("array<long>").alias("kept"))
    one = one.withColumn("own", F.aggregate("arcs", start, own))

    # Then the rest, arc by arc, goes on clockwise to shards with room.
    share = "array<struct<arc:int,shard:int,low:bigint,high:bigint>>"

    def onward(state: Column, arc: Column, target: Column) -> Column:
        amount = F.least(F.get(state["room"], target), state["left"])
        low = arc["load"] - state["left"]
        row = F.struct(arc["arc"].alias("arc"), target.alias("shard"), low.alias("low"), (low + amount).alias("high"))
        return F.when(amount > 0, F.struct(taken(state["room"], target, amount).alias("room"), (state["left"] - amount).alias("left"), F.concat(state["out"], F.array(row)).alias("out"))).otherwise(state)

    def over(state: Column, arc: Column) -> Column:
        kept = F.get("own.kept", arc["arc"])
        first = F.array(F.struct(arc["arc"].alias("arc"), arc["shard"].alias("shard"), F.lit(0).cast("long").alias("low"), kept.alias("high")))
        out = F.concat(state["out"], F.when(kept > 0, first).otherwise(F.array().cast(share)))
        left = arc["load"] - kept
        # Shards in the order in which their points follow.
        behind = F.array_distinct(F.transform(F.concat(F.slice("arcs", arc["arc"] + 1, F.col("n")), F.slice("arcs", F.lit(1), arc["arc"])), lambda y: y["shard"]))
        begin = F.struct(state["room"].alias("room"), left.alias("left"), out.alias("out"))
        end = F.aggregate(behind, begin, lambda s, target: onward(s, arc, target))
        return F.when(left > 0, F.struct(end["room"].alias("room"), end["out"].alias("out"))).otherwise(F.struct(state["room"].alias("room"), out.alias("out")))

    begin = F.struct(F.col("own.room").alias("room"), F.array().cast(share).alias("out"))
    shares = one.select(F.explode(F.aggregate("arcs", begin, over)["out"]).alias("x")).select("x.*")
    return shares.withColumn("part", F.row_number().over(Window.partitionBy("arc").orderBy("low")))


def _numbered(rows: DataFrame, loads: DataFrame, block: int) -> DataFrame:
    """``rows`` with ``before``: rows of their arc in front of them, and ``ahead``: bytes.
    An arc is dealt by hash over blocks that follow one another."""
    cells = loads.select("arc", F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(block))).cast("long").alias("cells"))
    dealt = rows.join(F.broadcast(cells), "arc").withColumn("block", F.pmod("mixed", "cells")).drop("cells")
    per = dealt.groupBy("arc", "block").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    upto = Window.partitionBy("arc").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    starts = per.select("arc", "block", F.coalesce(F.sum("n").over(upto), zero).alias("n_from"), F.coalesce(F.sum("bytes").over(upto), zero).alias("bytes_from"))
    order = ["place", "mixed", "id", "size", "crc"]
    # Of all columns that a row has, so rows that tie are equal.
    within = Window.partitionBy("arc", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = dealt.withColumn("nth", F.count(F.lit(1)).over(within)).withColumn("upto", F.sum("size").over(within))
    placed = counted.join(starts, ["arc", "block"])
    return placed.select("id", "size", "crc", "arc", (F.col("n_from") + F.col("nth") - 1).alias("before"), (F.col("bytes_from") + F.col("upto") - F.col("size")).alias("ahead"))


def sharded(docs: DataFrame, shards: int = 16, law: str = "rows", slack: float = 0.0, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``(id_col, size, text_crc32, law, shard, slot)`` of every row: its shard and its
    place there, from 0 without gaps."""
    if law not in ("rows", "bytes") or shards < 1 or slack < 0:
        raise ValueError("law is 'rows' or 'bytes', shards at least 1, slack at least 0")
    spark = docs.sparkSession
    points = _points(spark, shards)
    rows = stored(keyed(docs, points, id_col, text_col), scratch(spark, "shard-keys"))
    # One row an arc: the ring bounds these tables, and so their broadcasts.
    loads = stored(rows.groupBy("arc").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).coalesce(1), scratch(spark, "shard-loads"))
    shares = _shares(loads.select("arc", F.col("n" if law == "rows" else "bytes").alias("load")), points, shards, slack)
    parts = shares.groupBy("arc").agg(F.array_sort(F.collect_list(F.struct("low", "high", "shard", "part"))).alias("parts"))
    parts = stored(parts.coalesce(1), scratch(spark, "shard-parts"))
    at = F.col("before" if law == "rows" else "ahead")
    own = F.filter("parts", lambda x: (x["low"] <= at) & (at < x["high"]))[0]
    numbered = _numbered(rows, loads, block).join(F.broadcast(parts), "arc").withColumn("own", own).drop("parts")
    if law == "bytes":
        # Rows of a stretch are counted; by rows its bounds tell them.
        numbered = stored(numbered, scratch(spark, "shard-rows"))
        spread = numbered.groupBy("arc", F.col("own.part").alias("part"), F.col("own.shard").alias("shard")).agg(F.min("before").alias("low"), F.count(F.lit(1)).alias("n"))
    else:
        spread = parts.select("arc", F.explode("parts").alias("x")).select("arc", "x.part", "x.shard", "x.low", (F.col("x.high") - F.col("x.low")).alias("n"))
    upto = Window.partitionBy("shard").orderBy("arc", "part").rowsBetween(Window.unboundedPreceding, -1)
    bases = spread.select("arc", "part", (F.coalesce(F.sum("n").over(upto), F.lit(0).cast("long")) - F.col("low")).alias("base"))
    out = numbered.withColumn("part", F.col("own.part")).join(F.broadcast(bases), ["arc", "part"])
    return out.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit(law).alias("law"),
        F.col("own.shard").alias("shard"), (F.col("base") + F.col("before")).alias("slot"),
    )

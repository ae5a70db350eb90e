"""MinHash near-dedup with HyperMinHash sketches (operator 7).

1. Every text becomes its set of distinct shingle hashes and a sketch: hash
   space is cut in ``REGISTERS`` equal buckets, and each register keeps, for
   the smallest hash in its bucket, the count of leading zeros (6 bits) and the
   next 10 bits.  For banding only, an empty register takes the first filled
   one in a fixed random order of its own, so short texts have full bands too
   and each register still agrees with a chance of about the similarity.
2. Texts with equal sets form one class, which goes on as its smallest id.
3. Sketches are cut in bands of up to ``ROWS`` registers, as many as leave two
   sets at the threshold without a common bucket in one case of a million at
   most (``band_rows``): 48 bands of 8 at 0.85 (3e-7), 64 bands of 6 at 0.8 (4e-9).
4. Within a bucket, members are compared with a few pivots, never all with
   all.  Pairs already in one component are not compared; a bucket is done
   when its members that have not been pivots share one component, else it
   goes on with more pivots (1, 16, 256).  So every candidate pair is either
   compared or already joined, and the components are those of all links.
   Buckets are cut in parts of about ``PART`` members, each with a copy of the
   pivots, and compared in the tasks, so a bucket of any size is spread out.
5. A pair is dropped unread when its set sizes rule the link out, or when the
   collision-corrected estimate lies over five standard errors below the
   threshold.  All others are confirmed on their full sets.

Nulls and empty texts, or texts without words: an empty set, linked with nothing.
Fewer words than a shingle: the whole sequence is the one shingle.  Rows with a
null id are left out.  Rows that repeat an id are one node; the result has one
row for each distinct (id, set size).  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm import words as W
from tidepool.llm.common import scratch, stored
from tidepool.llm.components import components

ROWS = 8
REGISTERS = 48 * ROWS
#: Largest chance that two sets at the threshold share no bucket.
MISSED = 1e-6
MANTISSA_BITS = 10
EMPTY = 0xFFFF
#: Members of a bucket that one task compares, and most pivots a bucket in one step.
PART, PIVOTS = 500, 256
#: First hash of each bucket.
EDGES = np.array([-(-(i << 64) // REGISTERS) for i in range(REGISTERS)], np.uint64)
#: For each register, in which order it looks for a filled one (itself first).
_RANDOM = np.random.default_rng(7)
LOOK = np.array([[i, *(x for x in _RANDOM.permutation(REGISTERS) if x != i)] for i in range(REGISTERS)])


def sketch(distinct: np.ndarray) -> np.ndarray:
    """Registers of a non-empty, ascending array of distinct 64-bit hashes."""
    at = np.searchsorted(distinct, EDGES)
    stop = np.append(at[1:], len(distinct))
    filled = np.flatnonzero(at < stop)
    rest = (distinct[at[filled]] - EDGES[filled]) * np.uint64(REGISTERS)  # spread over 64 bits
    part, exponent = np.frexp(rest.astype(np.float64))
    zeros = np.clip(64 - exponent, 0, 63)
    bits = ((part * 2 - 1) * (1 << MANTISSA_BITS)).clip(0, (1 << MANTISSA_BITS) - 1)
    values = (zeros.astype(np.uint16) << np.uint16(MANTISSA_BITS)) | bits.astype(np.uint16)
    out = np.full(REGISTERS, EMPTY, np.uint16)
    out[filled] = values
    return out


def band_rows(percent: int) -> int:
    """Registers a band: the most, up to ``ROWS``, that keep to ``MISSED``."""
    fits = (r for r in range(ROWS, 1, -1) if REGISTERS % r == 0 and (1 - (percent / 100) ** r) ** (REGISTERS // r) <= MISSED)
    return next(fits, 1)


def band_keys(registers: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band, of ``rows`` registers, of one sketch."""
    bands = REGISTERS // rows
    full = registers != EMPTY
    if not full.all():
        empty = np.flatnonzero(~full)
        look = LOOK[empty]
        registers = registers.copy()
        registers[empty] = registers[look[np.arange(len(empty)), full[look].argmax(axis=1)]]
    quads = registers.reshape(bands, rows).astype(np.uint64)
    weights = W.powers(W.SEQ_BASE, rows)
    return W.mix((quads * weights).sum(axis=1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64) * np.uint64(0x5851F42D4C957F2D))


def estimate(one: np.ndarray, n_one: float, many: np.ndarray, n_many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Similarity of one sketch to many, and over how many registers: the share
    of equal ones among those that either side fills, less the chance that
    registers of unrelated minima agree (the sum over zero counts of both
    sides' probabilities, over the values of the mantissa)."""
    used = ((many != EMPTY) | (one != EMPTY)).sum(axis=1)
    match = ((many == one) & (many != EMPTY)).sum(axis=1) / used
    zeros = np.arange(64)

    def law(n):
        rate = np.atleast_1d(n)[:, None] / REGISTERS
        return np.exp(-rate * 2.0 ** -(zeros + 1)) - np.exp(-rate * 2.0**-zeros)

    chance = (law(n_one) * law(n_many)).sum(axis=1) / (1 << MANTISSA_BITS)
    return np.clip((match - chance) / (1 - chance), 0, 1), used


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each row's place in the batch and its ascending distinct shingle hashes."""
    at = 0
    for part in W.slices(batch, "text"):
        w = W.words(part.column(1), lower=True)
        grams = W.windows(w.hash, size)
        for i in range(part.num_rows):
            a, b = w.first[i], w.first[i + 1]
            if b - a >= size:
                yield at + i, np.unique(grams[a : b - size + 1])
            elif b > a:
                yield at + i, np.full(1, W.whole(w.hash[a:b]), np.uint64)
            else:
                yield at + i, np.zeros(0, np.uint64)
        at += part.num_rows


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``(id, n_shingles, set_key, registers)`` per row."""

    def run(batches):
        for batch in batches:
            n, key, regs = [], [], []
            for _, s in _sets(batch, size):
                n.append(len(s))
                key.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                regs.append(sketch(s).tobytes() if len(s) else None)
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(regs, pa.binary())], ["id", "n_shingles", "set_key", "registers"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.filter("id is not null").mapInArrow(run, "id long, n_shingles long, set_key binary, registers binary")


def full_sets(docs: DataFrame, id_col: str, text_col: str, ids: DataFrame, size: int) -> DataFrame:
    """``(id, shingles)`` for the rows whose id is in ``ids``."""

    def run(batches):
        for part in (p for batch in batches for p in W.slices(batch, "text")):
            flat, bounds = [np.zeros(0, np.int64)], [0]
            for _, s in _sets(part, size):
                flat.append(s.view(np.int64))
                bounds.append(bounds[-1] + len(s))
            shingles = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(flat)))
            yield pa.record_batch([part.column(0), shingles], ["id", "shingles"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.join(ids, "id", "left_semi").mapInArrow(run, "id long, shingles array<long>")


def _bands(reps: DataFrame, width: int) -> DataFrame:
    """``(bucket, id)``: one row for each band of each class."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                keys = np.concatenate([band_keys(r, width) for r in regs]).view(np.int64)
                ids = np.repeat(batch.column(0).to_numpy(), REGISTERS // width)
                yield pa.record_batch([pa.array(keys), pa.array(ids)], ["bucket", "id"])

    return reps.select("id", "registers").mapInArrow(run, "bucket long, id long")


def _likely(members: DataFrame, pivots: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of a bucket's pivots and its other members that lie in
    different components and that the sketches do not rule out."""
    share = percent / 100
    width = band_rows(percent)

    def pairs(rows):
        """Of the rows of one part of one bucket.  A pair that meets in several
        buckets of a pivot goes out in the first of them only."""
        bucket, part, ids, root, is_pivot, n, buckets, regs = rows
        keys: dict[int, set] = {}
        for p in np.flatnonzero(is_pivot):
            fits = (root != root[p]) & (ids != ids[p])
            if part:  # pivots stand in every part
                fits &= ~is_pivot
            fits &= 100 * np.minimum(n, n[p]) >= percent * np.maximum(n, n[p])
            other = np.flatnonzero(fits)
            if not len(other):
                continue
            j, used = estimate(regs[p], n[p], regs[other], n[other])
            # At the threshold the union would hold this many shingles; registers
            # are a sample of them without replacement (hypergeometric).
            union = np.maximum((n[other] + n[p]) / (1 + share), 2)
            spread = np.sqrt(share * (1 - share) / used * np.maximum(union - used, 0) / (union - 1))
            for o in other[(j >= share - 5 * spread - 0.005) & (used <= union + 1)].tolist():
                if o not in keys:
                    keys[o] = set(band_keys(regs[o], width).view(np.int64).tolist())
                if bucket == min((x for x in buckets[p] if x in keys[o]), default=bucket):
                    yield min(ids[o], ids[p]), max(ids[o], ids[p])

    def run(batches):
        held: list[pa.RecordBatch] = []

        def done(t: pa.Table):
            keys = t["bucket"].to_numpy()
            part = t["part"].to_numpy()
            cut = np.flatnonzero((keys[1:] != keys[:-1]) | (part[1:] != part[:-1])) + 1
            cols = [t["id"].to_numpy(), t["root"].to_numpy(), t["is_pivot"].to_numpy(), t["n_shingles"].to_numpy().astype(np.float64)]
            regs = np.frombuffer(b"".join(t["registers"].to_pylist()), np.uint16).reshape(-1, REGISTERS)
            buckets = t["buckets"].to_pylist()
            found = set()
            for a, b in zip([0, *cut], [*cut, len(keys)]):
                found.update(pairs((int(keys[a]), int(part[a]), *(c[a:b] for c in cols), buckets[a:b], regs[a:b])))
            pair = np.array(sorted(found), np.int64).reshape(-1, 2)
            return pa.record_batch([pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["a", "b"])

        for batch in batches:  # whole groups at a time; the last may go on in the next batch
            if not batch.num_rows:
                continue
            held.append(batch)
            t = pa.Table.from_batches(held).combine_chunks()
            keys, part = t["bucket"].to_numpy(), t["part"].to_numpy()
            last = np.flatnonzero((keys != keys[-1]) | (part != part[-1]))
            if len(last):
                yield done(t.slice(0, last[-1] + 1))
                held = t.slice(last[-1] + 1).to_batches()
        if held:
            yield done(pa.Table.from_batches(held).combine_chunks())

    # Pivots stand in every part of their bucket, the other members in one.
    parts = members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    own = pivots.groupBy("pivot").agg(F.collect_set("bucket").alias("buckets"))
    chosen = pivots.join(parts, "bucket").join(own, "pivot").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    chosen = chosen.select("bucket", "part", F.col("pivot").alias("id"), F.col("pivot_root").alias("root"), F.lit(True).alias("is_pivot"), "buckets")
    others = members.join(pivots.select("bucket", F.col("pivot").alias("id")), ["bucket", "id"], "left_anti").join(parts, "bucket")
    others = others.join(pivots.select("bucket").distinct(), "bucket", "left_semi")
    part = F.expr("int(pmod(xxhash64(id), parts))").alias("part")
    others = others.select("bucket", part, "id", "root", F.lit(False).alias("is_pivot"), F.lit(None).cast("array<long>").alias("buckets"))
    rows = chosen.unionByName(others).join(reps, "id")
    rows = rows.repartition("bucket", "part").sortWithinPartitions("bucket", "part")
    rows = rows.select("bucket", "part", "id", "root", "is_pivot", "n_shingles", "buckets", "registers")
    return rows.mapInArrow(run, "a long, b long").distinct()


def _gathered(df: DataFrame, *by: str) -> DataFrame:
    """``df`` dealt anew by ``by``, for tables that many tasks make a little of:
    they are written as few files.  In a shared folder that is a plain file
    system Hadoop starts a process for each file, and until that one runs its
    own program it counts with all the memory of the executor that it comes from."""
    return df.repartition(*by)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 85) -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)`` for each document: the size
    of its shingle set, the smallest id reachable over links of similarity
    ``percent`` / 100 or more, and whether that is its own."""
    spark = docs.sparkSession
    base = scratch(spark, "near-dup")
    sk = stored(sketches(docs, id_col, text_col, size), f"{base}/sketches")

    # Classes of equal sets, each under its smallest id.
    classes = stored(sk.filter("n_shingles > 0").groupBy("set_key").agg(F.min("id").alias("rep")), f"{base}/classes")
    reps = sk.join(classes, (sk.id == classes.rep) & (sk.set_key == classes.set_key), "left_semi").select("id", "n_shingles", "registers").dropDuplicates(["id", "n_shingles"])
    reps = stored(reps, f"{base}/reps")

    rows = _bands(reps, band_rows(percent))
    shared = rows.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi").select("bucket")
    members = stored(_gathered(rows.join(shared, "bucket").distinct(), "id"), f"{base}/members")
    sets = full_sets(docs, id_col, text_col, members.select("id").distinct(), size)
    sets = stored(_gathered(sets, "id"), f"{base}/sets")

    roots = None  # (node, root) of the nodes that are not their own root
    done = None  # pairs compared so far
    links = None
    step = 0
    while True:
        rooted = members.withColumn("root", F.col("id")) if roots is None else members.join(roots, members.id == roots.node, "left").select("bucket", "id", F.coalesce("root", "id").alias("root"))
        if step == 0:
            pivots = rooted.groupBy("bucket").agg(F.min("id").alias("pivot"), F.min("id").alias("pivot_root"))
        else:
            # A bucket goes on while it holds members of several components;
            # pivots are members of the components with the fewest rows there.
            rooted = stored(rooted, f"{base}/rooted-{step}")
            spans = rooted.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("bucket")
            open_ = rooted.join(spans, "bucket", "left_semi")
            ranked = open_.join(open_.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n")), ["bucket", "root"])
            order = F.row_number().over(Window.partitionBy("bucket").orderBy("n", "root", "id"))
            pivots = ranked.withColumn("place", order).filter(F.col("place") <= min(16**step, PIVOTS)).select("bucket", F.col("id").alias("pivot"), F.col("root").alias("pivot_root"))
        pivots = stored(pivots, f"{base}/pivots-{step}")
        if pivots.isEmpty():
            break
        pairs = _likely(rooted, pivots, reps, percent)
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = stored(pairs, f"{base}/pairs-{step}")
        done = pairs if done is None else done.unionByName(pairs)
        both = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("s_a")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("s_b")), "b")
        both = both.withColumn("common", F.size(F.array_intersect("s_a", "s_b")))
        found = both.filter(f"100 * common >= {percent} * (size(s_a) + size(s_b) - common)").select("a", "b").distinct()
        found = stored(_gathered(found, "a", "b"), f"{base}/links-{step}")
        if roots is None or not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            roots = components(links, "a", "b")
        # What has been a pivot of a bucket has met all its members.
        members = stored(members.join(pivots.select("bucket", F.col("pivot").alias("id")), ["bucket", "id"], "left_anti"), f"{base}/members-{step + 1}")
        step += 1

    # Ids that stand for several classes (rows repeating an id) join them all.
    own = sk.filter("n_shingles > 0").select("id", "set_key").join(classes, "set_key").select("id", "rep").filter("id <> rep")
    edges = own.select(F.col("id").alias("a"), F.col("rep").alias("b"))
    if links is not None:
        edges = edges.unionByName(links)
    final = components(edges, "a", "b")
    out = sk.select("id", "n_shingles").distinct().join(final, F.col("id") == F.col("node"), "left")
    return out.select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.coalesce("root", "id").alias("component_id"),
        (F.coalesce("root", "id") == F.col("id")).alias("kept"),
    )

"""Approximate nearest neighbours by multiprobe p-stable hashing (operator 3).

Nearness is the inner product.  Vectors get one more component that lifts them
all to the largest norm, queries are scaled to that norm with a zero there, and
then the nearest by distance is the largest inner product.

* Each of ``TABLES`` tables hashes a vector to the floors of ``HASHES`` Gaussian
  projections over a width; those integers name its bucket.
* A query visits buckets of each table, its own and those with integers
  moved by one, in the order of estimated success: the sum of squared distances
  to the borders that are crossed.  How many is measured on the data: for ``SAMPLE`` query
  classes the true neighbours among all classes are found, with the place of each one's bucket in
  that order; the fewest probes that reach ``TARGET`` of them are taken.  Clustered vectors need few
  probes; vectors without any structure need most buckets.
* Candidates of a visited bucket are ranked by exact inner product; each query's
  best lists of all tables are merged.

Equal vectors are one class: it is hashed and compared once, and its members
(the ``top`` + 1 smallest ids can ever be results) are put in at the end.  Buckets are
dealt to groups of about ``CHUNK`` vectors; a query goes once to each group that
it probes, with the list of its buckets.  A group that is larger than that,
for a hot bucket, is cut in parts that each get its queries, and one with
very many queries is cut by query too, so no task holds more than a chunk of
either and no pair of a query and a vector is ever a row.

Vectors that are null, zero or hold null or non-finite components take no part,
nor do those of another length than the most common one (the smaller, in a tie).
Rows without an id take no part.  Rows that repeat an id with equal vectors count once; with
different ones, each is a candidate.  Fewer candidates than ``top``: all that are found.
Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm import words as W
from tidepool.llm.common import scratch, stored

#: Few tables with many probes each: a pair is compared at most once a table.
TABLES, HASHES, WIDTH = 2, 7, 2.5
#: Query classes whose true neighbours set the number of probes, and the share to reach.
SAMPLE, TARGET = 64, 0.95
CHUNK, QUERY_CHUNK = 8192, 8192
_MOVES = np.array(list(itertools.product((0, -1, 1), repeat=HASHES)))


def _planes(dim: int, norm: float, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    rng = np.random.default_rng(seed)
    return [(rng.normal(size=(dim + 1, HASHES)) / (WIDTH * norm), rng.uniform(0, 1, HASHES)) for _ in range(TABLES)]


def _bucket(table: int, cells: np.ndarray) -> np.ndarray:
    """64-bit name of a bucket, the last axis being its integers."""
    weights = W.powers(W.SEQ_BASE, HASHES + 1)[1:]
    return W.mix((cells.astype(np.int64).view(np.uint64) * weights).sum(axis=-1, dtype=np.uint64) + np.uint64(table + 1))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _lifted(v: np.ndarray, norm: float) -> np.ndarray:
    return np.hstack([v, np.sqrt(np.maximum(norm * norm - (v * v).sum(axis=1), 0))[:, None]])


def _asked(v: np.ndarray, norm: float) -> np.ndarray:
    return np.hstack([v * (norm / np.sqrt((v * v).sum(axis=1)))[:, None], np.zeros((len(v), 1))])


def _order(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each query's cell, and all moves from it by estimated success."""
    cell = np.floor(p)
    rest = p - cell
    cost = (_MOVES == -1) @ (rest**2).T + (_MOVES == 1) @ ((1 - rest) ** 2).T
    return cell, np.argsort(cost, axis=0, kind="stable").T


def _probes(classes: DataFrame, queries: DataFrame, dim: int, norm: float, top: int, seed: int) -> int:
    """The fewest probes a table that reach ``TARGET`` of the sampled queries' neighbours."""
    sample = queries.select("cls", "vec").orderBy(F.xxhash64("cls"), "cls").limit(SAMPLE).collect()
    if not sample:
        return 1
    asks, own = np.array([r["vec"] for r in sample], np.float64), np.array([r["cls"] for r in sample])

    def run(batches):
        best = [(np.zeros(0), np.zeros((0, dim)), np.zeros(0, np.int64)) for _ in own]
        for batch in batches:
            if not batch.num_rows:
                continue
            v, cls = _matrix(batch.column(1), dim), batch.column(0).to_numpy()
            scores = asks @ v.T
            scores[own[:, None] == cls] = -np.inf
            k = min(top, len(cls))
            for i, row in enumerate(np.argpartition(-scores, k - 1, axis=1)[:, :k]):
                row = row[scores[i, row] > -np.inf]
                score, held, name = (np.concatenate(x) for x in zip(best[i], (scores[i, row], v[row], cls[row])))
                first = np.lexsort((name, -score))[:top]
                best[i] = score[first], held[first], name[first]
        # Moves count in threes, digits 0, -1, 1: a move's digits are its row of _MOVES.
        code = 3 ** np.arange(HASHES)[::-1]
        tables = []
        for a, b in _planes(dim, norm, seed):
            cell, order = _order(_asked(asks, norm) @ a + b)
            tables.append((a, b, cell, np.argsort(order, axis=1)))
        for i, (score, held, name) in enumerate(best):
            if not len(name):
                continue
            need = np.full(len(name), len(_MOVES) + 1, np.int64)
            for a, b, cell, place in tables:
                move = (np.floor(_lifted(held, norm) @ a + b) - cell[i]).astype(np.int64)
                near = (np.abs(move) <= 1).all(axis=1)
                at = ((move[near] % 3 * 2 % 3) * code).sum(axis=1)
                need[near] = np.minimum(need[near], place[i, at] + 1)
            yield pa.record_batch([pa.array(np.full(len(name), i)), pa.array(score), pa.array(name), pa.array(need)], ["i", "score", "cls", "need"])

    found = classes.select("cls", "vec").mapInArrow(run, "i long, score double, cls long, need long")
    place = F.row_number().over(Window.partitionBy("i").orderBy(F.desc("score"), "cls"))
    needs = sorted(r["need"] for r in found.withColumn("place", place).filter(F.col("place") <= top).select("need").collect())
    return min(needs[max(0, int(np.ceil(TARGET * len(needs))) - 1)], len(_MOVES)) if needs else 1


def _indexed(classes: DataFrame, dim: int, norm: float, groups: int, seed: int, kind: str) -> DataFrame:
    """``(tab, grp, bucket, cls, vec)``: each class once a table."""

    def run(batches):
        planes = _planes(dim, norm, seed)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column(1), dim)
            for t, (a, b) in enumerate(planes):
                bucket = _bucket(t, np.floor(_lifted(v, norm) @ a + b))
                yield pa.record_batch(
                    [pa.array(np.full(len(v), t, np.int32)), pa.array((bucket % np.uint64(groups)).astype(np.int64)), pa.array(bucket.view(np.int64)), batch.column(0), batch.column(1)],
                    ["tab", "grp", "bucket", "cls", "vec"],
                )

    return classes.select("cls", "vec").mapInArrow(run, f"tab int, grp long, bucket long, cls long, vec {kind}")


def _probing(queries: DataFrame, dim: int, norm: float, groups: int, seed: int, kind: str, probes: int) -> DataFrame:
    """``(tab, grp, query, vec, buckets)``: each query once for each group that
    it probes."""

    def run(batches):
        planes = _planes(dim, norm, seed)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                v = _asked(_matrix(part.column(1), dim), norm)
                out: list[list] = [[], [], [], []]
                for t, (a, b) in enumerate(planes):
                    cell, order = _order(v @ a + b)
                    bucket = _bucket(t, cell[:, None, :] + _MOVES[order[:, :probes]])
                    group = (bucket % np.uint64(groups)).astype(np.int64)
                    for i in range(len(v)):
                        for g in np.unique(group[i]):
                            out[0].append(t)
                            out[1].append(int(g))
                            out[2].append(i)
                            out[3].append(bucket[i][group[i] == g].view(np.int64))
                rows = pa.array(out[2], pa.int64())
                yield pa.record_batch(
                    [pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), part.column(0).take(rows), part.column(1).take(rows), pa.array(out[3], pa.list_(pa.int64()))],
                    ["tab", "grp", "query", "vec", "buckets"],
                )

    return queries.select("cls", "vec").mapInArrow(run, f"tab int, grp long, query long, vec {kind}, buckets array<long>")


def _best(index: DataFrame, probes: DataFrame, dim: int, top: int) -> DataFrame:
    """``(query, found)``: for each query and part of a group, its best classes
    as an array of (score, cls)."""

    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        none = pa.table({"query": pa.array([], pa.int64()), "found": pa.array([], pa.list_(pa.struct([("score", pa.float64()), ("cls", pa.int64())])))})
        if not left.num_rows or not right.num_rows:
            return none
        left = left.combine_chunks()
        v, cls = _matrix(left["vec"].chunk(0), dim), left["cls"].to_numpy()
        small = (v / np.sqrt((v * v).sum(axis=1).max())).astype(np.float32)
        names, of = np.unique(left["bucket"].to_numpy(), return_inverse=True)
        ids, found = [], []
        for batch in right.combine_chunks().to_batches(max_chunksize=256):
            q = _matrix(batch.column(batch.schema.get_field_index("vec")), dim)
            seen = np.zeros((len(q), len(names)), bool)
            buckets = batch.column(batch.schema.get_field_index("buckets"))
            flat = buckets.flatten().to_numpy()
            row = np.repeat(np.arange(len(q)), buckets.value_lengths().to_numpy())
            at = np.searchsorted(names, flat).clip(max=len(names) - 1)
            hit = names[at] == flat
            seen[row[hit], at[hit]] = True
            # Single precision selects, with room for all that its rounding could
            # put below the last place; double precision ranks.
            rough = (q / np.sqrt((q * q).sum(axis=1))[:, None]).astype(np.float32) @ small.T
            rough[~seen[:, of]] = -np.inf
            k = min(top + 1, len(cls))
            last = np.partition(rough, len(cls) - k, axis=1)[:, len(cls) - k]
            last = last - (dim + 2) * 2.0**-22
            for i, query in enumerate(batch.column(batch.schema.get_field_index("query")).to_pylist()):
                mine = np.flatnonzero((rough[i] >= last[i]) & (rough[i] > -np.inf))
                if len(mine):
                    # One fixed order of additions: a pair scores alike in every group.
                    exact = (v[mine] * q[i]).sum(axis=1)
                    order = np.lexsort((cls[mine], -exact))[: top + 1]
                    ids.append(query)
                    found.append([{"score": float(exact[o]), "cls": int(cls[mine[o]])} for o in order])
        return pa.table({"query": pa.array(ids, pa.int64()), "found": pa.array(found, none.schema.field("found").type)})

    def parts(df: DataFrame, size: int, name: str) -> DataFrame:
        n = df.groupBy("tab", "grp").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))
        return n

    counts = parts(index, CHUNK, "vparts").join(parts(probes, QUERY_CHUNK, "qparts"), ["tab", "grp"])
    counts = counts.withColumnsRenamed({"tab": "t_", "grp": "g_"})
    key = lambda d: (d.tab == F.col("t_")) & (d.grp == F.col("g_"))
    left = index.join(counts, key(index)).withColumn("vp", F.expr("int(pmod(xxhash64(cls), vparts))")).withColumn("qp", F.explode(F.expr("sequence(0, qparts - 1)")))
    right = probes.join(counts, key(probes)).withColumn("qp", F.expr("int(pmod(xxhash64(query), qparts))")).withColumn("vp", F.explode(F.expr("sequence(0, vparts - 1)")))
    by = ("tab", "grp", "vp", "qp")
    grouped = left.select(*by, "bucket", "cls", "vec").groupBy(*by).cogroup(right.select(*by, "query", "vec", "buckets").groupBy(*by))
    return grouped.applyInArrow(match, "query long, found array<struct<score:double,cls:long>>")


def nearest(vectors: DataFrame, is_query, top: int = 20, seed: int = 11, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, id_col, score)``: for each row that ``is_query`` (a
    column) selects, its ``top`` nearest other rows found, nearest first, ties to
    the smaller id."""
    spark = vectors.sparkSession
    base = scratch(spark, "ann")
    held = vectors.schema[vector_col].dataType
    kind = "array<float>" if isinstance(held, T.ArrayType) and isinstance(held.elementType, T.FloatType) else "array<double>"
    vec = F.col(vector_col).cast(kind)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"), is_query.alias("asks")).filter("id is not null and vec is not null")
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = rows.filter(fine).dropDuplicates()
    rows = stored(rows.withColumn("norm", F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x))), f"{base}/rows")
    common = rows.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("norm")).orderBy(F.desc("n"), "dim").first()
    out = "query_id long, rank int, id long, score double"
    if common is None:
        return spark.createDataFrame([], out).withColumnRenamed("id", id_col)
    dim, norm = common["dim"], common["norm"]
    rows = rows.filter(F.size("vec") == dim)

    # Classes of equal vectors, with the ids that can be results.
    first = Window.partitionBy("vec").orderBy("id")
    few = rows.select("vec", "id").withColumn("place", F.row_number().over(first)).filter(F.col("place") <= top + 1)
    classes = stored(few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.get("ids", F.lit(0)).alias("cls"), "vec", "ids"), f"{base}/classes")
    asking = stored(rows.filter("asks").select("vec", "id").join(classes.select("vec", "cls"), "vec").select(F.col("id").alias("query_id"), "cls"), f"{base}/asking")
    queries = classes.join(asking.select("cls").distinct(), "cls", "left_semi")
    visits = _probes(classes, queries, dim, norm, top, seed)

    groups = -(-classes.count() // CHUNK) or 1
    index = stored(_indexed(classes, dim, norm, groups, seed, kind), f"{base}/index")
    probes = stored(_probing(queries, dim, norm, groups, seed, kind, visits), f"{base}/probes")
    # Each query's best classes of all parts and tables.
    found = _best(index, probes, dim, top).groupBy("query").agg(F.flatten(F.collect_list("found")).alias("found"))
    ranked = F.sort_array(F.transform("found", lambda x: F.struct((-x["score"]).alias("far"), x["cls"].alias("cls"))))
    # A class comes from each table once at most: the first places hold enough different ones.
    ranked = F.slice(F.array_distinct(F.slice(ranked, 1, (top + 1) * TABLES)), 1, top + 1)
    best = found.select("query", F.explode(ranked).alias("f")).select("query", "f.far", F.col("f.cls").alias("cls"))
    # Members of those classes, then the nearest ids of each query class.
    members = best.join(classes.select("cls", "ids"), "cls").select("query", "far", F.explode("ids").alias("id"))
    lists = members.groupBy("query").agg(F.slice(F.sort_array(F.collect_list(F.struct("far", "id"))), 1, top + 1).alias("near"))
    each = asking.join(lists, asking.cls == lists.query).select("query_id", F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, top).alias("near"))
    flat = each.select("query_id", F.posexplode("near").alias("rank", "x"))
    return flat.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("x.id").alias(id_col), (-F.col("x.far")).alias("score"))

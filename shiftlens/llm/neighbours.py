"""Approximate nearest neighbours by cross-polytope hashing.

A table rotates unit vectors by three rounds of random signs and a fast Hadamard transform; a vector's
bucket is the signed axis nearest to it.  Every row lies in one bucket of each table; a query probes
its ``probes`` nearest axes of each.  A bucket is searched exactly, in blocks of bounded rows, and
the best of all buckets are ranked by the inner product of the original vectors in double precision.

Of equal vectors only the ``k`` + 1 smallest ids can be among the nearest, so the others need not be
searched.  A query that finds fewer than ``k`` rows is searched again over all rows, in blocks.

Edge cases: vectors that are null, zero, or hold null or non-finite components, or are of another
length than most, and rows without vec_id take no part; rows that repeat a vec_id count once, with
the smallest vector; fewer candidates than ``k`` are all returned; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shiftlens.llm.common import staged

TABLES, PROBES, K, EVERY, ROUNDS = 8, 20, 20, 20, 3
#: Rows and queries that are searched in one group at most, give or take the evenness of a hash.
ROWS, QUERIES = 8192, 4096
FOUND = "query_id long, vec_id long, score double"
PLACED = "vec_id long, vector array<double>, place int, bucket int, query boolean"


def hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised Walsh-Hadamard transform of each row; the width is a power of two."""
    rows, width = x.shape
    step = 1
    while step < width:
        pairs = x.reshape(rows, width // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows, width)
        step *= 2
    return x / np.sqrt(width)


def axes(x: np.ndarray, table: int) -> np.ndarray:
    """Nearness of the rotated rows to the signed axes, positive axes first."""
    width = 1 << max(x.shape[1] - 1, 1).bit_length()
    y = np.zeros((len(x), width))
    y[:, : x.shape[1]] = x / np.linalg.norm(x, axis=1, keepdims=True)
    signs = np.random.default_rng(table)
    for _ in range(ROUNDS):
        y = hadamard(y * signs.choice([-1.0, 1.0], width))
    return np.concatenate([y, -y], axis=1)


def vectors(column: pa.Array) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False)).astype(np.float64)


def placed(batches: Iterator[pa.RecordBatch], tables: int, probes: int, every: int) -> Iterator[pa.RecordBatch]:
    """A row for each table, and one more for each table and probe if the row is a query."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, x = batch.column(0).to_numpy(), vectors(batch.column(1))
        asks = np.flatnonzero(ids % every == 0)
        for table in range(tables):
            near = axes(x, table)
            best = np.argpartition(-near[asks], min(probes, near.shape[1]) - 1, axis=1)[:, :probes]
            rows = np.concatenate([np.arange(len(ids)), np.repeat(asks, best.shape[1])])
            bucket = np.concatenate([near.argmax(axis=1), best.ravel()]).astype("i4")
            query = np.arange(len(rows)) >= len(ids)
            columns = [pa.array(ids[rows]), batch.column(1).take(pa.array(rows)), pa.array(np.full(len(rows), table, "i4")), pa.array(bucket), pa.array(query)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "vector", "place", "bucket", "query"])


def best_of(group: pa.Table, k: int) -> pa.Table:
    """The ``k`` rows nearest to each query of a block, without the query's own; ties to the smaller id."""
    asked = np.array(group["query"], dtype=bool)
    out: list[tuple[np.ndarray, ...]] = []
    if asked.any() and not asked.all():
        ids, x = group["vec_id"].to_numpy(), vectors(group["vector"].combine_chunks())
        q_ids, q, r_ids, r = ids[asked], x[asked], ids[~asked], x[~asked]
        for at in range(0, len(q), 256):
            near = q[at : at + 256] @ r.T
            near[q_ids[at : at + 256, None] == r_ids] = -np.inf
            least = -np.partition(-near, k - 1, axis=1)[:, k - 1 : k] if near.shape[1] > k else np.full((len(near), 1), -np.inf)
            # a margin above rounding, then the same sum for every pair, so that equal vectors tie
            rows, found = np.nonzero((near >= least - 1e-9 * np.maximum(1, np.abs(least))) & (near > -np.inf))
            score = (q[at + rows] * r[found]).sum(axis=1)
            order = np.lexsort((r_ids[found], -score, rows))
            rows, found, score = rows[order], found[order], score[order]
            first = np.searchsorted(rows, rows)
            keep = np.arange(len(rows)) - first < k
            out.append((q_ids[at + rows[keep]], r_ids[found[keep]], score[keep]))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.array([], "i8"), np.array([], "i8"), np.array([], "f8")]
    return pa.Table.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])


def valid(embeddings: DataFrame) -> DataFrame:
    """vec_id, vector of the rows that take part, staged."""
    vector = F.col("embedding").cast("array<double>")
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", number) & F.exists("vector", lambda x: x != 0))
    size = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if size is not None:
        rows = rows.filter(F.size("vector") == size["n"])
    return staged(rows.groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors")


def searched(rows: DataFrame, k: int) -> DataFrame:
    """The best of each query in every (place, bucket) of ``rows``, searched in blocks of bounded size."""
    counts = rows.groupBy("place", "bucket").agg(F.count(F.when(~F.col("query"), 1)).alias("r"), F.count(F.when(F.col("query"), 1)).alias("q"))
    # one row per bucket: tables x 2 x the width at most
    blocks = counts.select("place", "bucket", F.ceil(F.col("r") / ROWS).alias("_r"), F.ceil(F.col("q") / QUERIES).alias("_q"))
    known = rows.join(F.broadcast(blocks.filter("_r > 0 and _q > 0")), ["place", "bucket"])

    def own(n: str) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.col(n))

    def each(n: str) -> Column:
        return F.sequence(F.lit(0).cast("long"), F.col(n) - 1)

    dealt = known.withColumn("_rs", F.when(F.col("query"), each("_r")).otherwise(F.array(own("_r")))).withColumn("_qs", F.when(F.col("query"), F.array(own("_q"))).otherwise(each("_q")))
    dealt = dealt.withColumn("row_block", F.explode("_rs")).withColumn("query_block", F.explode("_qs"))
    groups = dealt.select("place", "bucket", "row_block", "query_block", "vec_id", "vector", "query").groupBy("place", "bucket", "row_block", "query_block")
    return groups.applyInArrow(lambda t: best_of(t, k), FOUND)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best distinct rows of each query; tables may have found a row more than once."""
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # dense, so that a row found in several tables counts once; Spark keeps k per task before the shuffle
    few = found.withColumn("_d", F.dense_rank().over(order)).filter(F.col("_d") <= k).select("query_id", "vec_id", "score").distinct()
    return few.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(embeddings: DataFrame, k: int = K, every: int = EVERY, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """query_id, rank, vec_id, score: the rows found nearest to each row whose vec_id ``every`` divides."""
    rows = valid(embeddings)
    same = F.row_number().over(W.partitionBy("vector").orderBy("vec_id"))
    # ids after the first k + 1 of equal vectors are never among the k nearest; as queries they stay
    asks = F.col("vec_id") % every == 0
    least = rows.withColumn("_same", same).filter((F.col("_same") <= k + 1)).drop("_same")
    extra = rows.filter(asks).join(least.select("vec_id"), "vec_id", "left_anti")
    shown = least.unionByName(extra).mapInArrow(lambda b: placed(b, tables, probes, every), PLACED)
    found = staged(ranked(searched(staged(shown, "index"), k), k), "found")
    total = rows.count()
    short = staged(
        rows.filter(asks).join(found.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n")), F.col("vec_id") == F.col("query_id"), "left")
        .filter(F.coalesce("_n", F.lit(0)) < min(k, total - 1)).select("vec_id", "vector"), "short")
    if short.isEmpty():
        return found.select("query_id", "rank", "vec_id", "score")
    one = least.withColumn("query", F.lit(False)).unionByName(short.withColumn("query", F.lit(True)))
    again = ranked(searched(one.withColumn("place", F.lit(0)).withColumn("bucket", F.lit(0)), k), k)
    kept = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti")
    return kept.unionByName(again).select("query_id", "rank", "vec_id", "score")


def digest(embeddings: DataFrame) -> DataFrame:
    return nearest(embeddings)

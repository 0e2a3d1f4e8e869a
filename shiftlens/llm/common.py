"""What the operators share: the shared work folder, staged tables, and joins that no key can skew."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shiftlens.sources.staging import shared_folder

#: Keys with more than this share of all rows are joined by broadcast: there are at most 10,000 of them at any size.
HOT_SHARE = 1e-4
#: Rows that a broadcast may hold; beyond, the join shuffles.
BROADCAST_ROWS = 200_000
#: Rows of one Arrow batch, so that a batch of long texts stays small.
ARROW_ROWS = 500


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the storage that all executors share."""
    return f"{shared_folder(spark)}/shiftlens-llm-{uuid.uuid4().hex}/{name}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table: cuts the lineage and survives the loss of executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to ARROW_ROWS rows; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int = ARROW_ROWS) -> Iterator[None]:
    """Arrow batches of ``rows`` rows for the frames that are planned inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def checked(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` (cheap to compute, such as a staged table) for broadcast if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def attach(rows: DataFrame, facts: DataFrame, key: str, count: str, total: int, spread: Column) -> DataFrame:
    """Left join of ``rows`` with ``facts`` (one row per ``key``, ``count`` rows of it in ``rows``).

    Keys with at least HOT_SHARE of ``total`` come by broadcast, at most 1 / HOT_SHARE of them; the
    others shuffle, and the rows already served are dealt out by ``spread``.  Returns the columns of
    both; a row without facts has nulls.  ``facts`` is read twice, so stage it.
    """
    values = [c for c in facts.columns if c != key]
    fact = F.struct(*[F.col(c) for c in values])
    hot = F.col(count) >= F.lit(total * HOT_SHARE)
    many = facts.filter(hot).select(F.col(key).alias("_k"), fact.alias("_many"))
    few = facts.filter(~hot).select(F.col(key).alias("_key"), F.lit(0).alias("_lane"), fact.alias("_few"))
    known = rows.join(F.broadcast(many), F.col(key).eqNullSafe(F.col("_k")), "left").drop("_k")
    done = F.col("_many").isNotNull() | F.col(key).isNull()
    dealt = known.withColumn("_lane_r", F.when(done, F.pmod(F.xxhash64(spread), F.lit(1 << 20)).cast("int") + 1).otherwise(0))
    joined = dealt.join(few, (F.col(key).eqNullSafe(F.col("_key"))) & (F.col("_lane_r") == F.col("_lane")), "left")
    out = F.coalesce("_many", "_few")
    return joined.select(*[F.col(c) for c in rows.columns], *[out[c].alias(c) for c in values])


def numbered(df: DataFrame, *order: Column, to: str = "_n") -> DataFrame:
    """Add the position of each row, from 0, in the order over all rows, without one task for all.

    Ranges are numbered on their own; the sizes of the ranges, a row per task, give the offsets.
    """
    ranges = staged(df.repartitionByRange(*order).withColumn("_span", F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy("_span").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select("_span", (F.sum("_size").over(W.orderBy("_span")) - F.col("_size")).alias("_offset"))
    own = F.row_number().over(W.partitionBy("_span").orderBy(*order)) - 1
    return (
        ranges.withColumn("_own", own).join(F.broadcast(offsets), "_span")
        .withColumn(to, (F.col("_own") + F.col("_offset")).cast("long")).drop("_span", "_own", "_offset")
    )

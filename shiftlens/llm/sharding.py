"""Sharding by sampled splitters into shards of near equal bytes.

A size-weighted sample of the keys (a hash of the text, so that equal texts are neighbours) gives
quantile boundaries of many more ranges than shards.  Records are put into ranges, and the exact
bytes of each range are summed.  A range that is overfull is cut again by a sample of its own, at
last between rows of one text.  Ranges then go to shards, largest first, each to the emptiest shard,
so a group of equal texts stays in one shard unless it is larger than a shard.

Edge cases: a null text has size 1 and the checksum of no bytes, and shares its group with the empty
text; rows of equal doc_id and text are told apart by their place in the staged table; an empty table
gives no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlens.llm.common import numbered, small_batches, staged

SHARDS = 8
#: Ranges for each shard at first, and sampled keys for each range: what the driver holds is shards x both.
RANGES, SAMPLES = 32, 24
#: A range is overfull above this many times the planned bytes of a range.
OVERFULL = 3.0
KEYS = ("_g", "_d", "_m")
LEAST = -(1 << 63)


def places(bounds: np.ndarray, keys: Sequence[np.ndarray]) -> np.ndarray:
    """How many of the sorted ``bounds`` (rows of keys) are at or below each key, compared column by column."""
    low = np.searchsorted(bounds[:, 0], keys[0], "left")
    high = np.searchsorted(bounds[:, 0], keys[0], "right")
    if bounds.shape[1] == 1:
        return high
    tied = np.flatnonzero(low < high)
    out = low.copy()
    for at in np.unique(low[tied]):
        rows = tied[low[tied] == at]
        out[rows] += places(bounds[at : high[rows[0]], 1:], [k[rows] for k in keys[1:]])
    return out


def ranged(keyed: DataFrame, bounds: np.ndarray) -> DataFrame:
    """Add the range of each row."""

    @F.pandas_udf("int")
    def place(g: pd.Series, d: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series(places(bounds, [x.to_numpy() for x in (g, d, m)]).astype("int32"))

    if not len(bounds):
        return keyed.withColumn("_range", F.lit(0))
    return keyed.withColumn("_range", place(*[F.col(k) for k in KEYS]))


def splitters(sample: pd.DataFrame, n: int) -> list[tuple]:
    """Up to n - 1 keys that cut the weighted sample into ranges of about equal weight."""
    ordered = sample.sort_values(list(KEYS))
    upto = ordered["_weight"].cumsum().to_numpy()
    if not len(upto):
        return []
    at = np.searchsorted(upto, upto[-1] * np.arange(1, n) / n)
    return sorted({tuple(int(x) for x in row) for row in ordered[list(KEYS)].to_numpy()[at]})


def drawn(rows: DataFrame, rate, *key: str) -> pd.DataFrame:
    """The rows whose hash lies below ``rate`` times their size, each weighted by what it stands for."""
    chance = F.least(F.lit(1.0), F.col("size") * rate)
    coin = F.pmod(F.xxhash64(F.lit("splitters"), *KEYS), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return rows.filter(coin < chance).select(*key, *KEYS, (F.col("size") / chance).alias("_weight")).toPandas()


def boundaries(keyed: DataFrame, shards: int) -> np.ndarray:
    """Sorted first keys of the ranges after the first."""
    total = keyed.agg(F.sum("size")).first()[0] or 0
    ranges = shards * RANGES
    per_range = max(total / ranges, 1)
    sample = drawn(keyed, F.lit(ranges * SAMPLES / max(total, 1)))
    # between texts only: a range starts before all rows of its first text
    found = {(g, LEAST, LEAST) for g, _, _ in splitters(sample, ranges)}
    by_range = ranged(keyed, table(found)).groupBy("_range")
    full = by_range.agg(F.sum("size").alias("bytes"), F.min("_g").alias("low"), F.max("_g").alias("high"))
    for r in full.filter(F.col("bytes") > OVERFULL * per_range).collect():
        own = ranged(keyed, table(found)).filter(F.col("_range") == r["_range"])
        more = drawn(own, F.lit(RANGES * SAMPLES / r["bytes"]))
        cuts = splitters(more, max(2, round(r["bytes"] / per_range)))
        groups = {(x, LEAST, LEAST) for g, _, _ in cuts for x in (g, g + 1) if r["low"] < x <= r["high"]}
        found |= groups
    whole = ranged(keyed, table(found)).groupBy("_range")
    full = whole.agg(F.sum("size").alias("bytes"), F.min("_g").alias("low"), F.max("_g").alias("high"))
    cut = set(found)
    for r in full.filter((F.col("bytes") > total / shards) & (F.col("low") == F.col("high"))).collect():
        own = keyed.filter(F.col("_g") == r["low"])
        cut |= set(splitters(drawn(own, F.lit(ranges * SAMPLES / r["bytes"])), max(2, round(r["bytes"] / per_range))))
    return table(cut)


def table(keys) -> np.ndarray:
    return np.array(sorted(keys), dtype="int64").reshape(-1, len(KEYS))


def packed(sizes: dict[int, int], shards: int) -> dict[int, int]:
    """Shard of each range: largest first, each to the shard with the fewest bytes."""
    heap, out = [(0, s) for s in range(shards)], {}
    for r, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        held, s = heapq.heappop(heap)
        out[r] = s
        heapq.heappush(heap, (held + size, s))
    return out


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = staged(
        docs.select(
            "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
            F.xxhash64(text).alias("_g"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("_d"),
            F.monotonically_increasing_id().alias("_m"),
        ), "keys",
    )
    placed = staged(ranged(keyed, boundaries(keyed, shards)), "ranged")
    sizes = placed.groupBy("_range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    shard_of = packed({r["_range"]: r["bytes"] for r in sizes}, shards)
    rows, filled, before = [], dict.fromkeys(range(shards), 0), 0
    for r in sorted(sizes, key=lambda r: r["_range"]):
        s = shard_of[r["_range"]]
        rows.append((r["_range"], s, filled[s] - before))
        filled[s] += r["n"]
        before += r["n"]
    ranges = spark.createDataFrame(rows, "_range int, shard int, _shift long")
    # positions over all rows, since a range of one large group would be too much for one task
    order = [F.col(c) for c in ("_range", *KEYS)]
    return (
        numbered(placed, *order).join(F.broadcast(ranges), "_range")
        .select("doc_id", "size", "text_crc32", "shard", (F.col("_n") + F.col("_shift")).cast("long").alias("slot"))
    )


def digest(docs: DataFrame) -> DataFrame:
    out = assign(docs)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

"""Order-dependent operators over long series without one task per series.

``lag``, running sums and as-of lookups need an order inside a key (a line).  A window partitioned
by the line alone would put a whole line, possibly a third of all rows, into one task.  Here each
series is cut into time chunks; the window runs inside (key, chunk), a one-row summary per chunk is
carried over to the next chunk, and the carry is joined back on (key, chunk), which is the
partitioning the window already has, so the large side is shuffled once.

A chunk that still holds too many rows is hot: it is cut again into one-second chunks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shiftlens.functions.columns import MINUTE, SECOND, floor_to

CHUNK = "chunk_us"


@dataclass(frozen=True)
class Chunking:
    """``width`` of a chunk, ``fine`` width of the pieces of a hot chunk, rows that make it hot."""

    width: int = 10 * MINUTE
    fine: int = SECOND
    hot_rows: int = 2_000_000
    split_hot: bool = True


def hot_chunks(df: DataFrame, keys: Sequence[str], us: str, c: Chunking) -> DataFrame:
    """(keys, base chunk) with more than ``hot_rows`` rows: at most total rows / hot_rows of them."""
    return (
        df.select(*keys, floor_to(F.col(us), c.width).alias("base_us"))
        .groupBy(*keys, "base_us")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > c.hot_rows)
        .select(*keys, "base_us", F.lit(True).alias("hot"))
    )


def assign_chunks(
    df: DataFrame, keys: Sequence[str], us: str, c: Chunking, hot: DataFrame | None = None
) -> DataFrame:
    """Add the chunk start of every row.  Order between chunks equals order in time."""
    base = floor_to(F.col(us), c.width)
    if not c.split_hot:
        return df.withColumn(CHUNK, base)
    if hot is None:
        hot = hot_chunks(df, keys, us, c)
    # The hot list is bounded by total rows / hot_rows (half a million rows for 10**12 samples).
    return (
        df.withColumn("base_us", base)
        .join(F.broadcast(hot), [*keys, "base_us"], "left")
        .withColumn(
            CHUNK, F.when(F.col("hot"), floor_to(F.col(us), c.fine)).otherwise(F.col("base_us"))
        )
        .drop("base_us", "hot")
    )


def explode_chunks(
    df: DataFrame, keys: Sequence[str], lo: str, hi: str, c: Chunking, hot: DataFrame | None
) -> DataFrame:
    """One row per chunk that the closed interval [lo, hi] touches."""
    out = df.withColumn(
        CHUNK,
        F.explode(
            F.sequence(floor_to(F.col(lo), c.width), floor_to(F.col(hi), c.width), F.lit(c.width))
        ),
    )
    if not c.split_hot or hot is None:
        return out
    fine_lo = floor_to(F.greatest(F.col(lo), F.col(CHUNK)), c.fine)
    fine_hi = floor_to(F.least(F.col(hi), F.col(CHUNK) + F.lit(c.width - 1)), c.fine)
    return (
        out.join(F.broadcast(hot.withColumnRenamed("base_us", CHUNK)), [*keys, CHUNK], "left")
        .withColumn(
            CHUNK,
            F.explode(
                F.when(F.col("hot"), F.sequence(fine_lo, fine_hi, F.lit(c.fine))).otherwise(
                    F.array(F.col(CHUNK))
                )
            ),
        )
        .drop("hot")
    )


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, str],
    chunk: str = CHUNK, forward: bool = False, scope: str | None = None,
) -> DataFrame:
    """Lag (or lead) of columns in series order.  ``values`` maps column -> output name.

    ``scope`` is a column that is constant inside a chunk; the lag does not cross its changes.
    """
    pick = F.struct(*[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])
    rank = F.struct(*[F.col(o) for o in order])
    inside = W.partitionBy(*keys, chunk).orderBy(*[F.col(o) for o in order])
    edge = F.min_by(pick, rank) if forward else F.max_by(pick, rank)
    outer = [*keys, scope] if scope else list(keys)
    series = W.partitionBy(*outer).orderBy(chunk)
    move = F.lead if forward else F.lag
    group = [*keys, chunk] + ([scope] if scope else [])
    carry = (
        df.groupBy(*group).agg(edge.alias("edge"))
        .withColumn("carry", move("edge").over(series))
        .select(*keys, chunk, "carry")
    )
    near = df.withColumn("near", move(pick).over(inside))
    joined = near.join(carry, [*keys, chunk], "left").withColumn("hit", F.coalesce("near", "carry"))
    for i, name in enumerate(values.values()):
        joined = joined.withColumn(name, F.col("hit")[f"v{i}"])
    return joined.drop("near", "carry", "hit")


def with_running_sums(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Mapping[str, Column],
    chunk: str = CHUNK, scope: str | None = None,
) -> DataFrame:
    """Running sums (current row included) per key, restarted when ``scope`` changes."""
    inside = (
        W.partitionBy(*keys, chunk).orderBy(*[F.col(o) for o in order])
        .rowsBetween(W.unboundedPreceding, 0)
    )
    outer = [*keys, scope] if scope else list(keys)
    before = W.partitionBy(*outer).orderBy(chunk).rowsBetween(W.unboundedPreceding, -1)
    group = [*keys, chunk] + ([scope] if scope else [])
    totals = df.groupBy(*group).agg(*[F.sum(v).alias(f"s_{k}") for k, v in sums.items()])
    carry = totals.select(
        *keys, chunk,
        *[F.coalesce(F.sum(f"s_{k}").over(before), F.lit(0)).alias(f"c_{k}") for k in sums],
    )
    local = df.select("*", *[F.sum(v).over(inside).alias(f"l_{k}") for k, v in sums.items()])
    out = local.join(carry, [*keys, chunk], "left")
    return out.select(
        *df.columns, *[(F.col(f"l_{k}") + F.col(f"c_{k}")).alias(k) for k in sums]
    )


def latest_start_asof(
    points: DataFrame, intervals: DataFrame, keys: Sequence[str], us: str, lo: str, hi: str,
    c: Chunking, carried: Sequence[str] = (), payload: Sequence[str] = (),
) -> DataFrame:
    """Attach to each point the interval with the latest start not after it (linear, no pairs).

    Intervals are cut to the chunks they touch, so the lookup never leaves (key, chunk).  The
    matched interval comes back as iv_lo / iv_hi (+ ``carried`` columns); points without one are
    dropped.  Callers apply the end test (closed or open).
    """
    hot = hot_chunks(points, keys, us, c) if c.split_hot else None
    pieces = explode_chunks(intervals, keys, lo, hi, c, hot)
    iv = F.struct(F.col(lo).alias("lo"), F.col(hi).alias("hi"), *[F.col(x) for x in carried])
    left = pieces.select(
        *keys, CHUNK, F.greatest(F.col(lo), F.col(CHUNK)).alias("at"), F.lit(0).alias("side"),
        F.col(lo).alias("began"), iv.alias("iv"),
        *[F.lit(None).cast(points.schema[x].dataType).alias(x) for x in payload],
    )
    right = assign_chunks(points, keys, us, c, hot).select(
        *keys, CHUNK, F.col(us).alias("at"), F.lit(1).alias("side"), F.lit(None).cast("long"),
        F.lit(None).cast(left.schema["iv"].dataType), *payload,
    )
    w = (
        W.partitionBy(*keys, CHUNK).orderBy("at", "side", "began")
        .rowsBetween(W.unboundedPreceding, 0)
    )
    return (
        left.union(right)
        .withColumn("iv", F.last("iv", ignorenulls=True).over(w))
        .filter((F.col("side") == 1) & F.col("iv").isNotNull())
        .select(
            *keys, F.col("at").alias(us), *payload, F.col("iv.lo").alias("iv_lo"),
            F.col("iv.hi").alias("iv_hi"), *[F.col(f"iv.{x}").alias(x) for x in carried],
        )
    )


def intervals_hit(
    intervals: DataFrame, points: DataFrame, ident: Sequence[str], keys: Sequence[str],
    us: str, lo: str, hi: str, c: Chunking,
) -> DataFrame:
    """Identities of the intervals [lo, hi) that contain at least one point (semi join, linear).

    Read backwards in time, the last point seen is the next point after an interval piece starts.
    """
    hot = hot_chunks(points, keys, us, c) if c.split_hot else None
    pieces = explode_chunks(intervals.filter(F.col(hi) > F.col(lo)), keys, lo, hi, c, hot)
    left = pieces.select(
        *keys, CHUNK, F.greatest(F.col(lo), F.col(CHUNK)).alias("at"), F.lit(0).alias("side"),
        F.lit(None).cast("long").alias("point"), F.col(hi).alias("until"), *ident,
    )
    right = assign_chunks(points, keys, us, c, hot).select(
        *keys, CHUNK, F.col(us).alias("at"), F.lit(1).alias("side"), F.col(us).alias("point"),
        F.lit(None).cast("long"),
        *[F.lit(None).cast(intervals.schema[x].dataType) for x in ident],
    )
    w = (
        W.partitionBy(*keys, CHUNK).orderBy(F.desc("at"), F.desc("side"))
        .rowsBetween(W.unboundedPreceding, 0)
    )
    return (
        left.union(right)
        .withColumn("next_point", F.last("point", ignorenulls=True).over(w))
        .filter((F.col("side") == 0) & (F.col("next_point") < F.col("until")))
        .select(*keys, *ident)
        .distinct()
    )


def exact_percentile(
    df: DataFrame, keys: Sequence[str], value: str, q: float, stage: Callable[[str, Callable[[], DataFrame]], DataFrame], bins: int = 1024
) -> DataFrame:
    """Exact interpolated percentile per key, without gathering or ordering a key in one task.

    The two ranks around the percentile are searched by range: a histogram of the range counts its rows in
    ``bins`` bins (combined on the map side), the bin that holds the rank becomes the range, and so on until
    the range is one value.  A range shrinks by a factor of ``bins`` each round; what leaves a round is one row
    per key and rank, which ``stage(name, make)`` keeps.  Bounds of all open ranges reach the scan as literals.
    """
    keys, v = list(keys), F.col(value)
    df = df.select(*keys, value)
    position = (F.col("total") - 1) * F.lit(q)
    ranks = F.explode(F.array_distinct(F.array(F.floor(position), F.ceil(position))))

    def begin() -> DataFrame:
        sums = df.groupBy(*keys).agg(F.count(value).alias("total"), F.min(value).alias("lo"), F.max(value).alias("hi"))
        return sums.filter("total > 0").select(*keys, "total", ranks.alias("rank"), F.lit(0).cast("long").alias("below"), "lo", "hi")

    def narrowed(state: DataFrame, low: float, high: float) -> DataFrame:
        ranges = state.filter("lo < hi")
        # halves, so that the width of any range is finite; every step of the formula is monotone in the value
        part = (v / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * bins
        cells = (
            df.filter(v.between(low, high)).join(F.broadcast(ranges), keys).filter(v.between(F.col("lo"), F.col("hi")))
            .groupBy(*keys, "rank", F.least(F.floor(part), F.lit(bins - 1)).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"))
        )
        lists = cells.groupBy(*keys, "rank").agg(F.array_sort(F.collect_list(F.struct("bin", "n", "lo", "hi"))).alias("cells"))
        wanted = F.col("rank") - F.col("below")

        def seek(found: Column, cell: Column) -> Column:
            here = F.struct(found["below"].alias("below"), F.lit(True).alias("done"), cell["lo"].alias("lo"), cell["hi"].alias("hi"))
            on = F.struct((found["below"] + cell["n"]).alias("below"), F.lit(False).alias("done"), found["lo"].alias("lo"), found["hi"].alias("hi"))
            return F.when(found["done"], found).when(found["below"] + cell["n"] > wanted, here).otherwise(on)

        none = F.lit(None).cast("double")
        start = F.struct(F.lit(0).cast("long").alias("below"), F.lit(False).alias("done"), none.alias("lo"), none.alias("hi"))
        picked = ranges.drop("lo", "hi").join(lists, [*keys, "rank"]).withColumn("f", F.aggregate("cells", start, seek))
        next_ = picked.select(*keys, "total", "rank", (F.col("below") + F.col("f.below")).alias("below"), "f.lo", "f.hi")
        return state.filter("lo >= hi").unionByName(next_)

    state, step = stage("0", begin), 0
    while (edge := state.filter("lo < hi").agg(F.min("lo"), F.max("hi")).first())[0] is not None:
        step += 1
        state = stage(str(step), lambda now=state, edge=edge: narrowed(now, *edge))
    lo, hi = F.min_by("lo", "rank"), F.max_by("lo", "rank")
    ends = state.groupBy(*keys).agg(lo.alias("lo"), hi.alias("hi"), F.first("total").alias("total"))
    return ends.select(*keys, (F.col("lo") + (F.col("hi") - F.col("lo")) * (position - F.floor(position))).alias("percentile"))

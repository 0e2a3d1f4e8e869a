"""Embedding near-deduplication with a pivot-permutation index.

A vector is described by the ``NEAREST`` reference points (pivots) nearest to it.  Near copies see almost
the same pivots, so two vectors are candidates if they share ``SHARED`` of them.  Each pivot has an inverted
list; pivots are ranked, rare ones first, and a vector is entered under its first NEAREST - SHARED + 1 only:
two vectors that share SHARED pivots meet in the list of the first one that they share, and only there are
they counted and compared.  The task of a list counts shared pivots from the descriptions alone and names
the members that have a candidate; their vectors are then brought to the list and compared in double
precision.  Out of a list come a spanning forest of its links and a number of links per member, never pairs.

Vectors equal in every component (0.0 and -0.0 count as equal) and label form a class, which is compared
once; its copies are counted, not expanded.  Pivots are drawn from a sample of at most 2 x PIVOT_BYTES of
distinct vectors, those of least hash; one that is nearer than ``APART`` to another is left out, so a large
group of near copies has one pivot, not many that it would see in random order.  Their number grows with the
square root of the rows, so lists stay short.  If fewer than 2 x NEAREST pivots are apart, and for vectors of
a length that is not the commonest, all vectors of a label share one list, which is exact.  Lists are cut into
blocks and pairs of blocks, so that no task holds a whole long list.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components, rows without label and
rows without vec_id are linked with nothing; vectors of different length are never linked; rows that repeat
a vec_id are judged by their own vectors; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlens.llm.common import arrow_rows, attach, staged
from shiftlens.llm.neardup import Forest, by_group, components, groups, runs

#: Least cosine that links.
COSINE = 0.98
#: Pivots of a description, and how many two candidates share.
NEAREST, SHARED = 12, 5
#: Pivots for a row count: this times its square root, at least LEAST, in at most so many bytes.
DENSITY, LEAST, PIVOT_BYTES = 4, 64, 1 << 24
#: Cosine above which a second pivot is left out.
APART = 0.9
#: Cosines this near the threshold are decided by exact summation.
DOUBT = 1e-9
#: Rows of one Arrow batch.
BATCH = 2000
READ = "vec_id long, mark long, dim int, key_a long, key_b long, vector binary"
LISTED = "id long, mark long, pivot int, near array<int>"
CROSSING = "bucket long, low int, high int, id long, side int, one boolean"
FOUND = "a long, b long, links long"


def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes with a 128-bit key; rows that take no part have neither."""
    for batch in batches:
        ids, labels, vectors = batch.columns
        keys, kept = [], []
        kind = "<f4" if pa.types.is_float32(vectors.type.value_type) else "<f8"
        for i in range(batch.num_rows):
            x = vectors[i].values if vectors[i].is_valid and ids[i].is_valid and labels[i].is_valid else None
            x = None if x is None or x.null_count else np.asarray(x, dtype=kind) + 0.0
            raw = None if x is None or not len(x) or not np.isfinite(x).all() or not x.any() else x.astype(kind).tobytes()
            kept.append(raw)
            keys.append((None, None, None) if raw is None else (len(x), *np.frombuffer(xxhash.xxh3_128_digest(raw), "<i8").tolist()))
        dim, a, b = zip(*keys, strict=True) if keys else ((), (), ())
        mark = pa.array([m if raw is not None else None for m, raw in zip(labels.to_pylist(), kept, strict=True)], pa.int64())
        yield pa.RecordBatch.from_arrays([ids, mark, pa.array(dim, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(kept, pa.binary())], [c.split()[0] for c in READ.split(", ")])


def units(raw: list[bytes], dim: int) -> np.ndarray:
    """The vectors as rows of length one, in double precision."""
    kind = "<f4" if len(raw[0]) == 4 * dim else "<f8"
    x = np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), dim).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def far_apart(sample: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` vectors of the sample, none nearer than APART to one taken before, rarely seen ones first."""
    kept = np.zeros((0, sample.shape[1]))
    for at in range(0, len(sample), 256):
        part = sample[at : at + 256]
        part = part[(part @ kept.T).max(axis=1, initial=-1.0) < APART]
        near, own = part @ part.T >= APART, []
        for i in range(len(part)):
            if not near[i, own].any():
                own.append(i)
        kept = np.concatenate([kept, part[own]])
        if len(kept) >= most:
            break
    kept = kept[:most]
    if len(kept) < 2 * NEAREST:
        return kept[:0]
    seen = np.bincount(nearest(sample[:2048], kept).ravel(), minlength=len(kept))
    return kept[np.argsort(seen, kind="stable")]


def nearest(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The ranks of the pivots nearest to each vector, ascending."""
    out = []
    step = max(1, (1 << 22) // len(pivots))
    for at in range(0, len(x), step):
        near = -(x[at : at + step] @ pivots.T)
        out.append(np.sort(np.argpartition(near, NEAREST - 1, axis=1)[:, :NEAREST], axis=1))
    return np.concatenate(out).astype(np.int32)


def entered(batches: Iterator[pa.RecordBatch], pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    """id, mark, pivot and description of each class (id, mark, dim, vector) under each of its first pivots."""
    for batch in batches:
        if not batch.num_rows:
            continue
        dims = batch.column(2).to_numpy()
        near = np.full((batch.num_rows, NEAREST), -1, dtype=np.int32)
        known = np.flatnonzero(dims == pivots.shape[1]) if len(pivots) else np.zeros(0, np.int64)
        if len(known):
            raw = batch.column(3).to_pylist()
            near[known] = nearest(units([raw[i] for i in known], pivots.shape[1]), pivots)
        lists = np.where(near[:, 0] < 0, 1, NEAREST - SHARED + 1)
        rows = np.repeat(np.arange(batch.num_rows), lists)
        place = np.arange(len(rows)) - np.repeat(np.cumsum(lists) - lists, lists)
        offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * NEAREST)
        described = pa.ListArray.from_arrays(offsets, pa.array(near[rows].ravel()))
        take = pa.array(rows)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(near[rows, place]), described], [c.split()[0] for c in LISTED.split(", ")])


def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The members of each list (of one block, or across two); a bucket is a hash of label and pivot, which two lists may share."""
    for group in runs(batches, 3):
        names = np.stack([group["mark"].to_numpy(), group["pivot"].to_numpy()])
        if (names == names[:, :1]).all():
            yield group
        else:
            for name in np.unique(names, axis=1).T:
                yield group.filter(pa.array((names == name[:, None]).all(axis=0)))


def in_common(near: np.ndarray, left: np.ndarray, right: np.ndarray, part: np.ndarray) -> np.ndarray:
    """How many of the pivots in ``part`` the rows in ``left`` and in ``right`` share, by products of indicator matrices."""
    out = np.zeros((len(left), len(right)), np.float32)
    _, at, times = np.unique(near[part], return_inverse=True, return_counts=True)
    rows, column = np.nonzero(part)[0], (np.cumsum(times > 1) - 1)[at]
    rows, column = rows[times[at] > 1], column[times[at] > 1]
    columns = int((times > 1).sum())
    width = max(1, min(columns, (1 << 22) // len(near)))
    for low in range(0, columns, width):
        here = (column >= low) & (column < low + width)
        has = np.zeros((len(near), width), np.float32)
        has[rows[here], column[here] - low] = 1
        out += has[left] @ has[right].T
    return out


def candidates(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows a, b of the pairs of a group that share enough pivots, the first of them the list's own."""
    side, ids, pivot = group["side"].to_numpy(), group["id"].to_numpy(), group["pivot"][0].as_py()
    near = np.stack(group["near"].combine_chunks().to_numpy(zero_copy_only=False))
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    one = not len(right) or group["one"][0].as_py()
    right = left if one else right
    if pivot < 0:
        fit = np.ones((len(left), len(right)), bool)
    else:
        earlier, others = (in_common(near, left, right, part) for part in (near < pivot, near >= pivot))
        fit = (earlier == 0) & (others >= SHARED)
    fit &= ids[left][:, None] < ids[right][None, :] if one else ids[left][:, None] != ids[right][None, :]
    a, b = np.nonzero(fit)
    return left[a], right[b]


def crossing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of each group that have a candidate."""
    names = [c.split()[0] for c in CROSSING.split(", ")]
    for group in lists(batches):
        asked = np.unique(np.concatenate(candidates(group))) if group.num_rows > 1 else []
        if len(asked):
            yield from group.select(names).take(pa.array(asked)).to_batches()


def exact(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether the cosine of two vectors reaches COSINE, by exactly rounded sums."""
    over, x2, y2 = (math.fsum(p) for p in (x * y, x * x, y * y))
    return over / math.sqrt(x2 * y2) >= COSINE


def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each group a spanning forest of its links (a, b), and per member the copies of its partners (a, links)."""
    for group in lists(batches):
        a, b = candidates(group)
        ids, weight, dims = (group[c].to_numpy() for c in ("id", "copies", "dim"))
        x = units(group["vector"].to_pylist(), int(dims[0]))
        cosine = np.concatenate([np.einsum("ij,ij->i", x[a[at : at + 4096]], x[b[at : at + 4096]]) for at in range(0, len(a), 4096)] or [np.zeros(0)])
        linked = cosine >= COSINE
        for i in np.flatnonzero(np.abs(cosine - COSINE) < DOUBT):
            linked[i] = exact(x[a[i]], x[b[i]])
        a, b = a[linked], b[linked]
        if not len(a):
            continue
        links = np.bincount(a, weight[b], len(ids)).astype(np.int64) + np.bincount(b, weight[a], len(ids)).astype(np.int64)
        forest, edges = Forest(), ([], [])
        for p, q in zip(ids[a].tolist(), ids[b].tolist(), strict=True):
            if forest.join(p, q):
                edges[0].append(min(p, q))
                edges[1].append(max(p, q))
        some = np.flatnonzero(links)
        columns = [pa.array([*edges[0], *ids[some]], pa.int64()), pa.array([*edges[1], *[None] * len(some)], pa.int64()), pa.array([*[None] * len(edges[0]), *links[some]], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b", "links"])


def pivots_of(classes: DataFrame, rows: int) -> np.ndarray:
    """The pivots for vectors of the commonest length, from the classes of least hash."""
    dim = classes.groupBy("dim").count().orderBy(F.col("count").desc(), "dim").first()
    if dim is None:
        return np.zeros((0, 0))
    most = min(max(LEAST, math.ceil(DENSITY * rows**0.5)), max(2 * NEAREST, PIVOT_BYTES // (8 * dim["dim"])))
    drawn = classes.filter(F.col("dim") == dim["dim"]).orderBy(F.xxhash64("key_a"), "key_b", "mark").select("vector").limit(2 * most)
    return far_apart(units([bytes(r.vector) for r in drawn.collect()], dim["dim"]), most)


def linked(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    with arrow_rows(spark, BATCH):
        label = F.when(F.col("label").isNotNull(), F.xxhash64("label"))
        rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.col("embedding").alias("embedding"))
        known = staged(rows.mapInArrow(read, READ), "vectors")
        named = known.withColumn("set", F.when(F.col("mark").isNotNull(), F.struct("mark", "dim", "key_a", "key_b")))
        per_set = named.filter("set is not null").groupBy("set").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"))
        numbered = per_set.select("set", "set.*", "least", "copies", "vector").withColumn("mark", F.xxhash64("mark", "dim"))
        classes = staged(numbered.withColumn("id", F.monotonically_increasing_id()), "classes")
        n = classes.count()
        pivots = spark.sparkContext.broadcast(pivots_of(classes, n))
        described = classes.select("id", "mark", "dim", "vector").mapInArrow(lambda batches: entered(batches, pivots.value), LISTED)
        listed = staged(described.withColumn("bucket", F.xxhash64("mark", "pivot")), "lists")

        sizes = listed.groupBy("bucket").agg(F.count(F.lit(1)).alias("in_bucket")).filter("in_bucket > 1")
        sizes = staged(sizes.withColumn("held", F.lit(0)), "sizes")
        entries = staged(attach(listed, sizes, "bucket", "in_bucket", listed.count(), F.col("id")).filter("in_bucket is not null"), "entries")
        asked = staged(groups(entries).mapInArrow(crossing, CROSSING), "asked")
        met = asked.join(listed.select("bucket", "id", "mark", "pivot", "near"), ["bucket", "id"])
        met = met.join(classes.select("id", "dim", "copies", "vector"), "id")
        met = by_group(met.select(*asked.columns, "mark", "pivot", "near", "dim", "copies", "vector"))
        found = staged(met.mapInArrow(compared, FOUND), "found")

        label_of = components(found.filter("b is not null").select("a", "b"))
    links = found.filter("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    own = classes.select("set", "copies", "id", "least")
    whole = own.join(label_of, F.col("id") == F.col("node"), "left").join(links, F.col("id") == F.col("a"), "left")
    whole = whole.select("set", "copies", "least", F.coalesce("label", "id").alias("label"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    whole = staged(whole, "whole")
    heads = staged(whole.groupBy("label").agg(F.min("least").alias("head"), F.count(F.lit(1)).alias("_classes")), "heads")
    reached = staged(attach(whole, heads, "label", "_classes", n, F.col("least")).select("set", "copies", "n_links", "head"), "reached")
    out = attach(named.select("vec_id", "set"), reached, "set", "copies", known.count(), F.col("vec_id"))
    component = F.coalesce("head", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))

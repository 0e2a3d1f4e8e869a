"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Every ``DEPTH``-byte string that starts at two places of the corpus is removed at all its places.
Suffixes are ordered only through ``DEPTH`` bytes, most significant digit first, and a group of one
is finished.  To order every suffix by every digit would move each byte of the corpus ``DEPTH``
times, so the digits are chosen by content:

1. The first digit of a suffix is the least hash of the ``GRAM``-byte strings in its first ``DEPTH``
   bytes.  Neighbouring suffixes mostly share it, so a stretch of them is one record.  Equal suffixes
   have equal digits; a digit that one stretch has alone is finished.
2. The second digit is the hash of all bytes of the stretch's suffixes.  Equal stretches are wholly
   repeated, which settles nearly all copies.
3. The rest, the ends of matches, are suffixes taken one by one; their last digit is the hash of
   their ``DEPTH`` bytes, and equal groups are exactly the repeated windows.

Copies within a batch are settled before the shuffle, so a passage of a third of all documents sends
one record per batch.  Digits that a sample shows to be frequent are dealt by both digits.

Edge cases: null and empty texts and texts of fewer than ``DEPTH`` bytes lose nothing; equal rows are
copies of each other; rows that repeat a doc_id with other texts are rows of their own; periodic
texts repeat themselves; an empty table gives no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlens.llm.common import arrow_rows, checked, small_batches, staged

DEPTH, GRAM = 200, 72
REACH = DEPTH - GRAM + 1
#: A first digit is frequent from this share of the sampled records on; one document in SAMPLE is sampled.
FREQUENT, SAMPLE = 1e-5, 64
#: Bytes of text that are hashed at once.
SLAB = 1 << 20
SLIM_ROWS = 20_000
STRETCHES = "kind int, first long, second long, doc_id long, text_hash long, start int, length int, weight int, periodic boolean"
SETTLED = "kind int, first long, doc_id long, text_hash long, start int, length int, weight int"
WINDOWS = "kind int, first long, last long, doc_id long, text_hash long, start int, length int, weight int"
RANGES = "doc_id long, text_hash long, starts array<int>, ends array<int>"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
COVERED, OPEN = 0, 1
KEY = ("doc_id", "text_hash")

BASE = np.uint64(0xD1342543DE82EF95)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
LETTERS = np.random.default_rng(200).integers(0, 1 << 64, 256, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Rolling:
    """Hashes of all strings of one width in a text, from sums of powers modulo 2**64."""

    def __init__(self):
        self.up, self.down = powers(BASE, 1), powers(INVERSE, 1)

    def __call__(self, data: np.ndarray, width: int) -> np.ndarray:
        n = len(data)
        if len(self.up) < n:
            self.up, self.down = powers(BASE, 2 * n), powers(INVERSE, 2 * n)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(LETTERS[data] * self.up[:n], out=total[1:])
        return mixed((total[width:] - total[:-width]) * self.down[: n - width + 1])


ROLLING = Rolling()


def least_in(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    size, least = 1, values
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    n = len(values) - width + 1
    return np.minimum(least[:n], least[width - size : width - size + n])


def stretches(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows that share their first digit, at most REACH long: start, length, first digit, and whether they may repeat themselves."""
    grams = ROLLING(data, GRAM)
    first = least_in(grams, REACH)
    new = np.ones(len(first), dtype=bool)
    new[1:] = first[1:] != first[:-1]
    long = ends - begins >= DEPTH
    begins, stops = begins[long], ends[long] - DEPTH + 1
    new[begins] = True
    # windows that lie in one text: +1 where they begin, -1 where they stop
    inside = np.zeros(len(first) + 1, dtype=np.int8)
    np.add.at(inside, begins, 1)
    np.subtract.at(inside, stops, 1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    starts = np.flatnonzero(new & inside)
    if not len(starts):
        return starts, starts, first[:0], new[:0]
    stop = np.minimum(np.append(starts[1:], len(first)), stops[np.searchsorted(begins, starts, "right") - 1])
    pieces = -(-(stop - starts) // REACH)
    if (pieces > 1).any():
        no = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts, stop = np.repeat(starts, pieces) + no * REACH, np.repeat(stop, pieces)
        stop = np.minimum(starts + REACH, stop)
    # a gram that starts twice among the grams of a stretch: its text may repeat itself
    digit = first[starts]
    # where two windows of a stretch follow each other and the first begins with the least gram, that gram recurs
    leads = np.concatenate([[0], np.cumsum(grams[: len(first)] == first)])
    return starts, stop - starts, digit, leads[stop - 1] > leads[starts]


def slabs(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]]:
    """Texts of about SLAB bytes at once: their columns after the text and their offset, the bytes, where each begins and ends.

    A longer text comes in parts that overlap by DEPTH - 1 bytes, so each window lies in one part.
    """
    rows: list[tuple] = []
    texts: list[bytes] = []
    held = 0

    def slab():
        ends = np.cumsum([len(t) for t in texts])
        return rows, np.frombuffer(b"".join(texts), dtype=np.uint8), np.concatenate([[0], ends[:-1]]), ends

    for batch in batches:
        for text, *rest in zip(*(batch.column(i) for i in range(columns)), strict=True):
            body, values = memoryview(text.as_buffer() or b""), tuple(x.as_py() for x in rest)
            for offset in range(0, max(1, len(body) - DEPTH + 1), SLAB):
                texts.append(bytes(body[offset : offset + SLAB + DEPTH - 1]))
                rows.append((*values, offset))
                held += len(texts[-1])
                if held >= SLAB:
                    yield slab()
                    rows, texts, held = [], [], 0
    if rows:
        yield slab()


def record(columns: list, schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def doc_columns(rows: list[tuple], owner: np.ndarray) -> list[pa.Array]:
    return [pa.array([r[i] for r in rows], pa.int64()).take(pa.array(owner)) for i in (0, 1)]


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches of all texts; those that a slab holds twice are covered, and one of them goes on with weight 2."""
    for rows, data, begins, ends in slabs(batches, 3):
        if len(data) < DEPTH:
            continue
        start, length, digit, periodic = stretches(data, begins, ends)
        if not len(start):
            continue
        view = memoryview(data)
        stop = (start + length + DEPTH - 1).tolist()
        second = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(start.tolist(), stop, strict=True)), dtype=np.uint64, count=len(start))
        order = np.lexsort((second, digit))
        same = (digit[order][1:] == digit[order][:-1]) & (second[order][1:] == second[order][:-1])
        copy = np.zeros(len(start), dtype=bool)
        copy[order[1:][same]] = True  # not the first of its kind
        twice = copy.copy()
        twice[order[:-1][same]] = True
        owner = np.searchsorted(ends, start, "right")
        offset = np.array([r[-1] for r in rows])
        at, first, second = start - begins[owner] + offset[owner], digit.view(np.int64), second.view(np.int64)
        weight = np.where(twice, 2, 1)
        for pick, kind in ((np.flatnonzero(twice), COVERED), (np.flatnonzero(~copy), OPEN)):
            if len(pick):
                yield record([np.full(len(pick), kind), first[pick], second[pick], *doc_columns(rows, owner[pick]), at[pick], length[pick], weight[pick], periodic[pick]], STRETCHES)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Sorted batches joined and cut so that rows with equal first ``keys`` columns stay together."""
    held: list[pa.RecordBatch] = []
    rows, wanted = 0, SLIM_ROWS
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < wanted:
            continue
        table = pa.concat_batches(held)
        columns = [table.column(i).fill_null(-(1 << 63)).to_numpy() for i in range(keys)]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        last = int(cuts[-1]) if len(cuts) else 0
        if last:
            yield table.slice(0, last)
        held = [table.slice(last)]
        rows = held[0].num_rows
        wanted = SLIM_ROWS + 2 * rows  # a large group is not joined again with every batch
    if rows:
        yield pa.concat_batches(held)


def totals(group: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """For each row the sum of the weights of its group."""
    return np.bincount(group, weights=weight)[group].astype(np.int64)


def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches sorted by both digits: equal ones are covered; those of a digit that others share stay open."""
    for whole in whole_groups(batches, 1):
        done = np.flatnonzero(whole.column(9).to_numpy() == COVERED)
        if len(done):
            yield record([np.full(len(done), COVERED), *(whole.column(i).take(pa.array(done)) for i in (0, 2, 3, 4, 5, 6))], SETTLED)
        b = whole.take(pa.array(np.flatnonzero(whole.column(9).to_numpy() == OPEN)))
        first, second = b.column(0).to_numpy(), b.column(1).to_numpy()
        weight, periodic = b.column(6).to_numpy(), b.column(7).to_numpy(zero_copy_only=False)
        frequent = b.column(8).to_numpy(zero_copy_only=False)
        new = np.ones(len(first), dtype=bool)
        new[1:] = first[1:] != first[:-1]
        by_first = np.cumsum(new) - 1
        new[1:] |= second[1:] != second[:-1]
        by_both = np.cumsum(new) - 1
        twice = totals(by_both, weight) > 1
        kinds = totals(by_first, new) > 1
        rows = {COVERED: np.flatnonzero(twice & (weight == 1)), OPEN: np.flatnonzero(new & (kinds | frequent | (periodic & ~twice)))}
        for kind, pick in rows.items():
            if len(pick):
                n = pa.array(pick)
                docs = [b.column(i).take(n) for i in (2, 3, 4, 5)]
                yield record([np.full(len(pick), kind), first[pick], *docs, np.where(twice[pick], 2, 1)], SETTLED)


def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of the open stretches of each text; those that a slab holds twice are covered."""
    for rows, data, begins, ends in slabs(batches, 4):
        hashes = ROLLING(data, DEPTH)
        listed = [(i, x) for i, r in enumerate(rows) for x in r[2] if r[-1] <= x["start"] < r[-1] + SLAB]
        if not listed:
            continue
        offset = np.array([r[-1] for r in rows])
        owner = np.array([i for i, _ in listed])
        start = np.array([begins[i] + x["start"] - rows[i][-1] for i, x in listed])
        length = np.array([x["length"] for _, x in listed])
        no = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        at = np.repeat(start, length) + no
        first = np.repeat(np.array([x["first"] for _, x in listed]), length)
        weight = np.repeat(np.array([x["weight"] for _, x in listed]), length)
        owner, last = np.repeat(owner, length), hashes[at].view(np.int64)
        order = np.lexsort((last, first))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (first[order][1:] != first[order][:-1]) | (last[order][1:] != last[order][:-1])
        group = np.empty(len(order), dtype=np.int64)
        group[order] = np.cumsum(new) - 1
        twice = totals(group, weight) > 1
        lead = np.zeros(len(order), dtype=bool)
        lead[order[new]] = True
        at += offset[owner] - begins[owner]
        pick = np.flatnonzero(twice & (weight == 1))
        if len(pick):
            head = np.flatnonzero(np.concatenate([[True], (np.diff(at[pick]) != 1) | (np.diff(owner[pick]) != 0)]))
            run, size = pick[head], np.diff(np.append(head, len(pick)))
            yield record([np.full(len(run), COVERED), first[run], last[run], *doc_columns(rows, owner[run]), at[run], size, np.ones_like(run)], WINDOWS)
        pick = np.flatnonzero(lead)
        yield record([np.full(len(pick), OPEN), first[pick], last[pick], *doc_columns(rows, owner[pick]), at[pick], np.ones_like(pick), np.where(twice[pick], 2, 1)], WINDOWS)


def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows sorted by their digits: those of a group of weight 2 or more that are not covered yet."""
    for b in whole_groups(batches, 2):
        first, last, weight = (b.column(i).to_numpy() for i in (0, 1, 6))
        opened = b.column(7).to_numpy() == OPEN
        new = np.ones(len(first), dtype=bool)
        new[1:] = (first[1:] != first[:-1]) | (last[1:] != last[:-1])
        twice = totals(np.cumsum(new) - 1, weight * opened) > 1
        pick = np.flatnonzero(~opened | (twice & (weight == 1)))
        if len(pick):
            n = pa.array(pick)
            yield record([np.full(len(pick), COVERED), first[pick], *(b.column(i).take(n) for i in (2, 3, 4, 5)), np.ones_like(pick)], SETTLED)


def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The removed byte ranges of each text, from its covered stretches sorted by start."""
    for b in whole_groups(batches, 2):
        a, t = (b.column(i).fill_null(-(1 << 63)).to_numpy() for i in (0, 1))
        start, stop = b.column(2).to_numpy().astype(np.int64), b.column(2).to_numpy() + b.column(3).to_numpy().astype(np.int64) + DEPTH - 1
        doc = np.concatenate([[0], np.cumsum((a[1:] != a[:-1]) | (t[1:] != t[:-1]))])
        # texts one behind the other, so that the greatest end so far never reaches into the next text
        base = doc * (int(stop.max()) + DEPTH + 1)
        upto = np.maximum.accumulate(base + stop)
        new = np.ones(len(start), dtype=bool)
        new[1:] = (base + start)[1:] > upto[:-1]
        head = np.flatnonzero(new)
        tail = np.append(head[1:] - 1, len(start) - 1)
        offsets = np.concatenate([[0], np.flatnonzero(np.diff(doc[head])) + 1, [len(head)]])
        lead = pa.array(head[offsets[:-1]])
        lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x, pa.int32())) for x in (start[head], upto[tail] - base[tail])]
        yield pa.RecordBatch.from_arrays([b.column(0).take(lead), b.column(1).take(lead), *lists], ["doc_id", "text_hash", "starts", "ends"])


def kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc_id, text, starts, ends in zip(*(batch.column(i) for i in range(4)), strict=True):
            body, at, removed, digest = memoryview(text.as_buffer() or b""), 0, 0, hashlib.sha256()
            spans = list(zip(starts.as_py() or (), ends.as_py() or (), strict=True))
            for start, end in spans:
                digest.update(body[at:start])
                removed += end - start
                at = end
            digest.update(body[at:])
            out.append((doc_id.as_py(), len(body), removed, len(spans), digest.hexdigest()))
        if out:
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("body"))


def on_key(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on the key of a document row; ``right`` has one row per key and comes by broadcast while it is small."""
    right = right.withColumnsRenamed({k: f"_{k}" for k in KEY})
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_text_hash"))
    return left.join(checked(right), same, how)


def removed(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, starts, ends: the byte ranges that go, for the rows that lose any; staged."""
    spark, rows = docs.sparkSession, keyed(docs).select("body", *KEY)
    with arrow_rows(spark):
        some = rows.filter(F.pmod(F.xxhash64(*KEY), F.lit(SAMPLE)) == 0).mapInArrow(cut, STRETCHES)
        sampled = staged(some.groupBy("first").agg(F.count(F.lit(1)).alias("n")), "sampled")
        least = max(8, int((sampled.agg(F.sum("n")).first()[0] or 0) * FREQUENT))
        # at most 1 / FREQUENT rows
        frequent = sampled.filter(F.col("n") >= least).select(F.col("first").alias("_f"))
        known = rows.mapInArrow(cut, STRETCHES).join(F.broadcast(frequent), F.col("first") == F.col("_f"), "left").withColumn("frequent", F.col("_f").isNotNull())
        # what is covered already passes through, dealt by document
        lane = F.when(F.col("kind") == COVERED, F.col("doc_id")).when(F.col("frequent"), F.col("second")).otherwise(F.lit(0).cast("long"))
        dealt = known.withColumn("_lane", lane).repartition("first", "_lane").sortWithinPartitions("first", "second")
        settled = staged(dealt.select("first", "second", *KEY, "start", "length", "weight", "periodic", "frequent", "kind").mapInArrow(settle, SETTLED), "settled")
        todo = settled.filter(F.col("kind") == OPEN).groupBy(*KEY).agg(F.collect_list(F.struct("first", "start", "length", "weight")).alias("todo"))
        texts = on_key(rows, staged(todo, "todo"), "inner").select("body", *KEY, "todo")
        own = F.when(F.col("kind") == COVERED, F.col("doc_id")).otherwise(F.lit(0).cast("long"))
        ends = texts.mapInArrow(expand, WINDOWS).withColumn("_lane", own).repartition("first", "last", "_lane").sortWithinPartitions("first", "last")
        more = staged(ends.select("first", "last", *KEY, "start", "length", "weight", "kind").mapInArrow(repeated, SETTLED), "repeated")
    with arrow_rows(spark, SLIM_ROWS):
        covered = settled.filter(F.col("kind") == COVERED).unionByName(more).select(*KEY, "start", "length")
        return staged(covered.repartition(*KEY).sortWithinPartitions(*KEY, "start").mapInArrow(ranges, RANGES), "removed")


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of ``docs``."""
    gone = removed(docs)
    small_batches(docs.sparkSession)  # the caller runs what follows
    out = on_key(keyed(docs), gone, "left").select("doc_id", "body", "starts", "ends")
    return out.mapInArrow(kept_rows, RESULT)

"""MinHash near-deduplication with SuperMinHash signatures.

A document is the set of its distinct shingles of ``SHINGLE`` words.  Every shingle draws a random
permutation of the ``SLOTS`` slots and puts (level + fraction) into one slot per level; a slot keeps
the least value, and a document stops at the level where no slot can change.  Documents with equal
sets form a class.  Bands of the signature put classes into buckets, and two classes are linked only
after their full sets have been compared.

Only what links can change is compared.  Round one verifies, in each bucket, a maximal spanning forest
of the pairs whose signatures agree enough; round two takes the members with such a pair between
different components, brings their full sets to the task of each bucket, compares every such pair there
and keeps the links of a spanning forest.  So no table holds more rows than the buckets have members:
pairs that are refuted never leave their task.  "Enough" lies ``MARGIN`` standard deviations below the threshold, which each
caller gives in percent; the number of bands follows from it.  A pair of the least similarity that
links shares no bucket with probability ``MISSED`` at most and falls below the margin with
probability 3e-7.  Large buckets are cut into blocks and pairs of blocks, so no task holds more
than two blocks, which are bounded in shingles where full sets are compared.

Edge cases: a text of fewer words than a shingle is one shingle of all its words; null and empty
texts have no shingles and are linked with nothing; rows without doc_id take no part and are kept;
rows that repeat a doc_id are judged by their texts, a class having a number of its own and its least
doc_id as label only; an empty table gives no rows; columns other than doc_id and text are ignored, and pass through ``keep_one``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlens.llm.common import arrow_rows, attach, checked, staged

#: Words of a shingle, and the least similarity in percent that links two documents unless a caller says otherwise.
SHINGLE, PERCENT = 5, 85
SLOTS, ROWS, MARGIN, MISSED = 512, 5, 5.0, 1e-7
#: Classes of a bucket that are held in one block, and levels whose swaps are kept as a list.
BLOCK, LISTED = 1024, 16
#: Shingles that the full sets of one block hold.
BLOCK_SHINGLES = 1 << 21
#: Shingles that are signed and bytes of text that are hashed at once.
PORTION, SLAB = 1 << 16, 1 << 19
SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Pairs that are verified against one copy of a set.
FAN = 500
FRACTION = np.uint64(55)
SIGNED = "doc_id long, text_hash long, n int, set_a long, set_b long, sketch binary, heads array<long>"
PAIRS = "a long, b long"
CROSSING = "bucket long, low int, high int, id long, side int, one boolean"
SETS = "id long, shingles binary"
MULTIPLIER, GOLDEN = np.uint64(0x9E3779B97F4A7C55), np.uint64(0x9E3779B97F4A7C15)


def only_equal(percent: int) -> int:
    """Sets of up to this many shingles reach the threshold only when they are equal: the largest n with n / (n + 1) below it."""
    return (percent - 1) // (100 - percent)


def bands_of(percent: int) -> int:
    """Bands with which a pair at the threshold shares no bucket with probability MISSED at most."""
    bands = math.ceil(math.log(MISSED) / math.log1p(-((percent / 100) ** ROWS)))
    if bands * ROWS > SLOTS:
        raise ValueError(f"{SLOTS} slots are too few for {percent} percent")
    return bands


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose bits all depend on each other."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(text: bytes) -> Iterator[bytes]:
    """``text`` in pieces of about SLAB bytes that end before white space."""
    at = 0
    while len(text) - at > SLAB:
        gap = SPACE.search(text, at + SLAB)
        if gap is None:
            break
        yield text[at : gap.start()]
        at = gap.start()
    yield text[at:] if at else text


def slab_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all ``texts``, and how many each has."""
    data = np.frombuffer(b" ".join(texts).lower() + b" ", dtype=np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edge[::2], edge[1::2]
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    counts = np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)])))
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    sizes = ends - starts
    power = np.full(int(sizes.max()), MULTIPLIER, dtype=np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    first = np.cumsum(sizes) - sizes
    terms = data[~space].astype(np.uint64) + np.uint64(1)
    terms *= power[np.arange(len(terms)) - np.repeat(first, sizes)]
    return mixed(np.add.reduceat(terms, first) + sizes.astype(np.uint64)), counts


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all ``texts`` and the number of words before each text; A-Z count as a-z."""
    words, counts, owner = [], np.zeros(len(texts), dtype=np.int64), []
    slab: list[bytes] = []

    def flush():
        hashes, found = slab_hashes(slab)
        words.append(hashes)
        np.add.at(counts, owner, found)

    held = 0
    for i, text in enumerate(texts):
        for piece in pieces(text):
            slab.append(piece)
            owner.append(i)
            held += len(piece)
            if held >= SLAB:
                flush()
                slab, owner, held = [], [], 0
    if slab:
        flush()
    return np.concatenate(words) if words else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(counts)])


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, before = word_hashes(texts)
    runs = np.zeros(max(len(words) - SHINGLE + 1, 0), dtype=np.uint64)
    for i in range(SHINGLE):
        runs = mixed(runs * MULTIPLIER + words[i : len(words) - SHINGLE + 1 + i] + np.uint64(i + 1)) if len(runs) else runs
    out = []
    for start, end in zip(before[:-1], before[1:], strict=True):
        n = end - start
        if n >= SHINGLE:
            out.append(np.unique(runs[start : end - SHINGLE + 1]))
        elif n:
            out.append(np.array([xxhash.xxh3_64_intdigest(words[start:end].tobytes(), int(n))], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """SuperMinHash of each non-empty set: per slot the least (level, fraction), packed into 64 bits."""
    docs = len(sets)
    sizes = np.fromiter(map(len, sets), dtype=np.int64, count=docs)
    seed, owner = np.concatenate(sets), np.repeat(np.arange(docs), sizes)
    least = np.full((docs, SLOTS), np.iinfo(np.uint64).max, dtype=np.uint64)
    flat, moved, order = least.reshape(-1), [], None
    steps = np.arange(1, SLOTS + 1, dtype=np.uint64) * GOLDEN
    for level in range(SLOTS):
        draw = mixed(seed + steps[level])
        pick = (level + (mixed(draw) >> np.uint64(32)) * np.uint64(SLOTS - level) // np.uint64(1 << 32)).astype(np.int64)
        if level < LISTED:
            # the slot that stands at ``pick``, and the one at ``level``, which moves there
            slot, shift = pick.copy(), np.full(len(pick), level)
            for place, value in moved:
                np.copyto(slot, value, where=place == pick)
                np.copyto(shift, value, where=place == level)
            moved.append((pick, shift))
        else:
            rows = np.arange(len(seed))
            if order is None:
                order = np.tile(np.arange(SLOTS, dtype=np.int16), (len(seed), 1))
                for i, (place, value) in enumerate(moved):
                    order[rows, place] = value
            slot = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[:, level]
        value = (np.uint64(level) << FRACTION) | (draw >> (np.uint64(64) - FRACTION))
        at = owner * SLOTS + slot
        better = value < flat[at]
        np.minimum.at(flat, at[better], value[better])
        done = least.max(axis=1) < np.uint64(level + 1) << FRACTION if level + 1 < SLOTS else np.ones(docs, bool)
        if done.all():
            break
        live = ~done[owner]
        if not live.all():
            seed, owner = seed[live], owner[live]
            moved = [(p[live], v[live]) for p, v in moved] if order is None else moved
            order = None if order is None else order[live]
    return least


def sketch(signature: np.ndarray, bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Four bits of each slot, packed, and the bucket of each band."""
    slots = mixed(signature)
    low = (slots & np.uint64(15)).astype(np.uint8)
    key = np.zeros((len(signature), bands), dtype=np.uint64)
    for r in range(ROWS):
        key = mixed(key * MULTIPLIER + slots[:, r : bands * ROWS : ROWS])
    return low[:, ::2] << 4 | low[:, 1::2], mixed(key + np.arange(bands, dtype=np.uint64)).view(np.int64)


def signature_of_all(sets: list[np.ndarray]) -> np.ndarray:
    """Signatures by portions; a large set is signed in parts, whose slot-wise least is its signature."""
    out = np.full((len(sets), SLOTS), np.iinfo(np.uint64).max, dtype=np.uint64)
    some: list[tuple[int, np.ndarray]] = []
    held = 0

    def flush():
        for (i, _), signature in zip(some, signatures([x for _, x in some]), strict=True):
            np.minimum(out[i], signature, out=out[i])

    for i, whole in enumerate(sets):
        for at in range(0, len(whole), PORTION):
            part = whole[at : at + PORTION]
            some.append((i, part))
            held += len(part)
            if held >= PORTION:
                flush()
                some, held = [], 0
    if some:
        flush()
    return out


def signed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [(x.as_buffer() or b"") for x in batch.column(2).cast(pa.binary())]
        sets = shingle_sets([bytes(t) for t in texts])
        whole = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
        ids = np.frombuffer(b"".join(whole), dtype="<i8").reshape(-1, 2)
        big = [i for i, s in enumerate(sets) if len(s) > only_equal(percent)]
        packed: list[bytes | None] = [None] * len(sets)
        heads: list[np.ndarray | None] = [None] * len(sets)
        if big:
            low, buckets = sketch(signature_of_all([sets[i] for i in big]), bands_of(percent))
            for k, i in enumerate(big):
                packed[i], heads[i] = low[k].tobytes(), buckets[k]
        columns = [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int32()), pa.array(ids[:, 0]), pa.array(ids[:, 1]), pa.array(packed, pa.binary()), pa.array(heads, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n", "set_a", "set_b", "sketch", "heads"])


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of the rows with equal first ``keys`` columns, from sorted batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy() for i in range(keys)]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            key = tuple(c[start] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def agreement(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Blocks of rows of the matrix of equal slots between two sets of sketches, and where each begins."""
    step = max(1, (1 << 23) // max(1, len(right) * SLOTS))
    for at in range(0, len(left), step):
        yield at, (left[at : at + step, None, :] == right[None, :, :]).sum(axis=2, dtype=np.int32)


def slots_of(column: pa.ChunkedArray) -> np.ndarray:
    packed = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), SLOTS // 2)
    out = np.empty((len(packed), SLOTS), dtype=np.uint8)
    out[:, ::2], out[:, 1::2] = packed >> 4, packed & 15
    return out


def enough(percent: int) -> float:
    """Equal slots from which a pair may reach the threshold: chance makes one in 16 of the others equal."""
    p = percent / 100 + (1 - percent / 100) / 16
    return SLOTS * p - MARGIN * (SLOTS * p * (1 - p)) ** 0.5


class Forest:
    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def near_pairs(group: pa.Table, percent: int) -> tuple[np.ndarray, ...]:
    """Rows a, b and equal slots of the pairs in a group (of one block, or across two) that may be linked."""
    side = group["side"].to_numpy()
    slots = slots_of(group["sketch"])
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    one = not len(right) or group["one"][0].as_py()
    right = left if one else right
    found: list[list[np.ndarray]] = [[], [], []]
    for at, equal in agreement(slots[left], slots[right]):
        rows, columns = np.nonzero(equal >= enough(percent))
        for x, y in zip(found, (left[at + rows], right[columns], equal[rows, columns]), strict=True):
            x.append(y)
    a, b, equal = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)
    ids = group["id"].to_numpy()
    keep = ids[a] < ids[b] if one else ids[a] != ids[b]
    return a[keep], b[keep], equal[keep]


def pairs_batch(a: list, b: list) -> pa.RecordBatch:
    low, high = np.minimum(a, b), np.maximum(a, b)
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(low, "i8")), pa.array(np.asarray(high, "i8"))], ["a", "b"])


def forest_pairs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """A maximal spanning forest of the pairs of each group."""
    for group in runs(batches, 3):
        if group.num_rows < 2:
            continue
        a, b, equal = near_pairs(group, percent)
        ids, forest, out = group["id"].to_numpy(), Forest(), ([], [])
        order = np.lexsort((np.maximum(ids[a], ids[b]), np.minimum(ids[a], ids[b]), -equal))
        for x, y in zip(ids[a[order]].tolist(), ids[b[order]].tolist(), strict=True):
            if forest.join(x, y):
                out[0].append(x)
                out[1].append(y)
        if out[0]:
            yield pairs_batch(*out)


def apart(group: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the near pairs of a group between different components, each in the first band that both share."""
    label = group["label"].to_numpy()
    if group.num_rows < 2 or (label == label[0]).all():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b, _ = near_pairs(group, percent)
    other = label[a] != label[b]
    a, b = a[other], b[other]
    if len(a):
        heads = np.stack(group["heads"].combine_chunks().to_numpy(zero_copy_only=False))
        bucket, own = group["bucket"][0].as_py(), np.zeros(len(a), bool)
        for at in range(0, len(a), PORTION):
            same = heads[a[at : at + PORTION]] == heads[b[at : at + PORTION]]
            own[at : at + PORTION] = heads[a[at : at + PORTION], same.argmax(axis=1)] == bucket
        a, b = a[own], b[own]
    return a, b


def crossing(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The members of each group that have a near pair between different components."""
    names = [c.split()[0] for c in CROSSING.split(", ")]
    for group in runs(batches, 3):
        asked = np.unique(np.concatenate(apart(group, percent)))
        if len(asked):
            yield from group.select(names).take(pa.array(asked)).to_batches()


def crossing_links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the pairs of each group whose full sets reach the threshold."""
    for group in runs(batches, 3):
        a, b = apart(group, percent)
        sets = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in group["shingles"]]
        sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
        able = 100 * np.minimum(sizes[a], sizes[b]) >= percent * np.maximum(sizes[a], sizes[b])
        a, b = a[able], b[able]
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        label, forest, out = group["label"].to_numpy(), Forest(), ([], [])
        ids = group["id"].to_numpy()
        cuts = np.flatnonzero(np.diff(a, prepend=-1, append=-1)) if len(a) else []
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            row, home = a[start], forest.root(int(label[a[start]]))
            partners = [int(x) for x in b[start:end] if forest.root(int(label[x])) != home]
            if not partners:
                continue
            own, joined = sets[row], np.concatenate([sets[x] for x in partners])
            place = np.minimum(np.searchsorted(own, joined), len(own) - 1)
            inter = np.add.reduceat((own[place] == joined).astype(np.int64), np.cumsum(sizes[partners]) - sizes[partners])
            linked = 100 * inter >= percent * (sizes[row] + sizes[partners] - inter)
            for x in np.asarray(partners)[linked].tolist():
                if forest.join(int(label[row]), int(label[x])):
                    out[0].append(ids[row])
                    out[1].append(ids[x])
        if out[0]:
            yield pairs_batch(*out)


def members(classes: DataFrame, bands: int) -> DataFrame:
    """bucket, id, in_bucket (classes) and held (their shingles) for the buckets of two classes or more, staged."""
    rows = classes.filter("heads is not null").select("id", "n", F.explode("heads").alias("bucket"))
    counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("in_bucket"), F.sum("n").alias("held")).filter("in_bucket > 1")
    shared = staged(counts, "buckets")
    total = classes.count() * bands
    return staged(attach(rows.drop("n"), shared, "bucket", "in_bucket", total, F.col("id")).filter("in_bucket is not null"), "members")


def groups(rows: DataFrame, sets: bool = False) -> DataFrame:
    """Members dealt to pairs of blocks of their bucket, sorted by bucket and pair; ``sets``: the blocks suit full sets."""
    blocks = F.ceil(F.col("in_bucket") / BLOCK).cast("int")
    blocks = F.greatest(blocks, F.ceil(F.col("held") / BLOCK_SHINGLES).cast("int")) if sets else blocks
    own = F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("_blocks") - 1)
    dealt = rows.withColumn("_blocks", blocks).withColumn("_own", own).withColumn("_with", F.explode(every))
    low, high = F.least("_own", "_with"), F.greatest("_own", "_with")
    dealt = dealt.withColumn("low", low).withColumn("high", high).withColumn("side", (F.col("_own") != low).cast("int")).withColumn("one", F.col("low") == F.col("high"))
    names = ["bucket", "low", "high", "id", "side", "one", *[c for c in rows.columns if c not in ("bucket", "id", "in_bucket", "held")]]
    return by_group(dealt.select(*names))


def by_group(dealt: DataFrame) -> DataFrame:
    return dealt.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")


def set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = shingle_sets([bytes(x.as_buffer() or b"") for x in batch.column(1).cast(pa.binary())])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "shingles"])


def compared(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs whose full sets reach the threshold; a leader's set comes before those of its partners."""
    now, own = None, np.zeros(0, np.uint64)
    for batch in batches:
        out: tuple[list[int], list[int]] = ([], [])
        for a, lane, b, raw in zip(*(batch.column(i) for i in range(4)), strict=True):
            other = np.frombuffer(raw.as_buffer(), dtype=np.uint64)
            if b.as_py() is None:
                now, own = (a.as_py(), lane.as_py()), other
                continue
            if now != (a.as_py(), lane.as_py()):
                raise ValueError(f"no set of class {a.as_py()}")
            both = np.concatenate([own, other])
            both.sort()
            inter = int((both[1:] == both[:-1]).sum())
            if 100 * inter >= percent * (len(own) + len(other) - inter):
                out[0].append(now[0])
                out[1].append(b.as_py())
        if out[0]:
            yield pairs_batch(*out)


def sets_of(ids: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """id and shingles of the classes in ``ids``, staged."""
    asked = staged(ids.distinct().join(classes.select("id", "least"), "id").select("id", "least.*"), "asked")
    # doc_id and text hash: a doc_id that two texts share would give both sets to one class
    texts = docs.join(checked(asked), ["doc_id", "text_hash"]).select("id", "text")
    return staged(texts.mapInArrow(set_rows, SETS), "sets")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` of class numbers (a, b; staged) that reach the threshold on their full sets."""
    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("id")), classes, docs)
    degree = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("_d"))
    lanes = F.ceil(F.col("_d") / FAN).cast("int")
    fans = degree.select("a", lanes.alias("_lanes"))
    leaders = fans.join(sets, F.col("a") == F.col("id")).withColumn("lane", F.explode(F.sequence(F.lit(0), F.col("_lanes") - 1)))
    dealt = pairs.join(fans, "a").withColumn("lane", F.pmod(F.xxhash64("b"), F.col("_lanes")).cast("int"))
    partners = dealt.join(sets, F.col("b") == F.col("id")).select("a", "lane", "b", "shingles")
    rows = leaders.select("a", "lane", F.lit(None).cast("long").alias("b"), "shingles").unionByName(partners)
    ordered = rows.repartition("a", "lane").sortWithinPartitions("a", "lane", F.col("b").asc_nulls_first())
    return ordered.mapInArrow(lambda batches: compared(batches, percent), PAIRS)


def forest_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task as stars around the least node of each component."""
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
    nodes = [x for x in forest.up if forest.root(x) != x]
    for at in range(0, len(nodes), 10_000):
        part = nodes[at : at + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array([forest.root(x) for x in part], pa.int64()), pa.array(part, pa.int64())], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """node, label: the least node that each node of ``links`` (a, b) reaches; the labels themselves are left out.

    Union-find within tasks turns links into stars; rounds of large-star and small-star join the
    stars of different tasks until nothing changes.  A node of many links is served by broadcast.
    """
    stars = staged(links.mapInArrow(forest_edges, PAIRS), "stars")
    before = None
    while True:
        state = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return stars.select(F.col("b").alias("node"), F.col("a").alias("label"))
        before = state
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"), F.count(F.lit(1)).alias("_n")), "least")
        large = attach(both.filter("b > a"), least, "a", "_n", 2 * state[0], F.col("b")).select(F.col("m").alias("a"), "b")
        large = staged(large.filter("a <> b").distinct(), "large")
        # each node to its least neighbour, and its other smaller neighbours too
        low = staged(large.groupBy("b").agg(F.min("a").alias("m"), F.count(F.lit(1)).alias("_n")), "low")
        small = attach(large, low, "b", "_n", state[0], F.col("a"))
        pairs = F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("b").alias("b")), F.struct(F.col("m").alias("a"), F.col("a").alias("b"))))
        stars = staged(small.select(pairs.alias("_p")).select("_p.a", "_p.b").filter("a <> b").distinct(), "stars")


def labelled(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, text_hash, n, least for every row of ``docs``: the least (doc_id, text_hash) of the row's component.

    ``least`` is null where a row has no doc_id or no shingles.
    """
    with arrow_rows(docs.sparkSession):
        return classified(docs, percent)


def classified(docs: DataFrame, percent: int) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    sign = staged(rows.mapInArrow(lambda batches: signed(batches, percent), SIGNED), "signed")
    known = sign.withColumn("set", F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.struct("set_a", "set_b")))
    least = F.min(F.struct("doc_id", "text_hash")).alias("least")
    per_set = known.filter("set is not null").groupBy("set").agg(least, F.count(F.lit(1)).alias("rows"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("heads").alias("heads"))
    classes = staged(per_set.withColumn("id", F.monotonically_increasing_id()), "classes")
    listed = members(classes, bands_of(percent))
    shown = classes.filter("heads is not null").select("id", "sketch", "heads")

    forest = listed.join(shown.select("id", "sketch"), "id")
    tried = staged(groups(forest).mapInArrow(lambda batches: forest_pairs(batches, percent), PAIRS).distinct(), "tried")
    links = staged(verified(tried, classes, rows, percent), "links")
    label = components(links)
    named = shown.join(label, F.col("id") == F.col("node"), "left").select("id", "sketch", "heads", F.coalesce("label", "id").alias("label"))
    rest = groups(listed.join(named, "id"), sets=True)
    asked = staged(rest.mapInArrow(lambda batches: crossing(batches, percent), CROSSING), "crossing")
    if not asked.isEmpty():
        full = sets_of(asked.select("id"), classes, rows)
        rest = by_group(asked.join(named, "id").join(full, "id").select(*asked.columns, "sketch", "heads", "label", "shingles"))
        more = rest.mapInArrow(lambda batches: crossing_links(batches, percent), PAIRS)
        label = components(links.unionByName(staged(more, "more")))
    found = classes.select("set", "rows", "id", F.col("least").alias("own")).join(label, F.col("id") == F.col("node"), "left")
    found = staged(found.select("set", "rows", "id", "own", F.coalesce("label", "id").alias("label")), "found")
    heads = staged(found.groupBy("label").agg(F.min("own").alias("least"), F.count(F.lit(1)).alias("_classes")), "heads")
    reached = attach(found, heads, "label", "_classes", found.count(), F.col("id"))
    reached = staged(reached.select("set", "rows", "least"), "reached")
    return attach(known.select("doc_id", "text_hash", "n", "set"), reached, "set", "rows", sign.count(), F.col("doc_id")).select("doc_id", "text_hash", "n", "least")


def grouped(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``; ``percent`` is the least similarity that links."""
    out = labelled(docs, percent)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least.doc_id", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group: that of the smallest doc_id, and of its texts the one of the least hash.

    Of rows that are equal in doc_id and text one stays, unless they take no part (no doc_id, no words).
    """
    key = ["doc_id", "text_hash"]
    first = F.struct(*key) == F.col("least")
    counts = labelled(docs, percent).filter("least is not null").groupBy(*key).agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("copies"))
    taken = staged(counts.filter("not first or copies > 1"), "taken")
    rows = docs.select(F.struct("*").alias("row"))
    same = (F.col("row.doc_id").cast("long") == F.col("doc_id")) & (F.xxhash64("row.text") == F.col("text_hash"))
    left = rows.join(checked(taken.select(*key)), same, "left_anti").select("row.*")
    repeated = taken.filter("first").select(*key)
    if repeated.isEmpty():
        return left
    one = rows.join(checked(repeated), same).groupBy(*key).agg(F.first("row").alias("row"))
    return left.unionByName(one.select("row.*"))

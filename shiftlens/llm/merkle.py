"""A Merkle manifest of a dataset, built by appends that carry the witness of every row along.

Each row of ``documents`` is a leaf.  Leaves of a source ascend by doc_id; runs of ``FAN`` nodes become
their parent until one node, the subroot, is left; the subroots, by source, become the root likewise.

Appends are aligned: a ``Frontier`` holds the open run of each level.  An appended node gets the left
siblings of its run as a partial witness at once; when its run is complete, every subtree of the run gets
the siblings on its right, and the parent is appended to the run above.  A block is an aligned subtree of
``BLOCK`` leaves, which one task appends; the block roots are appended as the leaves of the next tier, and
so on, a job per tier, until each source is one node.  On the way down a block's root brings the witness
above it, and the block hands it to its members, so witnesses are stored a block, not a row.

``append`` adds rows that follow the earlier ones of their source: full blocks keep their roots, and only
blocks that got a node are read again, in every tier.

A leaf is the SHA-256 (lowercase hex) of doc_id, source, lang, n_chars and text, each ``-`` for null, else
the number of UTF-8 bytes, ``:`` and the value, so nulls, empty texts and shifted borders differ.  Rows
without source are one source that comes first, rows without doc_id come first in it; rows that repeat a
doc_id follow each other by their leaves, rows repeated whole in any order; a long text is hashed where it
is scanned and goes no further; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlens.llm.common import arrow_rows, attach, numbered, staged

#: Children of a node, levels of a block, and its leaves.
FAN, LEVELS = 16, 2
BLOCK = FAN**LEVELS
#: Rows of one Arrow batch: nodes are small.
BATCH = 5000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "key string, pos long, digest binary"
WITNESS = "key string, pos long, path array<binary>, subroot binary, root binary"
PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass
class Manifest:
    """``leaves`` (key, pos, digest, doc_id, claim), the block roots of each tier (key, pos, digest; the last has one node a source)
    and ``sources`` (key, n, last: rows and greatest doc_id)."""

    leaves: DataFrame
    tiers: list[DataFrame]
    sources: DataFrame


def sha(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def levels(n: int, most: int) -> int:
    """Levels above n nodes within one block of up to ``most`` levels."""
    height = 0
    while n > 1 and height < most:
        n, height = -(-n // FAN), height + 1
    return height


class Frontier:
    """Appends digests (hex); ``close`` gives the root of all, ``witness[i]`` the left and right siblings of node i by level."""

    def __init__(self, height: int):
        self.runs: list[list[bytes]] = [[] for _ in range(height + 1)]
        #: nodes appended before each subtree of the open runs
        self.first: list[list[int]] = [[] for _ in range(height + 1)]
        self.witness: list[list[bytes]] = []

    def append(self, digest: bytes) -> None:
        self.witness.append([])
        self.put(0, digest, len(self.witness) - 1)

    def put(self, level: int, digest: bytes, first: int) -> None:
        if level < len(self.runs) - 1:
            left = b"".join(self.runs[level])
            for path in self.witness[first:]:
                path.append(left)  # the part that is known while the run is open
        self.runs[level].append(digest)
        self.first[level].append(first)
        if len(self.runs[level]) == FAN and level < len(self.runs) - 1:
            self.complete(level)

    def complete(self, level: int) -> None:
        run, first = self.runs[level], self.first[level]
        right = b""
        for i in range(len(run) - 1, -1, -1):
            end = first[i + 1] if i + 1 < len(run) else len(self.witness)
            for path in self.witness[first[i] : end]:
                path.append(right)
            right = run[i] + right
        self.runs[level], self.first[level] = [], []
        self.put(level + 1, sha(right), first[0])

    def close(self) -> bytes:
        for level in range(len(self.runs) - 1):
            if self.runs[level]:
                self.complete(level)
        return self.runs[-1][0]


def folded(leaf: bytes, path: list[bytes]) -> bytes:
    """The root that ``leaf`` and the siblings in ``path`` give."""
    for left, right in zip(path[::2], path[1::2], strict=True):
        leaf = sha(left + leaf + right)
    return leaf


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each block, from batches sorted by their first columns key and block."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if held and row[:2] != held[0][:2]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def rooted(batches: Iterator[pa.RecordBatch], height: int) -> Iterator[pa.RecordBatch]:
    """key, block, root of each block of rows key, block, n, pos, digest."""
    out: list[tuple] = []
    for rows in blocks(batches):
        frontier = Frontier(levels(rows[0][2], height))
        for row in rows:
            frontier.append(row[4].hex().encode())
        out.append((*rows[0][:2], bytes.fromhex(frontier.close().decode())))
        if len(out) >= BATCH:
            yield batch_of(out, NODE)
            out = []
    if out:
        yield batch_of(out, NODE)


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "array<binary>": pa.list_(pa.binary())}
    names = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, types[t]) for x, (_, t) in zip(zip(*rows, strict=True), names, strict=True)], [n for n, _ in names])


def witnessed(batches: Iterator[pa.RecordBatch], height: int, last: bool) -> Iterator[pa.RecordBatch]:
    """The witness of every member of a block, or at the last tier the proof of every row.

    Rows are key, block, n, pos, digest, doc_id, claim, path, subroot, root; the first of a block has no
    pos and brings the path of the block's root.
    """
    out: list[tuple] = []
    for head, *rows in blocks(batches):
        if head[3] is not None or not rows:
            raise ValueError(f"no witness of block {head[1]}")
        above, subroot, root = head[7:]
        frontier = Frontier(levels(rows[0][2], height))
        for row in rows:
            frontier.append(row[4].hex().encode())
        frontier.close()
        for row, own in zip(rows, frontier.witness, strict=True):
            path = own + above
            if last:
                leaf, claim = row[4].hex(), (row[4] if row[6] is None else row[6]).hex()
                reached, top = folded(claim.encode(), path).decode(), root.hex()
                out.append((row[5], leaf, subroot.hex(), top, sha(b"".join(path)).decode(), reached, reached == top))
            else:
                out.append((row[0], row[3], path, subroot, root))
        if len(out) >= (BATCH if last else FAN):
            yield batch_of(out, PROOF if last else WITNESS)
            out = []
    if out:
        yield batch_of(out, PROOF if last else WITNESS)


def hashed(text: Column) -> Column:
    """The leaf of a row with this text."""

    def field(c: Column) -> Column:
        value = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[field(text if name == "text" else F.col(name)) for name in FIELDS]).cast("binary"), 256))


def leaf_rows(docs: DataFrame, received: Column | None, when: Column | None) -> DataFrame:
    """key, doc_id, digest and claim: the leaf of the text as received where ``when`` holds, else null."""
    claim = F.lit(None).cast("binary") if received is None else F.when(when, hashed(received))
    key = F.coalesce(F.concat(F.lit(":"), F.col("source")), F.lit("-"))
    return docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), hashed(F.col("text")).alias("digest"), claim.alias("claim"))


def placed(leaves: DataFrame, known: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """``leaves`` with their pos in the source, and the sources that they make, or that they and the ``known`` ones make."""
    row = staged(leaves, "leaves").withColumn("_row", F.monotonically_increasing_id())
    order = [F.col("key"), F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("_row")]
    at = staged(numbered(row, *order, to="_at"), "numbered")
    new = at.groupBy("key").agg(F.count(F.lit(1)).alias("_count"), F.min("_at").alias("_first"), F.min("doc_id").alias("_least"), F.max("doc_id").alias("last"))
    if known is None:
        sources = new.withColumn("before", F.lit(0).cast("long")).withColumn("n", F.col("_count"))
    else:
        old = known.select("key", F.col("n").alias("before"), F.col("last").alias("_last"))
        both = new.join(old, "key", "full")
        late = ~F.coalesce(F.col("_least") > F.col("_last"), F.col("_count").isNull() | F.col("before").isNull() | F.col("_last").isNull())
        if not both.filter(late).isEmpty():
            raise ValueError("appended rows must follow the earlier ones of their source")
        n = F.coalesce("_count", F.lit(0)) + F.coalesce("before", F.lit(0))
        sources = both.withColumn("last", F.coalesce("last", "_last")).withColumn("before", F.coalesce("before", F.lit(0))).withColumn("n", n)
    sources = staged(sources.select("key", "_count", "_first", "before", "n", "last"), "sources")
    rows = attach(at, sources.filter("_count is not null").drop("n", "last"), "key", "_count", at.count(), F.col("_at"))
    pos = F.col("_at") - F.col("_first") + F.col("before")
    return staged(rows.select("key", pos.alias("pos"), "digest", "doc_id", "claim"), "placed"), sources.select("key", "n", "last")


def sized(nodes: DataFrame, sources: DataFrame, tier: int) -> DataFrame:
    """key, block, n (nodes of the source in this tier) and the other columns of ``nodes``."""
    scale = BLOCK**tier
    counts = sources.select("key", F.ceil(F.col("n") / scale).cast("long").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = attach(nodes, staged(counts, "counts"), "key", "n", total, F.col("pos"))
    block = F.floor(F.col("pos") / BLOCK).alias("block")
    return rows.select("key", block, "n", *[c for c in nodes.columns if c != "key"])


def by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "block").sortWithinPartitions("key", "block", F.col("pos").asc_nulls_first())


def climbed(nodes: DataFrame, sources: DataFrame, before: list[DataFrame], all_leaves: DataFrame) -> list[DataFrame]:
    """The block roots of each tier above ``nodes``, the new leaves, until every source is one node; ``before``: those without them."""
    out: list[DataFrame] = []
    current, changed, tier = all_leaves, nodes, 0
    most, height = sources.agg(F.max("n")).first()[0], LEVELS
    while True:
        rows = sized(current.select("key", "pos", "digest"), sources, tier)
        if tier < len(before):
            touched = staged(changed.select("key", F.floor(F.col("pos") / BLOCK).alias("block")).distinct(), "touched")
            rows = rows.join(touched, ["key", "block"], "left_semi")
        roots = staged(by_block(rows).mapInArrow(lambda batches: rooted(batches, height), NODE), "roots")
        if tier < len(before):
            kept = before[tier].join(roots.select("key", "pos"), ["key", "pos"], "left_anti")
            out.append(staged(kept.unionByName(roots), "tier"))
        else:
            out.append(roots)
        tier += 1
        most = -(-most // BLOCK)
        if most <= 1 and tier >= len(before):
            return out
        current, changed = out[-1], roots


def append(docs: DataFrame, to: Manifest | None = None, received: Column | None = None, when: Column | None = None) -> Manifest:
    """The manifest of ``docs``, or of the rows of ``to`` and then ``docs``, which must follow them in their sources.

    ``received`` is the text that ``proofs`` checks where ``when`` holds, instead of the text itself.
    """
    with arrow_rows(docs.sparkSession, BATCH):
        new, sources = placed(leaf_rows(docs, received, when), None if to is None else to.sources)
        leaves = new if to is None else staged(to.leaves.unionByName(new), "leaves")
        tiers = climbed(new, sources, [] if to is None else to.tiers, leaves) if sources.count() else []
    return Manifest(leaves, tiers, sources)


def top(manifest: Manifest) -> DataFrame:
    """key, pos (0), path, subroot and root of every source: the subroots are the leaves of one more tree."""
    subroots = staged(manifest.tiers[-1].select("key", "digest"), "subroots")
    nodes = staged(numbered(subroots, F.col("key"), to="pos").select(F.lit("").alias("key"), "pos", "digest", F.col("key").alias("source")), "top")
    n = nodes.count()
    one = staged(nodes.select("key").limit(1).select("key", F.lit(n).cast("long").alias("n")), "one")
    tiers = climbed(nodes, one, [], nodes)
    root = tiers[-1].select("key", F.lit(0).cast("long").alias("pos"), F.array().cast("array<binary>").alias("path"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    paths = descended([nodes, *tiers[:-1]], one, root, stop=0)
    return nodes.join(paths.select("pos", "path", "root"), "pos").select(F.col("source").alias("key"), F.lit(0).cast("long").alias("pos"), "path", F.col("digest").alias("subroot"), "root")


def headed(nodes: DataFrame, sources: DataFrame, tier: int, heads: DataFrame) -> DataFrame:
    """The members of each block behind the witness of its root."""
    none = {"doc_id": "long", "claim": "binary", "path": "array<binary>", "subroot": "binary", "root": "binary", "n": "long", "digest": "binary"}
    names = ["key", "block", "n", "pos", "digest", "doc_id", "claim", "path", "subroot", "root"]

    def row(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(none[c]).alias(c) for c in names])

    first = heads.withColumnRenamed("pos", "block").withColumn("pos", F.lit(None).cast("long"))
    return by_block(row(sized(nodes, sources, tier)).unionByName(row(first)))


def descended(tiers: list[DataFrame], sources: DataFrame, heads: DataFrame, stop: int) -> DataFrame:
    """The witnesses (staged) of the nodes in ``tiers[stop]``; ``heads`` are those of the top nodes."""
    height = LEVELS
    for tier in range(len(tiers) - 1, stop - 1, -1):
        rows = headed(tiers[tier].select("key", "pos", "digest"), sources, tier, heads)
        heads = staged(rows.mapInArrow(lambda batches: witnessed(batches, height, False), WITNESS), "witnesses")
    return heads


def proofs(manifest: Manifest) -> DataFrame:
    """Per row: its leaf, subroot, root, the digest of its siblings, the root folded from its claim, and whether that is the root."""
    spark = manifest.leaves.sparkSession
    if not manifest.tiers:
        return spark.createDataFrame([], PROOF)
    with arrow_rows(spark, BATCH):
        heads = descended([manifest.leaves, *manifest.tiers[:-1]], manifest.sources, staged(top(manifest), "heads"), stop=1)
        rows, height = headed(manifest.leaves, manifest.sources, 0, heads), LEVELS
        return staged(rows.mapInArrow(lambda batches: witnessed(batches, height, True), PROOF), "proofs")


def digest(docs: DataFrame) -> DataFrame:
    """``proofs`` where every fifth document, by the crc32 of its id, is received with its letters A-Z lower-cased."""
    lowered = F.translate("text", UPPER, LOWER)
    return proofs(append(docs, received=lowered, when=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0))


def sql(height: int = 6, top_height: int = 3) -> str:
    """``digest`` in DuckDB for sources of up to 16^height rows and 16^top_height sources."""
    field = "coalesce(octet_length(encode({0}::varchar)) || ':' || {0}::varchar, '-')"
    low = f"translate(text, '{UPPER}', '{LOWER}')"
    leaf = " || ".join(field.format(c) for c in FIELDS[:-1])
    shift = "list_reduce(list_prepend({0}::bigint, range(8)), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)"
    step = shift.format("xor(c % 256, x)")
    crc = f"xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda d: ascii(d)::bigint)), lambda c, x: xor(c // 256, {step})), 4294967295)"
    parts = [
        f"leafs AS (SELECT doc_id, coalesce(':' || source, '-') AS k, sha256({leaf} || {field.format('text')}) AS h,"
        f" CASE WHEN {crc} % 5 = 0 THEN sha256({leaf} || {field.format(low)}) END AS claim FROM documents)",
        "s0 AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, h) - 1 AS p, h, doc_id, claim FROM leafs)",
    ]

    def tree(name: str, base: str, height: int) -> None:
        parts.append(f"{name}0 AS (SELECT k, p, h FROM {base})")
        for i in range(height):
            parts.append(
                f"{name}w{i} AS (SELECT k, p, h, count(*) OVER (PARTITION BY k) AS n,"
                f" coalesce(string_agg(h, '') OVER (PARTITION BY k, p // 16 ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,"
                f" coalesce(string_agg(h, '') OVER (PARTITION BY k, p // 16 ORDER BY p ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{i})"
            )
            up = f"SELECT k, p // 16 AS p, sha256(string_agg(h, '' ORDER BY p)) AS h FROM {name}w{i} WHERE n > 1 GROUP BY k, p // 16"
            parts.append(f"{name}{i + 1} AS ({up} UNION ALL SELECT k, p, h FROM {name}w{i} WHERE n = 1)")

    tree("t", "s0", height)
    parts.append(f"tops AS (SELECT '' AS k, row_number() OVER (ORDER BY k) - 1 AS p, h, k AS source FROM t{height})")
    tree("u", "tops", top_height)
    joins, path, fold, at = "", [], "coalesce(s0.claim, s0.h)", "s0.p"
    for name, count, key in (("t", height, "s0.k"), ("u", top_height, "''")):
        if name == "u":
            joins += " JOIN tops ON tops.source = s0.k"
            at = "tops.p"
        for i in range(count):
            w = f"{name}w{i}"
            joins += f" JOIN {w} ON {w}.k = {key} AND {w}.p = CASE WHEN {w}.n > 1 THEN {at} // {16**i} ELSE 0 END"
            path.append(f"CASE WHEN {w}.n > 1 THEN {w}.l || {w}.r ELSE '' END")
    parts.append(f"f0 AS (SELECT s0.doc_id, s0.h AS leaf, tops.h AS subroot, sha256({' || '.join(path)}) AS proof_sha256, {fold} AS cur, "
                 + ", ".join(f"{n}w{i}.n AS n{n}{i}, {n}w{i}.l AS l{n}{i}, {n}w{i}.r AS r{n}{i}" for n, c in (("t", height), ("u", top_height)) for i in range(c)) + f" FROM s0{joins})")
    last = 0
    for n, c in (("t", height), ("u", top_height)):
        for i in range(c):
            parts.append(f"f{last + 1} AS (SELECT * REPLACE (CASE WHEN n{n}{i} > 1 THEN sha256(l{n}{i} || cur || r{n}{i}) ELSE cur END AS cur) FROM f{last})")
            last += 1
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, (SELECT h FROM u{top_height}) AS root, proof_sha256, cur AS folded_root,"
        f" cur = (SELECT h FROM u{top_height}) AS verified FROM f{last}"
    )


SQL = sql()

"""Alignment of two tokenizers by pointer jumping.

Both tokenizers cut the same bytes, so tokens of the two overlap in runs: groups are the components of
"overlaps", which end where tokens of both end.  Every token points to the token farthest to the right
that it overlaps, or to itself if none reaches farther; replacing each pointer by its pointer's pointer
doubles the way, and after a few vectorised rounds over a portion of documents every token points to the
last token of its component, which numbers the groups.  Every stretch between neighbouring ends of either
tokenizer lies in one token of each and is one link.

Counts of linked id pairs cover the whole corpus: tasks count the pairs of their documents, a shuffle adds
them up.  Documents keep their distinct pairs with multiplicities (packed), so texts are encoded once.
The commonest pairs, at most ``HOT_PAIRS`` of them by a count threshold, go to all tasks; the pairs below
the threshold of each document are joined with their counts by a shuffle, and none of those is hot.

Tokenizer A is a byte-level BPE of the tokenizers library.  Where its file is plain (no normalizer, the
usual pattern, ids in the order of the merges) the tiktoken library encodes with its ranks, which gives the
same ids (tested) in a third of the time.  B is a sentencepiece model, which puts a space before a text.

Edge cases: null and empty texts, and texts whose tokens of A or of B do not join to a space and the text
(B normalises some characters away), have no tokens: zeros and an empty ``groups_sha256``; a text is encoded
whole at any length; rows that repeat a doc_id, or have none, are documents of their own; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlens.llm.common import arrow_rows, staged

#: Pairs whose counts every task holds: 17 bytes each.
HOT_PAIRS = 1 << 18
#: Bytes of text that are aligned at once, and distinct pairs that a task counts before it emits them.
PORTION, TALLY = 1 << 20, 1 << 20
#: How byte-level BPE with its usual pattern parts a text (fixed value of the published scheme).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, times binary"


@dataclass
class Tokenizer:
    """``encode``: ids of texts after a space; ``spelled``: the bytes of each id."""

    encode: Callable[[list[str]], list[list[int]]]
    spelled: list[bytes]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@functools.cache
def byte_level(path: str) -> Tokenizer:
    from tokenizers import Tokenizer as Library

    library = Library.from_file(path)
    library.encode_special_tokens = True  # their strings in a text are ordinary text
    letters = byte_letters()
    spelled = [b""] * library.get_vocab_size()
    for token, i in library.get_vocab().items():
        spelled[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    model, parted = described["model"], described["pre_tokenizer"] or {}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", ())]
    plain = described["normalizer"] is None and model["type"] == "BPE" and not model.get("ignore_merges")
    plain = plain and parted.get("type") == "ByteLevel" and parted.get("use_regex") and not parted.get("add_prefix_space")
    if plain and all(model["vocab"].get(a + b) == 256 + k for k, (a, b) in enumerate(merges)):
        import tiktoken

        ranks = {spelled[i]: i for i in model["vocab"].values() if i < 256 + len(merges)}
        fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return Tokenizer(lambda texts: [fast.encode_ordinary(" " + t) for t in texts], spelled)
    return Tokenizer(lambda texts: [library.encode(" " + t, add_special_tokens=False).ids for t in texts], spelled)


@functools.cache
def pieces(path: str) -> Tokenizer:
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    size = library.get_piece_size()
    spelled = [bytes([int(library.id_to_piece(i)[3:5], 16)]) if library.is_byte(i) else library.id_to_piece(i).replace("▁", " ").encode() for i in range(size)]
    return Tokenizer(lambda texts: library.encode(texts, num_threads=1), spelled)


@dataclass
class Merged:
    """The ends of both tokenizers in one run of bytes: ``before_b`` counts the ends of B before each end of A, and so on."""

    before_b: np.ndarray
    before_a: np.ndarray
    #: Ends of either, each once, and how many ends of A and of B lie before.
    links: np.ndarray
    at_a: np.ndarray
    at_b: np.ndarray


def merged(ends_a: np.ndarray, ends_b: np.ndarray) -> Merged:
    n, both = len(ends_a), np.concatenate([ends_a, ends_b])
    order = np.argsort(both, kind="stable")  # of equal ends that of A comes first
    both, of_a = both[order], order < n
    a_before = np.cumsum(of_a) - of_a
    b_before = np.arange(len(both)) - a_before
    new = np.diff(both, prepend=-1) > 0
    tied = ~new[~of_a]  # an end of B with an equal one of A
    return Merged(b_before[of_a], a_before[~of_a] - tied, both[new], a_before[new], b_before[new])


def components(ends_a: np.ndarray, ends_b: np.ndarray, ends: Merged | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The group of every token of A and of B, from their ends in one run of bytes, by pointer jumping."""
    ends = merged(ends_a, ends_b) if ends is None else ends
    n = len(ends_a)
    own = n + np.arange(len(ends_b))
    to = np.concatenate([n + ends.before_b, np.where(ends_a[ends.before_a] > ends_b, ends.before_a, own)])
    while True:
        farther = to[to]
        if np.array_equal(farther, to):
            break
        to = farther
    # the terminal tokens of B, numbered
    number = np.cumsum(to[n:] == own) - 1
    group = number[to - n]
    return group[:n], group[n:]


@functools.cache
def words(size: int) -> list[str]:
    """Each id after a comma, a bar and a semicolon."""
    return [mark + str(i) for mark in ",|;" for i in range(size)]


def described(group_a: np.ndarray, group_b: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, first: np.ndarray, size: int) -> list[str]:
    """The groups of each document as ``a1,a2|b1;a3|b2,b3``; ``first`` numbers the first group of each document and ends with the total; ids are below ``size``."""
    key = np.concatenate([group_a * 2, group_b * 2 + 1])
    order = np.argsort(key, kind="stable")
    key, ids = key[order], np.concatenate([ids_a, ids_b])[order]
    mark = np.where(np.diff(key, prepend=-2) == 0, 0, np.where(key & 1, 1, 2))
    parts = list(map(words(size).__getitem__, (mark * size + ids).tolist()))
    cuts = np.searchsorted(key, 2 * first).tolist()
    return ["".join(parts[start:end])[1:] for start, end in itertools.pairwise(cuts)]


def portions(texts: list[str | None]) -> Iterator[list[int]]:
    """The rows of non-empty texts, in portions of about PORTION characters."""
    some, held = [], 0
    for i, text in enumerate(texts):
        if text:
            some.append(i)
            held += len(text)
            if held >= PORTION:
                yield some
                some, held = [], 0
    if some:
        yield some


def aligned(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str, whole: bool) -> Iterator[pa.RecordBatch]:
    """Rows of ALIGNED; ``groups`` is the text of the alignment where ``whole``, else its SHA-256."""
    a, b = byte_level(path_a), pieces(path_b)
    long_a, long_b = (np.fromiter(map(len, x.spelled), np.int64, len(x.spelled)) for x in (a, b))
    code = packing(len(a.spelled), len(b.spelled))
    for batch in batches:
        texts = batch.column(1).to_pylist()
        counts, groups = np.zeros((4, len(texts)), np.int64), [""] * len(texts)
        pairs, times = [b""] * len(texts), [b""] * len(texts)
        for rows in portions(texts):
            of_a, of_b, fit = a.encode([texts[i] for i in rows]), b.encode([texts[i] for i in rows]), []
            for i, x, y in zip(rows, of_a, of_b, strict=True):
                raw = b" " + texts[i].encode()
                if b"".join([a.spelled[t] for t in x]) == raw and b"".join([b.spelled[t] for t in y]) == raw:
                    fit.append((i, x, y))
            if not fit:
                continue
            row = np.array([i for i, _, _ in fit])
            counts[0, row], counts[1, row] = [len(x) for _, x, _ in fit], [len(y) for _, _, y in fit]
            ids_a, ids_b = (np.fromiter(itertools.chain.from_iterable(f[k] for f in fit), np.int64) for k in (1, 2))
            ends_a, ends_b = np.cumsum(long_a[ids_a]), np.cumsum(long_b[ids_b])
            both = merged(ends_a, ends_b)
            group_a, group_b = components(ends_a, ends_b, both)
            # documents end where both tokenizers end
            ends = np.cumsum(counts[0, row])
            first = np.concatenate([[0], group_a[ends - 1] + 1])
            counts[2, row] = np.diff(first)
            for i, text in zip(row.tolist(), described(group_a, group_b, ids_a, ids_b, first, max(len(a.spelled), len(b.spelled))), strict=True):
                groups[i] = text if whole else hashlib.sha256(text.encode()).hexdigest()
            linked = ids_a[both.at_a] * len(b.spelled) + ids_b[both.at_b]
            cuts = np.searchsorted(both.links, ends_a[ends - 1]) + 1
            counts[3, row] = np.diff(cuts, prepend=0)
            for i, start, end in zip(row.tolist(), [0, *cuts[:-1].tolist()], cuts.tolist(), strict=True):
                values, n = np.unique(linked[start:end], return_counts=True)
                pairs[i], times[i] = values.astype(code).tobytes(), n.astype("<u4").tobytes()
        columns = [batch.column(0), *map(pa.array, counts), pa.array(groups, pa.string()), pa.array(pairs, pa.binary()), pa.array(times, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in ALIGNED.split(", ")])


def packing(size_a: int, size_b: int) -> str:
    return "<u4" if size_a * size_b <= 1 << 32 else "<u8"


def unpacked(batch: pa.RecordBatch, code: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pair codes, multiplicities and their row from the columns ``pairs`` and ``times``."""
    at = batch.schema.get_field_index
    pairs = np.frombuffer(b"".join(batch.column(at("pairs")).to_pylist()), code).astype(np.int64)
    times = batch.column(at("times")).to_pylist()
    row = np.repeat(np.arange(batch.num_rows), [len(x) // 4 for x in times])
    return pairs, np.frombuffer(b"".join(times), "<u4").astype(np.int64), row


def summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, at = np.unique(codes, return_inverse=True)
    out = np.zeros(len(values), np.int64)
    np.add.at(out, at, counts)
    return values, out


def tallied(batches: Iterator[pa.RecordBatch], code: str) -> Iterator[pa.RecordBatch]:
    """code, n: the links of each id pair in the documents of a task."""
    codes, counts, held = [], [], 0

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(codes[0]), pa.array(counts[0])], ["code", "n"])

    for batch in batches:
        pairs, times, _ = unpacked(batch, code)
        codes.append(pairs)
        counts.append(times)
        held += len(pairs)
        if held >= TALLY:
            both = summed(np.concatenate(codes), np.concatenate(counts))
            codes, counts = [both[0]], [both[1]]
            held = len(both[0]) // 2  # what is known counts half, so that merging stays cheap
            if len(both[0]) >= TALLY:
                yield row()
                codes, counts, held = [], [], 0
    if codes:
        both = summed(np.concatenate(codes), np.concatenate(counts))
        codes, counts = [both[0]], [both[1]]
        yield row()


def scored(batches: Iterator[pa.RecordBatch], hot: tuple[np.ndarray, np.ndarray, np.ndarray], code: str) -> Iterator[pa.RecordBatch]:
    """The rows without their pairs, and what the ``hot`` pairs (code, n, best) add to best and sum."""
    for batch in batches:
        pairs, times, row = unpacked(batch, code)
        best, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        if len(hot[0]):
            at = np.minimum(np.searchsorted(hot[0], pairs), len(hot[0]) - 1)
            known = hot[0][at] == pairs
            np.add.at(total, row[known], times[known] * hot[1][at[known]])
            np.add.at(best, row[known], times[known] * hot[2][at[known]])
        keep = [i for i, name in enumerate(batch.schema.names) if name not in ("pairs", "times")]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(best), pa.array(total)], [*(batch.schema.names[i] for i in keep), "best", "total"])


def rare(batches: Iterator[pa.RecordBatch], hot: tuple[np.ndarray, np.ndarray, np.ndarray], code: str) -> Iterator[pa.RecordBatch]:
    """row, code, times of the pairs that are not hot."""
    for batch in batches:
        pairs, times, row = unpacked(batch, code)
        if len(hot[0]):
            other = hot[0][np.minimum(np.searchsorted(hot[0], pairs), len(hot[0]) - 1)] != pairs
            pairs, times, row = pairs[other], times[other], row[other]
        rows = batch.column(batch.schema.get_field_index("row")).to_numpy()[row]
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(pairs), pa.array(times)], ["row", "code", "times"])


def read(docs: DataFrame, path_a: str, path_b: str, whole: bool) -> DataFrame:
    """Rows of ALIGNED and a ``row`` number for every row of ``docs``, staged."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = rows.mapInArrow(lambda batches: aligned(batches, path_a, path_b, whole), ALIGNED)
    return staged(out.withColumn("row", F.monotonically_increasing_id()), "aligned")


def pair_counts(links: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """code, n, best (whether n is the highest of the pair's B id), staged; ``links``: rows of ``read``."""
    size_b = len(pieces(path_b).spelled)
    code = packing(len(byte_level(path_a).spelled), size_b)
    parts = links.select("pairs", "times").mapInArrow(lambda batches: tallied(batches, code), "code long, n long")
    counts = staged(parts.groupBy("code").agg(F.sum("n").alias("n")), "counts").withColumn("b", F.col("code") % size_b)
    # one row per id of B: bounded by its vocabulary
    highest = counts.groupBy("b").agg(F.max("n").alias("most"))
    return staged(counts.join(F.broadcast(highest), "b").select("code", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def threshold(counts: DataFrame) -> int:
    """The least power of two so that at most HOT_PAIRS pairs have as many links."""
    bins = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).count().collect()
    power, held = 64, 0
    for power_of, n in sorted(((r["power"], r["count"]) for r in bins), reverse=True):
        held += n
        if held > HOT_PAIRS:
            break
        power = power_of
    return 1 << power if power < 63 else (1 << 63) - 1


def alignment(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id and groups: the alignment of each document as text, '' without tokens."""
    with arrow_rows(docs.sparkSession):
        return read(docs, path_a, path_b, True).select("doc_id", "groups")


def digest(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of ``docs``."""
    spark = docs.sparkSession
    code = packing(len(byte_level(path_a).spelled), len(pieces(path_b).spelled))
    with arrow_rows(spark):
        links = read(docs, path_a, path_b, False)
        counts = pair_counts(links, path_a, path_b)
        least = threshold(counts)
        common = counts.filter(F.col("n") >= least).orderBy("code").toPandas()
        hot = spark.sparkContext.broadcast((common["code"].to_numpy(np.int64), common["n"].to_numpy(np.int64), common["best"].to_numpy(np.int64)))
        schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, row long, best long, total long"
        known = links.mapInArrow(lambda batches: scored(batches, hot.value, code), schema)
        others = counts.filter(F.col("n") < least)
        if not others.isEmpty():
            tail = links.select("row", "pairs", "times").mapInArrow(lambda batches: rare(batches, hot.value, code), "row long, code long, times long")
            tail = tail.join(others, "code").groupBy("row").agg(
                F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("best"), F.sum(F.col("times") * F.col("n")).alias("total")
            )
            tail = tail.select(*[F.lit(None).cast("long").alias(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")], F.lit(None).cast("string").alias("groups"), "row", "best", "total")
            firsts = [F.max(c).alias(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")]
            known = known.unionByName(tail).groupBy("row").agg(*firsts, F.sum("best").alias("best"), F.sum("total").alias("total"))
        known = staged(known, "scored")
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    return known.select(*columns, F.col("best").alias("n_best"), F.col("total").alias("count_sum"), F.col("groups").alias("groups_sha256"))

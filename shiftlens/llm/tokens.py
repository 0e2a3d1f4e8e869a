"""Token ids in Arrow IPC files of equal-length sequences.

Documents are range-partitioned by doc_id and sorted; each partition is one stream of ids, cut into
sequences of ``length`` ids.  A file holds record batches with two fixed-size-list columns, ``ids``
and ``mask`` (false only in the padding after the last id), so any sequence is a zero-copy slice of
the mapped file.  The file's schema metadata index its documents, so a file needs no other file.
A file ends with the document that fills it; it is as large as ``file_ids`` ids or one document.

Spark's own writer and commit protocol write the files, one per row: an Arrow file ends with the
letters ARROW1, which are given as the line separator of the text writer.

Edge cases: a null or empty text is one end id; rows without doc_id come first; rows of equal doc_id
keep their input order and get one entry each; an empty table gives no entries; columns other than
doc_id and text are ignored.
"""

from __future__ import annotations

import base64
import functools
import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shiftlens.llm.common import checked, scratch, small_batches, staged

LENGTH, FILE_IDS, BATCH_ROWS, END_ID = 1024, 4_000_000, 256, 1
MAGIC = "ARROW1"
#: Pieces of text whose ids a worker remembers, in two generations, and the longest such piece.
MEMO_PIECES, MEMO_CHARS = 700_000, 48
#: ASCII marks that may follow a word, without the apostrophe, which opens endings.
MARKS = tuple(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
#: Below it lie the Latin letters with and without accents.
LATIN_END = "\u0250"
LATIN_WORD = re.compile("([a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u024f]+)([" + re.escape("".join(MARKS)) + "]*)")
INDEX = b"documents"
READ_SCHEMA = "doc_id long, part int, begin long, n_tokens long, ids_crc32 long"


class Encoder:
    """Ids of a text by the tokenizers library, as the bytes of ``dtype``.

    With ``by_piece`` the text goes to the library in pieces between spaces, and a worker remembers
    the ids of short pieces.  That gives equal ids only for a tokenizer that drops white space and
    lets no token cross it.  If the tokenizer also folds case and parts letters from marks, which a
    few probes tell, a word of Latin letters is looked up in lower case and apart from the mark after
    it, and a new one goes straight to the library's model.
    """

    def __init__(self, path: str, by_piece: bool):
        from tokenizers import Tokenizer, pre_tokenizers

        self.library, self.by_piece = Tokenizer.from_file(path), by_piece
        self.code = "H" if self.library.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype("<u2" if self.code == "H" else "<u4")
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        spelled = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {c: spelled(chr(c))[0][0] for c in range(128, ord(LATIN_END))}
        self.apart = by_piece and all(
            self.encode(w + m) == self.encode(w.lower()) + self.encode(m) and self.encode(w) == self.word(w.lower())
            for w in ("Aword", "thING", "Q", "unheardofword", "Éñçüße") for m in (*MARKS, "***", "%%%.", "!!", "|,")
        )

    def encode(self, text: str) -> bytes:
        return array(self.code, self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def word(self, text: str) -> bytes:
        return array(self.code, [t.id for t in self.library.model.tokenize(text if text.isascii() else text.translate(self.spelling))]).tobytes()

    def fresh(self, text: str) -> bytes:
        parts = LATIN_WORD.fullmatch(text.lower()) if self.apart else None
        if parts is None:
            return self.encode(text)
        word, marks = parts.groups()
        if word == text:
            return self.word(word)
        return self.piece(word) + (self.piece(marks) if marks else b"")

    def piece(self, text: str) -> bytes:
        ids = self.young.get(text)
        if ids is not None:
            return ids
        ids = self.old.get(text)
        if ids is None:
            ids = self.fresh(text)
        if len(text) <= MEMO_CHARS:
            if 2 * len(self.young) >= MEMO_PIECES:
                self.old, self.young = self.young, {}
            self.young[text] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        if not self.by_piece:
            return self.encode(text)
        pieces = text.replace("\n", " ").split(" ")
        known = list(map(self.young.get, pieces))
        if None in known:
            known = [self.piece(p) if k is None else k for p, k in zip(pieces, known, strict=True)]
        return b"".join(known)


@functools.cache
def encoder(path: str, by_piece: bool) -> Encoder:
    return Encoder(path, by_piece)


def arrow_file(ids: np.ndarray, index: dict, length: int) -> pa.Buffer:
    """``ids`` in sequences of ``length``, with ``index`` in the metadata."""
    rows = -(-len(ids) // length)
    padded = np.zeros(rows * length, dtype=ids.dtype)
    padded[: len(ids)] = ids
    mask = np.zeros(rows * length, dtype=bool)
    mask[: len(ids)] = True
    columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), length) for x in (padded, mask)]
    schema = pa.schema([pa.field(n, c.type) for n, c in zip(("ids", "mask"), columns, strict=True)], metadata={INDEX: json.dumps(index).encode()})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, schema) as out:
        out.write_table(pa.Table.from_arrays(columns, schema=schema), max_chunksize=BATCH_ROWS)
    return sink.getvalue()


def packed(values, dtype) -> str:
    return base64.b64encode(np.asarray(values, dtype=dtype).tobytes()).decode()


def unpacked(text: str, dtype) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), dtype=dtype)


def encode_partition(batches: Iterator[pa.RecordBatch], path: str, by_piece: bool, end_id: int, length: int, file_ids: int) -> Iterator[pa.RecordBatch]:
    encode, part, before = encoder(path, by_piece), TaskContext.get().partitionId(), 0
    end = np.array([end_id], dtype=encode.dtype).tobytes()
    parts, doc_ids, sizes, held = [], [], [], 0

    def file() -> pa.RecordBatch:
        index = {
            "part": part, "before": before, "length": length, "n": len(sizes), "sizes": packed(sizes, "<i8"),
            "doc_ids": packed([x or 0 for x in doc_ids], "<i8"), "known": packed([x is not None for x in doc_ids], "u1"),
        }
        body = arrow_file(np.frombuffer(b"".join(parts), dtype=encode.dtype), index, length)
        size = len(body) - len(MAGIC)
        row = pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, size], "i4")), body.slice(0, size)])
        return pa.RecordBatch.from_arrays([row], ["body"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            parts.append(encode(text.as_py() or "") + end)
            doc_ids.append(doc_id)
            sizes.append(len(parts[-1]) // encode.dtype.itemsize)
            held += sizes[-1]
            if held >= file_ids:
                yield file()
                before += held
                parts, doc_ids, sizes, held = [], [], [], 0
    if sizes:
        yield file()


def write(docs: DataFrame, folder: str, tokenizer: str, by_piece: bool = False, end_id: int = END_ID, length: int = LENGTH, file_ids: int = FILE_IDS) -> str:
    """Write the ids of ``docs`` in ascending doc_id order as Arrow files into ``folder``."""
    small_batches(docs.sparkSession)
    ordered = (
        docs.select("doc_id", "text").withColumn("_at", F.monotonically_increasing_id())
        .repartitionByRange("doc_id", "_at").sortWithinPartitions("doc_id", "_at").select("doc_id", "text")
    )
    files = ordered.mapInArrow(lambda b: encode_partition(b, tokenizer, by_piece, end_id, length, file_ids), "body binary")
    files.select(F.col("body").cast("string")).write.option("lineSep", MAGIC).option("maxRecordsPerFile", 1).text(folder)
    return folder


def read_file(body) -> pa.RecordBatch:
    """One row per document of an Arrow file: doc_id, part, begin (ids of the part before it), size, checksum."""
    reader = pa.ipc.open_file(pa.BufferReader(body))
    index = json.loads(reader.schema.metadata[INDEX])
    batches = [reader.get_batch(i) for i in range(reader.num_record_batches)]
    ids = np.concatenate([b.column(0).flatten().to_numpy() for b in batches])
    real = sum(b.column(1).flatten().true_count for b in batches)
    sizes, known = unpacked(index["sizes"], "<i8"), unpacked(index["known"], "u1").astype(bool)
    ends = np.cumsum(sizes)
    if real != ends[-1]:
        raise ValueError(f"the mask marks {real} ids, the index has {ends[-1]}")
    crc = [zlib.crc32(ids[e - n : e].astype("<u4").tobytes()) for e, n in zip(ends, sizes, strict=True)]
    doc_ids = pa.array(unpacked(index["doc_ids"], "<i8"), mask=~known)
    columns = [doc_ids, pa.array(np.full(len(sizes), index["part"], "i4")), pa.array(index["before"] + ends - sizes), pa.array(sizes), pa.array(crc, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "begin", "n_tokens", "ids_crc32"])


def read_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for body in batch.column(0):
            yield read_file(body.as_buffer())


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32, from the files of ``write``."""
    small_batches(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    docs = staged(files.mapInArrow(read_partition, READ_SCHEMA), "read")
    # one row per part, that is per task of the writer
    parts = docs.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    starts = parts.select("part", (F.sum("_n").over(W.orderBy("part")) - F.col("_n")).alias("_start"))
    return docs.join(checked(starts), "part").select("doc_id", (F.col("_start") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def digest(docs: DataFrame, tokenizer: str, by_piece: bool) -> DataFrame:
    return read(docs.sparkSession, write(docs, scratch(docs.sparkSession, "tokens"), tokenizer, by_piece))

"""WARC archives written from and read back into a chunked record table.

A payload is a sequence of rows (record, chunk number, bytes); each row carries the running SHA-256
of the payload up to its end, so the last one has the payload's digest, and no step after the first
holds a whole payload.  A payload of one chunk is one record; a longer one becomes a first segment
and "continuation" records, which may lie in different files.  Of equal payloads of at least
``least`` bytes the record with the smallest page_id is written in full, the others as revisits.

Spark's own writer and commit protocol write the archives: each row is a record, and the blank line
that ends a record is the line separator of the text writer.

Edge cases: null html is an empty payload; a null url leaves out the target; a null page_id is kept
and never referred to; repeated rows of the smallest page_id are all written in full; rows that
repeat a page_id with different html are told apart by digest; no rows give no archives; columns
other than page_id, url and html are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlens.llm.common import attach, checked, scratch, small_batches, staged

CHUNK, LEAST, FILE_RECORDS = 1 << 16, 100, 4096
DATE = "2024-01-01T00:00:00Z"
END, LINE = b"\r\n\r\n", b"\r\n"
#: Fixed values of the archive format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of a batch of rows that a task gives back.
FLUSH = 4 << 20

CHUNKS = "page_id long, url string, chunk_no int, n_chunks int, payload_bytes long, running_sha256 string, chunk binary"
READ = "page_id long, record_type string, refers_to long, segment int, n_segments int, payload_bytes long, payload_digest string, chunk binary"


def batched(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of about FLUSH bytes of their last column."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    held, weight = [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*held, strict=True), fields, strict=True)], [n for n, _ in fields])

    for row in rows:
        held.append(row)
        weight += len(row[-1] or b"") + 200
        if weight >= FLUSH:
            yield batch()
            held, weight = [], 0
    if held:
        yield batch()


def chunk_rows(batches: Iterator[pa.RecordBatch], size: int, slim: bool) -> Iterator[tuple]:
    for batch in batches:
        for page_id, url, html in zip(*(batch.column(i) for i in range(3)), strict=True):
            body = memoryview(html.as_buffer() or b"")
            digest, n = hashlib.sha256(), max(1, -(-len(body) // size))
            for no in range(n):
                piece = body[no * size : (no + 1) * size]
                digest.update(piece)
                if not slim or no == n - 1:
                    yield page_id.as_py(), url.as_py(), no, n, len(body), digest.copy().hexdigest(), None if slim else bytes(piece)


def chunk_table(pages: DataFrame, size: int = CHUNK, slim: bool = False) -> DataFrame:
    """Rows of ``size`` bytes with the running digest; slim: only the last row of each record, without bytes."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url"), F.col("html").cast("binary"))
    return rows.mapInArrow(lambda b: batched(chunk_rows(b, size, slim), CHUNKS), CHUNKS)


def revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, payload_digest, refers_to of the records that repeat an earlier payload."""
    last = staged(chunk_table(pages, slim=True).select("page_id", "payload_bytes", F.col("running_sha256").alias("payload_digest")), "digests")
    long = last.filter(F.col("payload_bytes") >= least)
    groups = long.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("_n"))
    repeated = staged(groups.filter("_n > 1"), "repeated")
    found = attach(long, repeated, "payload_digest", "_n", long.count(), F.col("page_id"))
    return found.filter(F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "payload_digest", "refers_to").distinct()


def record_id(page_id: int | None, segment: int = 1) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}:{segment}>"


def page_of(record: str) -> int | None:
    page = record.strip("<>").split(":")[2]
    return None if page == "none" else int(page)


def headers(fields: list[tuple[str, object]]) -> bytes:
    return LINE.join([VERSION, *(f"{k}: {v}".encode() for k, v in fields)]) + END


def record(page_id, url, no, n, size, running, chunk, digest, refers_to) -> bytes:
    """One record without the blank line that ends it."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    kind = "continuation" if no else "response" if refers_to is None else "revisit"
    block = chunk if no else http if refers_to is not None else http + chunk
    fields: list[tuple[str, object]] = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id, no + 1)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)))
    if not no:
        fields += [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    elif n > 1:
        fields.append(("WARC-Segment-Number", no + 1))
        if no:
            # the digest of the whole payload names the origin where rows repeat a page_id
            fields += [("WARC-Segment-Origin-ID", record_id(page_id)), ("WARC-Segment-Origin-Digest", f"sha256:{digest}")]
        fields.append(("WARC-Segment-Total-Length", len(http) + size) if no == n - 1 else ("WARC-Segment-Running-Digest", f"sha256:{running}"))
    fields.append(("Content-Length", len(block)))
    return headers(fields) + block


def record_rows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple]:
    for batch in batches:
        for page_id, url, html, refers, whole in zip(*(batch.column(i) for i in range(5)), strict=True):
            body, digest = memoryview(html.as_buffer() or b""), whole.as_py()
            page, link, to, n = page_id.as_py(), url.as_py(), refers.as_py(), max(1, -(-len(body) // size))
            if to is not None:
                yield (record(page, link, 0, 1, len(body), digest, b"", digest, to),)
                continue
            running = hashlib.sha256()
            for no in range(n):
                piece = bytes(body[no * size : (no + 1) * size])
                running.update(piece)
                yield (record(page, link, no, n, len(body), running.hexdigest(), piece, digest, None),)


def write(pages: DataFrame, folder: str, size: int = CHUNK, least: int = LEAST) -> str:
    """Write a record, or its segments, for every row of ``pages`` into archives in ``folder``."""
    small_batches(pages.sparkSession)
    known = revisits(pages, least).select(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"), "refers_to")
    known = checked(staged(known, "revisits"))  # few: the payloads stay where they are; many: they shuffle by page_id
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.col("html").cast("binary").alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.coalesce("html", F.lit(b"")), 256))
    same = F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    linked = rows.join(known, same, "left").select("page_id", "url", "html", "refers_to", "digest")
    records = linked.mapInArrow(lambda b: batched(record_rows(b, size), "record binary"), "record binary")
    lines = records.select(F.col("record").cast("string"))
    lines.write.option("lineSep", END.decode()).option("maxRecordsPerFile", FILE_RECORDS).text(folder)
    return folder


def parsed(archive: memoryview) -> Iterator[tuple[dict[str, str], memoryview]]:
    """Header fields and block of each record; blocks are views of the archive."""
    at, whole = 0, archive.obj if isinstance(archive.obj, bytes) else bytes(archive)
    while at < len(archive):
        stop = whole.index(END, at)
        version, *lines = whole[at:stop].split(LINE)
        if version != VERSION:
            raise ValueError(f"no record at byte {at}: {version[:40]!r}")
        fields = dict(line.decode().split(": ", 1) for line in lines)
        begin = stop + len(END)
        end = begin + int(fields["Content-Length"])
        if whole[end : end + len(END)] != END:
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield fields, archive[begin:end]
        at = end + len(END)


def read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for content in batch.column(0):
            archive = content.as_py()
            for fields, block in parsed(memoryview(archive)):
                page, kind, declared = page_of(fields["WARC-Record-ID"]), fields["WARC-Type"], None
                segment, refers = int(fields.get("WARC-Segment-Number", 1)), fields.get("WARC-Refers-To")
                payload = block
                if kind != "continuation":
                    http = bytes(block[:256]).index(END) + len(END)
                    declared = int(bytes(block[:http]).split(b"Content-Length: ")[1].split(LINE)[0])
                    payload = block[http:]
                digest = fields.get("WARC-Payload-Digest", fields.get("WARC-Segment-Origin-Digest", "")).removeprefix("sha256:")
                split = "WARC-Segment-Number" in fields
                total = segment if "WARC-Segment-Total-Length" in fields else None
                if kind == "response" and not split:
                    own = hashlib.sha256(payload).hexdigest()
                    if own != digest or len(payload) != declared:
                        raise ValueError(f"record {fields['WARC-Record-ID']}: payload and header differ")
                yield page, kind, None if refers is None else page_of(refers), segment, total, declared, digest, bytes(payload) if split else None


SEGMENTS = "page_id long, payload_bytes long, payload_digest string"


def joined_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Payload length and digest of segmented records, from their segments in order; one segment is held at a time."""
    now, digest, size, declared, no = None, None, 0, None, 0
    for batch in batches:
        for page, want, segment, n, length, chunk in zip(*(batch.column(i) for i in range(6)), strict=True):
            key = (page.as_py(), want.as_py())
            if segment.as_py() == 1:
                now, digest, size, declared, no = key, hashlib.sha256(), 0, length.as_py(), 0
            no += 1
            if key != now or segment.as_py() != no:
                raise ValueError(f"record {key[0]}: segment {segment.as_py()} where {no} should be")
            digest.update(chunk.as_buffer())
            size += len(chunk.as_buffer())
            if n.as_py() is not None:
                if digest.hexdigest() != key[1] or size != declared:
                    raise ValueError(f"record {key[0]}: segments and header differ")
                yield key[0], size, digest.hexdigest()


def read(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record in the archives."""
    small_batches(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    rows = staged(files.mapInArrow(lambda b: batched(read_rows(b), READ), READ), "records")
    whole = rows.filter("chunk is null")
    # rows that repeat a page_id and its html have equal segments: each segment is read once and counted
    key = ["page_id", "payload_digest", "segment"]
    parts = rows.filter("chunk is not null").groupBy(*key).agg(
        F.count(F.lit(1)).alias("copies"), F.max("n_segments").alias("n_segments"), F.max("payload_bytes").alias("payload_bytes"), F.first("chunk").alias("chunk"))
    dealt = parts.repartition("page_id", "payload_digest").sortWithinPartitions(*key)
    done = dealt.select(*key[:2], "segment", "n_segments", "payload_bytes", "chunk").mapInArrow(lambda b: batched(joined_rows(b), SEGMENTS), SEGMENTS)
    firsts = rows.filter("chunk is not null and segment = 1").select("page_id", "record_type", "refers_to", F.col("payload_digest").alias("_d"))
    same = firsts["page_id"].eqNullSafe(done["page_id"]) & (firsts["_d"] == done["payload_digest"])
    split = firsts.join(done, same).select(firsts["page_id"], done["payload_bytes"], done["payload_digest"], "record_type", "refers_to")
    return whole.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").unionByName(split)


def digest(pages: DataFrame) -> DataFrame:
    return read(pages.sparkSession, write(pages, scratch(pages.sparkSession, "warc")))


SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> coalesce(page_id, first + 1) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> coalesce(page_id, first + 1) THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

from __future__ import annotations

import glob
import hashlib

from shiftlens.llm import warc as W

BIG = "<p>" + "é\r\n\r\nWARC/1.1 " * 900
ROWS = [
    (5, "http://a/5", BIG), (3, "http://a/3", BIG), (9, None, BIG), (1, "http://a/1", "x" * 99), (2, "http://a/2", "x" * 99), (4, "u\r\nX: y", "y" * 100),
    (6, "http://a/6", "y" * 100), (7, "http://a/7", None), (8, "http://a/8", ""), (10, "http://a/10", "\r\n\r\n"), (None, "http://a/n", "y" * 100),
    (11, "http://a/11", "z" * 5000), (11, "http://a/11", "z" * 5000), (12, "http://a/12", "q" * 3000), (12, "http://a/12", "r" * 3000),
]


def pages(spark, rows):
    full = [(*r, 1, "x") for r in rows]
    return spark.createDataFrame(full, "page_id long, url string, html string, chunk int, refers_to string")


def expected(rows):
    first = {}
    for page, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 100 and page is not None:
            first[body] = min(first.get(body, page), page)
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        to = first.get(body)
        to = None if to == page else to
        out.append((page, len(body), hashlib.sha256(body).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def test_archives_read_back(spark, tmp_path):
    folder = W.write(pages(spark, ROWS), str(tmp_path / "w"), size=1000)
    got = sorted((tuple(r) for r in W.read(spark, folder).collect()), key=str)
    assert got == expected(ROWS)
    text = b"".join(open(f, "rb").read() for f in glob.glob(folder + "/part-*"))
    assert b"WARC-Type: continuation" in text and b"\r\nX: y" not in text


def test_chunks_carry_running_digests(spark):
    rows = W.chunk_table(pages(spark, [(1, "u", "abc" * 1000)]), size=700).orderBy("chunk_no").collect()
    seen = b""
    for r in rows:
        seen += bytes(r.chunk)
        assert r.running_sha256 == hashlib.sha256(seen).hexdigest()
    assert seen == b"abc" * 1000 and len(rows) == rows[0].n_chunks == 5


def test_no_pages(spark, tmp_path):
    assert W.read(spark, W.write(pages(spark, []), str(tmp_path / "w"))).count() == 0

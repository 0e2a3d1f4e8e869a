from __future__ import annotations

import glob
import os
import zlib

import numpy as np
import pyarrow as pa
import pytest

from llm_fixtures import docs_of  # noqa: F401

from shiftlens.llm import tokens as T
from shiftlens.llm.queries import tokenizer

PATH = tokenizer("word_bpe_49k.json")
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary file")
ODD = [
    "a b\tc", "x <|endoftext|> y<|startoftext|>", "e ́ ́e", "\x1c\x1f a\x85b", "don't I'LL 12 34\r\n\r\n ΑΣ ΑΣ, İ", "   ", "　 x",
    "Éa. Éa, ǅ. ß! İ. ª. ﬁ, Ω.", "µ º ŉ ſ ẞ", "THE end. the END, The: end!?", "日本語 text", "a" * 500, "x." * 300,
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return lambda text, t=Tokenizer.from_file(PATH): t.encode(text, add_special_tokens=False).ids


def test_pieces_give_the_ids_of_the_whole_text(library, monkeypatch):
    monkeypatch.setattr(T, "MEMO_PIECES", 8)
    encode = T.Encoder(PATH, by_piece=True)
    assert encode.apart
    for text in ODD + [chr(c) + m for c in range(1, 0x250) for m in (".", "a")]:
        assert np.frombuffer(encode(text), encode.dtype).tolist() == library(text), text


def test_round_trip_through_files(spark, docs_of, library, tmp_path):
    docs = [(i, t) for i, t in enumerate(ODD)] + [(100, None), (101, ""), (50, "same"), (50, "same"), (None, "no id"), (-5, "first " * 3000)]
    folder = T.write(docs_of(docs), str(tmp_path / "t"), PATH, by_piece=True, length=16, file_ids=200)
    got = T.read(spark, folder).orderBy("start").collect()
    want, start = [], 0
    for i, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = library(text or "") + [1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == want
    files = sorted(glob.glob(folder + "/part-*"))
    assert len(files) > 2
    for f in files:
        with pa.memory_map(f) as source:
            batch = pa.ipc.open_file(source).get_batch(0)
            assert batch.schema.field("ids").type.list_size == 16 and batch.schema.field("mask").type.list_size == 16


def test_no_documents(spark, docs_of, tmp_path):
    assert T.read(spark, T.write(docs_of([]), str(tmp_path / "t"), PATH, by_piece=True)).count() == 0

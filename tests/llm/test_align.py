from __future__ import annotations

import hashlib
import os
import re
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import docs_of  # noqa: F401

from shiftlens.llm import align as A
from shiftlens.llm.queries import tokenizer

BYTES, PIECES = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
pytestmark = pytest.mark.skipif(not os.path.exists(BYTES) or not os.path.exists(PIECES), reason="no vocabularies")

TEXTS = [
    "The quick brown fox, it's jumping over 1234 lazy dogs!", "naïve café — 漢字 カタカナ 👩‍👩‍👧 ﬁ ①", "a\tb\nc\r\n  d   ", "   ", "x", "<|endoftext|> </s> <0x41> <unk> ▁", "nul\0byte",
    "zzzzzzzzzzzzzzzz" * 50, "word " * 400, "The quick brown fox", "the  double  space", "é", "﻿bom", " line  nbsp 　wide", "", None, "The quick brown fox",
]


def tokens(text):
    """(id, start, end) by A and by B of a text, straight from the libraries, or None."""
    import sentencepiece
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    letters = A.byte_letters()
    whole, out = b" " + text.encode(), []
    a = [(i, bytes(letters[c] for c in library.id_to_token(i))) for i in library.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()) for i in model.encode(text) for p in [model.id_to_piece(i)]]
    for side in (a, b):
        if b"".join(x for _, x in side) != whole:
            return None
        at, spans = 0, []
        for i, x in side:
            spans.append((i, at, at + len(x)))
            at += len(x)
        out.append(spans)
    return out


def brute(rows):
    per, count = [], Counter()
    for doc_id, text in rows:
        both = tokens(text) if text else None
        if both is None:
            per.append((doc_id, None))
            continue
        a, b = both
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, low = [], 0
        for high in cuts:
            groups.append("|".join(",".join(str(i) for i, _, e in side if low < e <= high) for side in both))
            low = high
        count.update(links)
        per.append((doc_id, (len(a), len(b), len(groups), links, ";".join(groups))))
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for doc_id, x in per:
        if x is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, text = x
        out.append((doc_id, n_a, n_b, n_groups, len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [1 << 18, 40, 0])
def test_against_all_pairs_of_tokens(docs_of, monkeypatch, hot):
    monkeypatch.setattr(A, "HOT_PAIRS", hot)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "repeated id"), (None, "no id"), (None, None)]
    got = sorted((tuple(r) for r in A.digest(docs_of(rows), BYTES, PIECES).collect()), key=str)
    assert got == brute(rows)
    assert sum(r[1] > 0 for r in got) > 10 and sum(r[1] == 0 for r in got) >= 4


def test_small_portions_give_the_same(monkeypatch):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS)), pa.int64()), pa.array(TEXTS)], ["doc_id", "text"])
    whole = [b.to_pydict() for b in A.aligned(iter([batch]), BYTES, PIECES, True)]
    monkeypatch.setattr(A, "PORTION", 7)
    assert [b.to_pydict() for b in A.aligned(iter([batch]), BYTES, PIECES, True)] == whole
    tallied = lambda: {c: n for b in A.tallied(A.aligned(iter([batch] * 3), BYTES, PIECES, False), "<u4") for c, n in zip(*map(list, b.to_pydict().values()))}
    once = tallied()
    assert sum(once.values()) == 3 * sum(whole[0]["n_links"])


def test_ranks_give_the_ids_of_the_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    rng = np.random.default_rng(2)
    alphabet = list("aeionrst '.,!\n\t 0123456789ABCé漢 　👍") + ["ing", " the", "n't", "  ", "'ll"]
    texts = ["".join(rng.choice(alphabet, rng.integers(1, 80))) for _ in range(3000)] + [t for t in TEXTS if t] + [" " * 5000, "a" * 5000]
    assert A.byte_level(BYTES).encode(texts) == [library.encode(" " + t, add_special_tokens=False).ids for t in texts]


def test_pointers_reach_the_end_of_long_components():
    # ends interleave for 1,000 tokens, so only pointer doubling over the whole chain finds the one group
    a, b = np.arange(2, 2002, 2), np.append(np.arange(1, 2001, 2), 2000)
    group_a, group_b = A.components(a, b)
    assert set(group_a) == set(group_b) == {0}
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        ends = [np.unique(np.append(rng.integers(1, n + 1, rng.integers(0, 40)), n)) for _ in range(2)]
        both = np.intersect1d(*ends)
        got = A.components(*ends)
        assert [g.tolist() for g in got] == [np.searchsorted(both, e).tolist() for e in ends]


def test_alignment_text_and_no_documents(docs_of):
    docs = docs_of([(1, "ab"), (2, ""), (3, None)])
    got = {r.doc_id: r.groups for r in A.alignment(docs, BYTES, PIECES).collect()}
    want = tokens("ab")
    assert got[2] == got[3] == "" and sorted(re.split("[;,|]", got[1])) == sorted(str(i) for side in want for i, _, _ in side)
    assert A.digest(docs_of([]), BYTES, PIECES).count() == 0
    assert A.digest(docs_of([(1, None)]), BYTES, PIECES).first().groups_sha256 == ""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import docs_of  # noqa: F401

from shiftlens.llm import repeats as R


def brute(rows):
    bodies = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p : p + 200] for _, b in bodies for p in range(len(b) - 199))
    out = []
    for i, b in bodies:
        gone = np.zeros(len(b) + 1, dtype=bool)
        for p in range(len(b) - 199):
            if seen[b[p : p + 200]] > 1:
                gone[p : p + 200] = True
        spans = int((gone[1:] > gone[:-1]).sum() + gone[0])
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=False) if not g)).hexdigest()))
    return sorted(out, key=str)


def corpus(seed=0):
    rng = np.random.default_rng(seed)
    text = lambda n: "".join(rng.choice(list("abcdefghij é"), n))
    passages = [text(n) for n in (199, 200, 201, 350, 900, 60)]
    rows = [(i, text(int(n))) for i, n in enumerate(rng.integers(0, 1500, 30))]
    rows += [(100 + i, text(150) + passages[i % 6] + text(90) + passages[(i + 1) % 6]) for i in range(24)]
    rows += [(200 + i, passages[4][i * 50 :] + text(40)) for i in range(8)]
    rows += [(300, None), (301, ""), (302, "a" * 199), (303, "a" * 200), (304, "a" * 201), (305, "b" * 5000), (306, "xyz" * 400), (307, text(130) * 4)]
    rows += [(400, rows[5][1] * 2), (401, rows[8][1]), (401, rows[8][1]), (None, rows[9][1]), (None, text(500)), (401, text(300) + passages[3])]
    return rows + [(500, text(60_000)), (501, passages[4] + passages[4])]


@pytest.mark.parametrize("slab", [1 << 21, 3000])
def test_against_every_window(spark, docs_of, monkeypatch, slab):
    monkeypatch.setattr(R, "SLAB", slab)
    monkeypatch.setattr(R, "SLIM_ROWS", 50)
    rows = corpus()
    assert sorted((tuple(r) for r in R.deduplicated(docs_of(rows)).collect()), key=str) == brute(rows)


def test_frequent_digits_give_the_same(spark, docs_of, monkeypatch):
    monkeypatch.setattr(R, "SAMPLE", 1)
    monkeypatch.setattr(R, "FREQUENT", 0.0)
    rows = corpus(1) + [(600 + i, "0123456789" * 3 + "common passage " * 20 + str(i) * 30) for i in range(40)]
    assert sorted((tuple(r) for r in R.deduplicated(docs_of(rows)).collect()), key=str) == brute(rows)


def test_no_documents(docs_of):
    assert R.deduplicated(docs_of([])).count() == 0


def test_least_and_rolling_hashes():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    assert R.least_in(x, 129).tolist() == [int(x[i : i + 129].min()) for i in range(372)]
    data = rng.integers(97, 100, 3000, dtype=np.uint8)
    h = R.Rolling()(data, 7)
    seen = {}
    for i in range(len(h)):
        assert seen.setdefault(data[i : i + 7].tobytes(), h[i]) == h[i]
    assert len(set(h.tolist())) == len(seen)

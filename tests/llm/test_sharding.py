from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np

from llm_fixtures import docs_of, word  # noqa: F401

from shiftlens.llm import sharding as S


def test_near_equal_bytes_whole_groups_and_slots(docs_of, word):
    rows = [(i, f"{word(i)} " * (1 + i % 40)) for i in range(2500)]
    rows += [(3000 + i, "a group of copies " * 9) for i in range(160)] + [(5000 + i, "small group") for i in range(30)]
    rows += [(6000, None), (6001, ""), (None, "no id"), (1, "again"), (1, "again"), (7000, "long " * 4000)]
    got = S.digest(docs_of(rows)).collect()
    assert len(got) == len(rows) and {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(t or "")
    assert all((r.size, r.text_crc32) in {(len(t.encode()) + 1, zlib.crc32(t.encode())) for t in texts[r.doc_id]} for r in got)
    sizes, slots, shards = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in got:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        shards[r.text_crc32].add(r.shard)
    assert max(sizes.values()) - min(sizes.values()) < 0.05 * sum(sizes.values()) / 8
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and set(slots) == set(range(8))
    assert all(len(x) == 1 for x in shards.values())


def test_a_group_larger_than_a_shard_is_cut(docs_of):
    got = S.digest(docs_of([(i, "the same text everywhere") for i in range(3000)] + [(5, "the same text everywhere")] * 1000)).collect()
    sizes = defaultdict(int)
    for r in got:
        sizes[r.shard] += 1
    assert len(sizes) == 8 and max(sizes.values()) < 1.3 * 4000 / 8


def test_no_documents(docs_of):
    assert S.digest(docs_of([])).count() == 0


def test_places_compare_all_columns():
    rng = np.random.default_rng(0)
    bounds = np.array(sorted({tuple(x) for x in rng.integers(0, 4, (20, 3)).tolist()}))
    keys = rng.integers(0, 4, (200, 3))
    want = [sum(tuple(b) <= tuple(k) for b in bounds.tolist()) for k in keys.tolist()]
    assert S.places(bounds, list(keys.T)).tolist() == want

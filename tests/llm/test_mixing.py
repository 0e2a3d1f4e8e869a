from __future__ import annotations

from llm_fixtures import docs_of  # noqa: F401

from shiftlens.llm import mixing as M


def reshared(sizes, weights, share, most):
    """Targets by the rule's own words: share by weight, cut, share the excess, until none is above."""
    total, target = share * sum(sizes), [0.0] * len(sizes)
    free, left = set(range(len(sizes))), total
    while True:
        unit = left / sum(weights[i] for i in free) if free else 0
        over = {i for i in free if unit * weights[i] > most * sizes[i]}
        for i in free - over:
            target[i] = unit * weights[i]
        if not over:
            return target
        for i in over:
            target[i] = most * sizes[i]
        free -= over
        left -= sum(target[i] for i in over)


def test_targets_copies_and_edges(docs_of):
    rows = [(i, "word " * (1 + i % 7), f"s{i % 5}") for i in range(200)] + [(i, "a b c", "tiny") for i in range(300, 303)]
    rows += [(400, None, None), (401, "one\ttwo\x0bthree", None), (402, "", "empty"), (None, "x y", "s1"), (7, "word " * 8, "s2"), (7, "word " * 8, "s2")]
    docs = docs_of(rows)
    got = M.digest(docs).collect()
    assert len(got) == len(rows)
    names = sorted({r[2] for r in rows if r[2] is not None}) + [None]
    sizes = [sum(len((t or "").split()) for _, t, s in rows if s == n) for n in names]
    want = dict(zip(names, reshared(sizes, [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5, 2), strict=True))
    by_id = {i: s for i, _, s in rows}
    assert all(abs(r.target - want[by_id[r.doc_id]]) < 1e-9 for r in got)
    assert all(r.taken <= 2 * r.size and r.taken == r.size * r.copies for r in got)
    assert {r.size for r in got if r.doc_id == 401} == {3} and {r.size for r in got if r.doc_id in (400, 402)} == {0}
    assert sorted((str(r.doc_id), r.taken) for r in M.digest(docs).collect()) == sorted((str(r.doc_id), r.taken) for r in got)
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)


def test_rates_come_near_their_targets(docs_of):
    docs = docs_of([(i, "w " * 5, "abc"[i % 3]) for i in range(3000)])
    taken = {r.source: r.n * 5 for r in M.mix(docs).groupBy("source").count().withColumnRenamed("count", "n").collect()}
    want = {r.source: r.target for r in M.sources(docs).collect()}
    assert all(abs(taken.get(s, 0) - t) < 0.1 * t for s, t in want.items())


def test_no_documents(docs_of):
    assert M.digest(docs_of([])).count() == 0 and M.mix(docs_of([])).count() == 0

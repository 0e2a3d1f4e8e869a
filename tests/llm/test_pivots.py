from __future__ import annotations

import numpy as np
import pytest

from shiftlens.llm import pivots as P

SCHEMA = "vec_id long, embedding array<float>, label int, id long, pivot int, near string"


def brute(rows):
    live = [(i, np.asarray(x, "f4").astype(float), lab, len(x)) for i, x, lab in rows if usable(x) and lab is not None and i is not None]
    up = {i: i for i, *_ in rows}
    links = [0] * len(live)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for p, (a, x, lab, n) in enumerate(live):
        for q, (b, y, other, m) in enumerate(live[:p]):
            if lab == other and n == m and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                links[p] += 1
                links[q] += 1
                if root(a) != root(b):
                    up[max(root(a), root(b))] = min(root(a), root(b))
    count = iter(links)
    out = []
    for i, x, lab in rows:
        used = usable(x) and lab is not None and i is not None
        out.append((i, next(count) if used else 0, None if i is None else root(i), i is None or root(i) == i))
    return sorted(out, key=str)


def usable(x):
    return x is not None and len(x) > 0 and all(v is not None and np.isfinite(v) for v in x) and any(v != 0 for v in x)


@pytest.fixture
def vectors_of(spark):
    def build(rows):
        return spark.createDataFrame([(i, None if x is None else [None if v is None else float(v) for v in x], lab, 1, 2, "c") for i, x, lab in rows], SCHEMA)

    return build


def clustered(rng, n, dim, centres, spread):
    """Vectors around few centres, some of which are near copies of others."""
    heads = rng.standard_normal((centres, dim))
    rows = []
    for i in range(n):
        x = heads[rng.integers(0, centres)] + spread * rng.standard_normal(dim)
        rows.append(x)
        if rng.random() < 0.2:
            y = rng.standard_normal(dim)
            rows.append(x + y * np.linalg.norm(x) / np.linalg.norm(y) * rng.uniform(0, 0.25))
    return rows


@pytest.mark.parametrize(("dim", "spread"), [(24, 0.05), (24, 0.3), (64, 1.0), (3, 0.3)])
def test_clustered_vectors_against_all_pairs(vectors_of, dim, spread, monkeypatch):
    monkeypatch.setattr("shiftlens.llm.neardup.BLOCK", 100)
    rng = np.random.default_rng(dim)
    rows = [(i, x, int(rng.integers(0, 3))) for i, x in enumerate(clustered(rng, 400, dim, 6, spread))]
    got = sorted((tuple(r) for r in P.linked(vectors_of(rows)).collect()), key=str)
    want = brute(rows)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert there > 30 and all(g[1] <= w[1] for g, w in zip(sorted(got), sorted(want), strict=True))
    assert found >= 0.99 * there, (found, there)


def test_large_groups_of_copies_and_near_copies(vectors_of):
    rng = np.random.default_rng(1)
    base = rng.standard_normal(32)
    rows = [(i, base, 1) for i in range(300)]
    rows += [(1000 + i, base + 0.1 * rng.standard_normal(32), 1) for i in range(300)]
    rows += [(2000 + i, rng.standard_normal(32), int(rng.integers(0, 2))) for i in range(300)] + [(5000, 3 * base, 1), (5001, -base, 1), (5002, base, 2)]
    got = sorted((tuple(r) for r in P.linked(vectors_of(rows)).collect()), key=str)
    assert got == brute(rows)


def test_edge_cases(vectors_of):
    rows = [(1, [1, 0], 1), (2, [1, 0.0], 1), (3, [1, -0.0], 1), (4, [1, 0], None), (5, [1, 0], 2), (6, None, 1), (7, [0, 0], 1), (8, [1, None], 1), (9, [1, float("nan")], 1), (10, [float("inf"), 0], 1)]
    rows += [(11, [], 1), (12, [1, 0, 0], 1), (13, [2, 0], 1), (14, [3e38, 0], 1), (15, [1e-40, 0], 1), (16, [0, 1], 1), (16, [1, 0], 1), (None, [1, 0], 1), (17, [0, 1], 1)]
    got = sorted((tuple(r) for r in P.linked(vectors_of(rows)).collect()), key=str)
    linked = {1: 6, 2: 6, 3: 6, 13: 6, 14: 6, 15: 6}
    for i, n, component, kept in got:
        if i in linked:
            assert (n, component, kept) == (6, 1, i == 1)
        elif i not in (16, 17):
            assert (n, component) == (0, i) and kept
    assert [r for r in got if r[0] in (16, 17)] == [(16, 1, 16, True), (16, 6, 1, False), (17, 1, 16, False)]
    assert P.linked(vectors_of([])).count() == 0


def test_pairs_do_not_leave_their_task(vectors_of, monkeypatch):
    real, made = P.staged, {}

    def counted(df, name):
        out = real(df, name)
        made[name] = out.count()
        return out

    monkeypatch.setattr(P, "staged", counted)
    rng = np.random.default_rng(3)
    base, rows_of = rng.standard_normal(16), {}
    for n in (150, 300):
        others = [(5000 + i, rng.standard_normal(16), 1) for i in range(200)]
        assert P.linked(vectors_of([(i, base + 0.15 * rng.standard_normal(16), 1) for i in range(n)] + others)).filter("n_links > 20").count() > n / 2
        rows_of[n] = dict(made)
    assert all(count <= 2.5 * max(rows_of[150][name], 300) for name, count in rows_of[300].items()), rows_of


def test_threshold_is_exact_and_first_shared_list_counts_once():
    x = np.array([1.0, 0.0])
    y = np.array([0.98, np.sqrt(1 - 0.98**2)])
    assert P.exact(x, y) == P.exact(y, x)
    rng = np.random.default_rng(2)
    sample = rng.standard_normal((3000, 12))
    pivots = P.far_apart(sample / np.linalg.norm(sample, axis=1)[:, None], 200)
    assert len(pivots) == 200 and (pivots @ pivots.T - 2 * np.eye(200)).max() < P.APART
    near = P.nearest(pivots, pivots)
    assert near.shape == (200, P.NEAREST) and all(i in row for i, row in enumerate(near))

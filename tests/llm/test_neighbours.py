from __future__ import annotations

import numpy as np

from shiftlens.llm import neighbours as N


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, place int, query string")


def brute(rows, k, every):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    out = {}
    for i, q in zip(ids.tolist(), x, strict=True):
        if i % every == 0:
            score = (q * x).sum(axis=1)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(N, "ROWS", 64)
    monkeypatch.setattr(N, "QUERIES", 16)
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(1500, 20)) * rng.uniform(0.5, 2, (1500, 1)))]
    got, want = found(N.nearest(table(spark, rows))), brute(rows, 20, 20)
    assert set(got) == set(want) and all(len(x) == 20 for x in got.values())
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9
    exact = {(q, i): s for q, x in brute(rows, 1500, 20).items() for i, s in x}
    assert all(abs(exact[q, i] - s) < 1e-12 for q, x in got.items() for i, s in x)


def test_equal_vectors_tie_to_the_smaller_id(spark):
    same = [1.0, 2.0, 3.0, 4.0]
    rows = [(i, same) for i in range(300)] + [(i, [float(i), 1.0, -1.0, 0.5]) for i in range(300, 330)]
    got, want = found(N.nearest(table(spark, rows), k=5)), brute(rows, 5, 20)
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}


def test_few_rows_and_rows_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0]), (20, [0.0, 1.0])]
    odd = [(3, None), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (40, None), (1, [0.5, 0.5])]
    got = found(N.nearest(table(spark, rows + odd)))
    assert got == brute(rows, 20, 20)
    assert N.nearest(table(spark, [])).count() == 0 and N.nearest(table(spark, rows[:1])).count() == 0


def test_transform_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(7, 16))
    assert np.allclose(np.linalg.norm(N.hadamard(x), axis=1), np.linalg.norm(x, axis=1)) and np.allclose(N.hadamard(N.hadamard(x)), x)

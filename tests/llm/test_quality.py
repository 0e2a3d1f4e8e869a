from __future__ import annotations

import zlib

import numpy as np
import pytest

from llm_fixtures import docs_of  # noqa: F401

from shiftlens.llm import quality as Q


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefgh"), rng.integers(1, 9)))
    good = lambda: (" ".join(word() for _ in range(rng.integers(5, 150)))).capitalize() + "."
    junk = [
        lambda: " ".join(word() + "***" for _ in range(60)), lambda: " ".join([word()] * 50), lambda: " | ".join(word() for _ in range(40)),
    ]
    return [(i, junk[i % 3](), 0) if i % 6 == 0 else (i, good(), 1) for i in range(900)]


def labels(spark, rows):
    return spark.createDataFrame([(i, q, 0, "x") for i, q in rows], "doc_id long, quality int, toxic int, score string")


def test_held_out_accuracy_and_edges(spark, docs_of, texts):
    known = labels(spark, [(i, q) for i, _, q in texts if i % 2 == 0] + [(None, 1), (3, None), (10**6, 1), (0, 0)])
    docs = docs_of([(i, t) for i, t, _ in texts] + [(2000, None), (2001, ""), (None, "No id."), (2, "a " * 200_000), (2, "a " * 200_000)])
    got = Q.scored(docs, known).collect()
    assert len(got) == len(texts) + 5
    want = {i: q for i, _, q in texts}
    held = [r for r in got if r.held_out and r.doc_id in want and r.doc_id != 2]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert np.mean([r.predicted == want[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert sorted((str(r.doc_id), r.score) for r in Q.scored(docs, known).collect()) == sorted((str(r.doc_id), r.score) for r in got)
    kept = Q.keep_good(docs, known)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got)


def test_labels_of_the_held_out_fold_change_nothing(spark, docs_of, texts):
    docs = docs_of([(i, t) for i, t, _ in texts])
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    plain = Q.scored(docs, labels(spark, [(i, q) for i, _, q in texts]))
    turned = Q.scored(docs, labels(spark, [(i, 1 - q if held(i) else q) for i, _, q in texts]))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, turned.collect()))


def test_without_labels_or_documents(spark, docs_of):
    none = labels(spark, [])
    assert [(r.score, r.predicted) for r in Q.scored(docs_of([(1, "x"), (2, None)]), none).collect()] == [(0.5, 1)] * 2
    assert Q.scored(docs_of([]), none).count() == 0 and Q.keep_good(docs_of([]), none).count() == 0


def test_best_bin_and_risk():
    rng = np.random.default_rng(9)
    p, u = rng.normal(2, 1, 4000), np.concatenate([rng.normal(2, 1, 2800), rng.normal(-2, 1, 1200)])
    assert abs(Q.best_bin(p, u) - 0.7) < 0.05
    x = rng.normal(0, 1, (1200, Q.WIDTH))
    y = rng.random(1200) < 0.7
    x[y, :40] += 2
    net, prior = Q.fit(x[y][:300], x, 0.7)
    assert prior == 0.7 and np.mean((net(net.scaled(x)) > 0) == y) > 0.9


@pytest.mark.parametrize("shift", [0.0, -4.0])
def test_risk_and_its_derivative_against_plain_computation(shift):
    rng = np.random.default_rng(11)
    z, n, prior = rng.normal(0, 2, 60), 20, 0.6
    z[n:] += shift
    loss = lambda y, x: np.log(1 + np.exp(-y * x))
    positive = prior * sum(loss(1, x) for x in z[:n]) / n
    negative = sum(loss(-1, x) for x in z[n:]) / 40 - prior * sum(loss(-1, x) for x in z[:n]) / n
    assert np.allclose(Q.risks(z, n, prior), (positive, negative))
    below = negative < -Q.SLACK
    assert below == (shift < 0)
    # non-negative estimator: while the risk of negatives is below zero the step goes up that part alone
    of = (lambda v: -Q.risks(v, n, prior)[1]) if below else (lambda v: sum(Q.risks(v, n, prior)))
    step, want = 1e-6, np.empty(60)
    for i in range(60):
        up, down = z.copy(), z.copy()
        up[i] += step
        down[i] -= step
        want[i] = (of(up) - of(down)) / (2 * step)
    assert np.allclose(Q.descent(z, n, prior), want, atol=1e-7)

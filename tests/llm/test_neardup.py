from __future__ import annotations

import re
from collections import defaultdict

import numpy as np

from llm_fixtures import docs_of  # noqa: F401

from shiftlens.llm import neardup as N


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in rows if i is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    live = [(i, s) for i, s in sets if i is not None and s]
    for k, (a, s) in enumerate(live):
        for b, t in live[:k]:
            n = len(s & t)
            if 100 * n >= 85 * (len(s) + len(t) - n) and root(a) != root(b):
                up[max(root(a), root(b))] = min(root(a), root(b))
    return sorted(((i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets), key=str)


def near_copies(seed=0):
    rng = np.random.default_rng(seed)
    word = lambda: "v" + str(rng.integers(0, 4000))
    base = [word() for _ in range(120)]
    rows, i = [], 10
    for edits in (0, 1, 1, 2, 2, 3, 3, 4, 5, 8):
        for _ in range(12):
            w = list(base)
            for p in rng.integers(0, len(w), edits):
                w[p] = word()
            rows.append((i, " ".join(w)))
            i += 1
    chain = [word() for _ in range(100)]
    for step in range(12):
        rows.append((1000 + step, " ".join(chain)))
        chain[step * 8 % 100] = word()
    rows += [(2000 + k, " ".join(word() for _ in range(rng.integers(1, 90)))) for k in range(40)]
    rows += [(1, "one two three"), (2, "ONE\ttwo\x0bthree"), (3, "one two three four"), (4, None), (5, ""), (6, " \n"), (7, "é É a b c d"), (8, "É É a b c d")]
    rows += [(None, " ".join(base)), (None, None), (9, " ".join(base[:60])), (9, " ".join(base[:60])), (3000, " ".join(base * 40))]
    return rows


def test_components_against_all_pairs(docs_of, monkeypatch):
    monkeypatch.setattr(N, "FAN", 7)
    rows = near_copies()
    got = sorted((tuple(r) for r in N.grouped(docs_of(rows)).collect()), key=str)
    assert got == brute(rows)


def test_blocks_of_large_buckets(docs_of, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 5)
    rows = near_copies(3)
    assert sorted((tuple(r) for r in N.grouped(docs_of(rows)).collect()), key=str) == brute(rows)


def test_keep_one_and_no_documents(docs_of):
    docs = docs_of([(3, "a b c d e f g"), (2, "A b c d e f g"), (5, "other words"), (None, "a b c d e f g"), (6, None)])
    left = N.keep_one(docs)
    assert left.columns == docs.columns and sorted(str(r.doc_id) for r in left.collect()) == ["2", "5", "6", "None"]
    assert N.grouped(docs_of([])).count() == 0


def naive_signature(elements):
    m = (1 << 64) - 1

    def mix(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & m
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & m
        return x ^ (x >> 31)

    least = [m] * N.SLOTS
    for x in elements:
        p = list(range(N.SLOTS))
        for j in range(N.SLOTS):
            draw = mix((x + int(N.GOLDEN) * (j + 1)) & m)
            k = j + ((mix(draw) >> 32) * (N.SLOTS - j) >> 32)
            p[j], p[k] = p[k], p[j]
            least[p[j]] = min(least[p[j]], (j << 55) | (draw >> 9))
    return least


def test_early_stopping_changes_no_signature():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (1, 2, 9, 40, 300, 900)]
    assert N.signatures(sets).tolist() == [naive_signature(s.tolist()) for s in sets]


def test_parts_of_texts_and_sets_give_the_same(monkeypatch):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 99, n)).encode() for n in (0, 3, 400, 2000)] + [b"", b" \t ", b"x" * 900, b"A\x0bb " * 300]
    whole = N.shingle_sets(texts)
    signed = N.signature_of_all([s for s in whole if len(s)])
    assert signed.tolist() == N.signatures([s for s in whole if len(s)]).tolist()
    monkeypatch.setattr(N, "SLAB", 50)
    monkeypatch.setattr(N, "PORTION", 64)
    assert [s.tolist() for s in N.shingle_sets(texts)] == [s.tolist() for s in whole]
    assert N.signature_of_all([s for s in whole if len(s)]).tolist() == signed.tolist()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(6)
    errors = defaultdict(list)
    for n in (60, 400):
        for _ in range(20):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            b = np.unique(np.concatenate([a[: int(0.9 * n)], rng.integers(0, 1 << 63, n // 10, dtype=np.uint64)]))
            s = N.signatures([a, b])
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            errors[n].append((s[0] == s[1]).mean() - true)
    for n, e in errors.items():
        assert abs(np.mean(e)) < 0.01 and np.std(e) < 0.02, n


def links(rows, percent):
    """Components by comparing all pairs at ``percent``."""
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}
    for a in sets:
        for b in sets:
            n = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                low, high = sorted((label[a], label[b]))
                label = {i: low if x == high else x for i, x in label.items()}
    return label


def test_pipeline_stage_links_from_four_fifths(spark, docs_of):
    import corpus_pipeline

    rows = [(i, t) for i, t in dict(near_copies(7)).items() if i is not None]
    rows += [(5000, "a b c d e f g h"), (5001, "a b c d e f g h i"), (5002, "p q r s t u v"), (5003, "p q r s t u v w")]
    label = links(rows, 80)
    assert label[5001] == 5000 and label[5003] == 5003 and label != links(rows, 85)
    docs = docs_of(rows)
    assert {r.doc_id: r.component_id for r in N.grouped(docs, 80).collect()} == label
    left = dict(corpus_pipeline.STAGES)["neardup"](spark, docs, "")
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i in label if label[i] == i)


def test_bands_and_least_sets_follow_the_threshold():
    for percent in (80, 85, 90):
        n = N.only_equal(percent)
        assert 100 * n < percent * (n + 1) and 100 * (n + 1) >= percent * (n + 2)
    assert (N.only_equal(80), N.only_equal(85), N.bands_of(80), N.bands_of(85)) == (3, 5, 41, 28)


def test_texts_that_share_a_doc_id(docs_of):
    a = [f"a{i}" for i in range(60)]
    near, other, third = " ".join(a[:-1] + ["z"]), " ".join(f"b{i}" for i in range(60)), " ".join(f"c{i}" for i in range(60))
    # 7 has a near copy of 3 and a text like no other; 20 has two texts, each with a near copy
    rows = [(3, " ".join(a)), (7, near), (7, other), (20, third), (20, third.upper() + " x"), (20, other + " y"), (21, "q " + third), (22, None), (22, third)]
    docs = docs_of(rows)
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in N.grouped(docs).collect())
    assert got == sorted([(3, 56, 3, True), (7, 56, 3, False), (7, 56, 7, True), (20, 56, 20, True), (20, 57, 20, True), (20, 57, 7, False), (21, 57, 20, False), (22, 0, 22, True), (22, 56, 20, False)])
    left = [(r.doc_id, r.text) for r in N.keep_one(docs).collect()]
    of_20 = [x for x in left if x[0] == 20]
    assert len(of_20) == 1 and of_20[0][1] in (third, third.upper() + " x")
    assert sorted(x for x in left if x[0] != 20 and x[1]) == [(3, " ".join(a)), (7, other)] and (22, None) in left and len(left) == 4


def test_rows_repeated_whole_stay_once(docs_of):
    text, near = " ".join(f"a{i}" for i in range(60)), " ".join(f"a{i}" for i in range(59))
    alone = [(5, "other words"), (None, "no id"), (None, "no id"), (6, None), (6, None)]
    docs = docs_of([(3, text)] * 4 + [(4, near)] * 3 + [(9, "x y z")] * 2 + [(3, near)] + alone)
    left = N.keep_one(docs)
    assert left.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
    assert [x for x in got if x[0] == 3] in ([(3, text)], [(3, near)])
    assert [x for x in got if x[0] != 3] == sorted([(9, "x y z"), *alone], key=str)


def unlinked(n, edits, seed=1):
    """Texts around one base, near each other but rarely linked."""
    rng = np.random.default_rng(seed)
    base = [f"b{i}" for i in range(400)]
    rows = []
    for i in range(n):
        w = list(base)
        for p in rng.choice(80, edits, replace=False):
            w[p * 5] = f"e{i}x{p}"
        rows.append((i, " ".join(w)))
    return rows


def test_refuted_pairs_stay_in_their_task(docs_of, monkeypatch):
    real, made = N.staged, {}

    def counted(df, name):
        out = real(df, name)
        made[name] = made.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(N, "staged", counted)
    for percent, edits in ((80, 6), (85, 5)):
        rows_of = {}
        for n in (150, 300):
            rows, known = unlinked(n, edits), made.clear()
            got = {r.doc_id: r.component_id for r in N.grouped(docs_of(rows), percent).collect()}
            assert known is None and got == links(rows, percent)
            rows_of[n] = dict(made)
        assert rows_of[300]["crossing"] > 0 and len(set(got.values())) > 30, (rows_of, len(set(got.values())))
        for name, count in rows_of[300].items():
            assert count <= 2.5 * max(rows_of[150][name], 300), (percent, name, rows_of)

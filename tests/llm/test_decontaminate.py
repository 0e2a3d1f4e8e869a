from __future__ import annotations

import re

import pytest

from llm_fixtures import docs_of, word  # noqa: F401

from shiftlens.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    grams = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for p in range(len(w) - n + 1) if n else ():
            grams.setdefault(tuple(w[p : p + n]), set()).add(str(item) if item is not None else "null")
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(g) for g in grams}:
            for p in range(len(w) - n + 1):
                if (g := tuple(w[p : p + n])) in grams:
                    hit |= set(range(p, p + n))
                    found |= grams[g]
        out.append((i, len(w), len(hit), len(found), bool(hit)))
    return sorted(out, key=str)


def test_hits_items_and_edges(spark, docs_of, word):
    long_item = " ".join(word(i) for i in range(14))
    items = [(1, long_item), (2, "Short one"), (3, None), (4, "...!"), (2, "Short one"), (10, " ".join(word(i) for i in range(4, 16)))]
    docs = [
        (1, "x " + long_item.upper() + " y"), (2, None), (3, ""), (4, "a SHORT, one. é"), (5, long_item[:-6]), (6, " ".join(word(i) for i in range(9))),
        (7, (long_item + "; ") * 3), (7, (long_item + "; ") * 3), (None, "short one"), (8, "nothing here"), (9, "k " * 30_000 + "short-one"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.digest(docs_of(docs), bench)
    rows = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got.collect()), key=str)
    assert rows == brute(docs, items)
    assert D.digest(docs_of([]), bench).count() == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in D.digest(docs_of(docs), empty).collect()} == {0}


def test_cleaning(spark, docs_of, word):
    item = " ".join(word(i) for i in range(12))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = docs_of([(1, f"Keep this. {item}, and that!"), (2, "clean text"), (None, None), (3, item), (3, item)])
    left = D.clean(docs, bench)
    assert left.columns == docs.columns and sorted(map(str, [r.doc_id for r in left.collect()])) == ["2", "None"]
    cut = {r.doc_id: r.text for r in D.clean(docs, bench, "spans").collect()}
    assert words(cut[1]) == ["keep", "this", "and", "that"] and cut[2] == "clean text" and cut[None] is None and words(cut[3]) == []
    with pytest.raises(ValueError):
        D.clean(docs, bench, "other")


def test_larger_sets_are_joined_by_shuffle(spark, docs_of, word, monkeypatch):
    monkeypatch.setattr(D, "SET_ROWS", 1)
    item = " ".join(word(i) for i in range(15))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [r.n_hit for r in D.digest(docs_of([(1, item)]), bench).collect()] == [15]

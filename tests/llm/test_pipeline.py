from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline as P
from llm_fixtures import docs_of  # noqa: F401
from shiftlens.llm import decontaminate, mixing, neardup, quality
from shiftlens.llm.queries import QUERIES, SQL, table, tokenizer

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA) or not os.path.exists(tokenizer("word_bpe_49k.json")), reason="no test data")


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_with_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str) == want


def test_registered():
    found = entry.queries()
    assert set(QUERIES) | {"pipeline"} <= set(found) and set(SQL) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages_follow_their_operators(spark, tmp_path):
    docs = table(spark, DATA, "documents")
    names = docs.columns
    kept = []
    for k, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, DATA)
        out.write.parquet(str(tmp_path / str(k)))
        last, docs = docs, spark.read.parquet(str(tmp_path / str(k)))
        kept.append((last, docs))
        assert k == len(P.STAGES) - 1 or docs.columns == names
    ids = [[sorted(r.doc_id for r in x.select("doc_id").collect()) for x in pair] for pair in kept]
    good = quality.scored(kept[0][0], table(spark, DATA, "labels")).filter("predicted = 1")
    assert ids[0][1] == sorted(r.doc_id for r in good.collect())
    assert ids[1][1] == sorted(r.doc_id for r in neardup.grouped(kept[1][0], P.NEAR).filter("kept").collect())
    clean = decontaminate.digest(kept[2][0], table(spark, DATA, "benchmark")).filter("not contaminated")
    assert ids[2][1] == sorted(r.doc_id for r in clean.collect())
    copies = mixing.digest(kept[3][0]).collect()
    assert ids[3][1] == sorted(i for r in copies for i in [r.doc_id] * r.copies)
    assert ids[4][1] == ids[3][1]
    assert [tuple(r) for r in P.run(spark, DATA).orderBy("start").collect()] == [tuple(r) for r in docs.orderBy("start").collect()]


def staged(spark, docs, folder):
    out = []
    for k, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, DATA).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append((name, docs))
    return out


def test_odd_rows_pass_every_stage(spark, docs_of, tmp_path):
    words = [" ".join(f"a{i}b{j}" for j in range(40)) for i in range(30)]
    odd = [(100, None), (101, ""), (102, " \n\t"), (None, "no id at all here"), (None, None), (103, "x " * 60_000), (104, "short")]
    rows = [(i, t) for i, t in enumerate(words)] + odd + [(5, words[5])] * 3 + [(200, words[7].upper()), (201, words[7] + " more")]
    docs = docs_of(rows)
    done = staged(spark, docs, str(tmp_path))
    for name, out in done[:-1]:
        assert out.columns == docs.columns, name
    kept = dict(done)["neardup"]
    ids = sorted(str(r.doc_id) for r in kept.filter("doc_id IN (5, 7, 200, 201)").collect())
    assert ids in (["5", "7"], ["5"], ["7"], [])  # of repeated rows and near copies one is left, unless the classifier rejected it
    assert dict(done)["tokens"].count() == dict(done)["mixing"].count()


def test_no_documents_pass_every_stage(spark, docs_of, tmp_path):
    done = staged(spark, docs_of([]), str(tmp_path))
    assert [out.count() for _, out in done] == [0] * len(P.STAGES)
    assert neardup.keep_one(docs_of([]), P.NEAR).count() == 0

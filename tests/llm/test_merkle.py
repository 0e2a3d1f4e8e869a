from __future__ import annotations

import hashlib
import zlib

import pytest

from llm_fixtures import docs_of  # noqa: F401

from shiftlens.llm import merkle as M


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, source, n_chars):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, None, n_chars, text)))


def tree(nodes):
    """Root and, per node, its siblings by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            run = nodes[p // 16 * 16 : p // 16 * 16 + 16]
            paths[i].append((run[: p % 16], run[p % 16 + 1 :]))
        nodes, at = [h("".join(nodes[k : k + 16])) for k in range(0, len(nodes), 16)], [p // 16 for p in at]
    return nodes[0], paths


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    by_source = {}
    for doc_id, text, source in rows:
        n = len(text or "")
        by_source.setdefault(source, []).append((doc_id, leaf(doc_id, text, source, n), leaf(doc_id, lower(text), source, n)))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by_source[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = tree([x[1] for x in by_source[s]])
    root, tops = tree([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops, strict=True):
        for (doc_id, own, changed), path in zip(by_source[s], trees[s][1], strict=True):
            siblings = path + top
            cur = changed if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 else own
            for left, right in siblings:
                cur = h("".join(left) + cur + "".join(right))
            proof = h("".join("".join(left) + "".join(right) for left, right in siblings))
            out.append((doc_id, own, trees[s][0], root, proof, cur, cur == root))
    return sorted(out, key=str)


def rows_of(n):
    rows = [(i, f"Text {i} " + "ÄB é" * (i % 3), f"s{i % 3}" if i % 7 else "s0") for i in range(n)]
    return rows + [(5000, None, None), (5001, "", None), (5002, "Long" * 50_000, "Ünter"), (5003, "one", "lone"), (None, "No Id", "s1"), (7, "Again", "s1"), (8, "twice", "s2"), (8, "twice", "s2")]


@pytest.mark.parametrize("n", [0, 90, 1300])
def test_against_a_plain_tree(docs_of, n):
    rows = rows_of(n)
    got = sorted((tuple(r) for r in M.digest(docs_of(rows)).collect()), key=str)
    assert got == brute(rows)
    assert any(r[6] for r in got) and (n == 0 or not all(r[6] for r in got))


def test_many_sources_and_small_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 16)
    monkeypatch.setattr(M, "LEVELS", 1)
    rows = [(i, f"T{i}", f"src{i % 40}") for i in range(150)] + [(1000 + i, "x", "big") for i in range(300)]
    assert sorted((tuple(r) for r in M.digest(docs_of(rows)).collect()), key=str) == brute(rows)


def test_frontier_extends_witnesses_as_siblings_complete():
    nodes = [h(str(i)).encode() for i in range(37)]
    frontier = M.Frontier(2)
    for i, node in enumerate(nodes):
        frontier.append(node)
        assert frontier.witness[i][0] == b"".join(nodes[i // 16 * 16 : i])
        done = (i + 1) // 16 * 16
        # the right part comes with the last sibling, not before
        assert all((len(p) > 1) == (k < done) for k, p in enumerate(frontier.witness))
    root = frontier.close()
    assert root.decode() == tree([n.decode() for n in nodes])[0]
    assert all(M.folded(n, p) == root for n, p in zip(nodes, frontier.witness, strict=True))


def test_append_equals_building_at_once(docs_of, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 16)
    monkeypatch.setattr(M, "LEVELS", 1)
    parts = [[(i, f"T{i}", f"s{i % 2}") for i in range(a, b)] for a, b in ((0, 70), (70, 71), (71, 400))]
    parts[2] += [(9, "new source", "a"), (10, "new source", "a")]
    manifest = None
    for part in parts:
        manifest = M.append(docs_of(part), manifest)
    got = sorted((tuple(r)[:6] for r in M.proofs(manifest).collect()), key=str)
    whole = M.append(docs_of(sum(parts, [])))
    assert got == sorted((tuple(r)[:6] for r in M.proofs(whole).collect()), key=str)
    assert got[0][3] == brute(sum(parts, []))[0][3]
    with pytest.raises(ValueError, match="follow"):
        M.append(docs_of([(5, "late", "s1")]), manifest)


def test_append_reads_only_touched_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 16)
    monkeypatch.setattr(M, "LEVELS", 1)
    manifest = M.append(docs_of([(i, f"T{i}", "s") for i in range(160)]))
    real, made = M.staged, []

    def counted(df, name):
        out = real(df, name)
        made.append((name, out.count()))
        return out

    monkeypatch.setattr(M, "staged", counted)
    M.append(docs_of([(500, "more", "s")]), manifest)
    assert [n for name, n in made if name == "roots"] == [1, 1]


def test_no_documents(docs_of):
    assert M.digest(docs_of([])).count() == 0
    assert M.digest(docs_of([(1, "a")])).first().verified is True

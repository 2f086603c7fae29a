import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF, no_docs, odd, odd_docs, odd_path  # noqa: F401

from tidewater.llm import merkle as M
from tidewater.llm import queries as Q


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, add=0):
    vals = [row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"]]
    if add and vals[3] is not None:
        vals[3] += add
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in vals])


def climb(level):
    """Root, and for each leaf its (side, sibling) steps, by whole levels."""
    ways = [[] for _ in level]
    place = list(range(len(level)))
    while len(level) > 1:
        for w, p in zip(ways, range(len(ways))):
            at = place[p]
            b = at ^ 1
            w.append(None if b >= len(level) else ("L" if b < at else "R", level[b]))
            place[p] = at // 2
        level = [H(*level[i:i + 2]) for i in range(0, len(level), 2)]
    return level[0], ways


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees[g] = climb([leaf_of(r) for r in groups[g]])
    root, above = climb([trees[g][0] for g in names])
    out = []
    for g, up in zip(names, above):
        for r, way in zip(groups[g], trees[g][1]):
            d = leaf_of(r)
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            folded = leaf_of(r, 1) if hit else d
            for step in way + up:
                folded = H(folded) if step is None else H(step[1], folded) if step[0] == "L" else H(folded, step[1])
            proof = H(*[s[1] for s in way + up if s])
            out.append((r["doc_id"], d, trees[g][0], root, proof, folded, folded == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("levels", range(1, 11))
def test_layout_is_a_bijection_with_aligned_subtrees(levels):
    at = [M.address(levels, d, np.arange(1 << d)) for d in range(levels)]
    assert sorted(np.concatenate(at).tolist()) == list(range((1 << levels) - 1))
    top = levels // 2
    if top:
        assert sorted(np.concatenate(at[:top]).tolist()) == list(range((1 << top) - 1))
        size = (1 << (levels - top)) - 1
        for k in range(1 << top):   # each lower subtree fills one run of places
            mine = np.concatenate([at[d][k << (d - top):(k + 1) << (d - top)] for d in range(top, levels)])
            assert sorted(mine.tolist()) == list(range((1 << top) - 1 + k * size, (1 << top) - 1 + (k + 1) * size))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 70))
def test_block_root_nodes_and_ways(n):
    low = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    levels = M.block_levels(n, 12)
    nodes = bytearray(((1 << levels) - 1) * 32)
    root = M.build(nodes, 0, levels, low).hex()
    want, ways = climb([d.hex() for d in low])
    assert root == want == nodes[:32].hex()
    got = M.ways(bytes(nodes), levels, n)
    assert got == [["-" if s is None else s[0] + s[1] for s in w] for w in ways]
    assert all(M.fold(d.hex(), w) == root for d, w in zip(low, got))
    assert M.fold("0" * 64, got[0]) != root


@pytest.mark.parametrize("height", [1, 2, 3, 12])
def test_proofs_match_brute_force(spark, odd, height):  # noqa: F811
    docs = odd.selectExpr("*", "1 AS g", "2 AS idx", "3 AS digest", "4 AS leaf", "5 AS root")
    rows = [r.asDict() for r in odd.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    for i, r in enumerate(rows):
        r["lang"] = [None, "en", "é", "", "z"][i * i % 5]
    docs = spark.createDataFrame([tuple(r.values()) for r in rows], "doc_id bigint, source string, lang string, n_chars bigint, text string") \
        .repartition(3).selectExpr("*", "1 AS g", "2 AS idx", "3 AS digest", "4 AS leaf")
    got = sorted((tuple(r) for r in M.document_proofs(docs, height).collect()), key=str)
    assert got == brute(rows)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


@pytest.mark.parametrize("n", [1, 2, 33])
def test_one_group_and_copies(spark, n):
    rows = [{"doc_id": 7, "source": "s", "lang": "en", "n_chars": None, "text": "same"} for _ in range(n)]
    docs = spark.createDataFrame([tuple(r.values()) for r in rows], "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert sorted((tuple(r) for r in M.document_proofs(docs, 2).collect()), key=str) == brute(rows)


def test_stored_manifest_answers_proofs(spark, tmp_path):
    docs = spark.createDataFrame([(i, "en" if i % 3 else "fr", f"t{i}") for i in range(40)], "doc_id bigint, lang string, text string")
    rows = docs.select("doc_id", "lang", M.row_digest([docs["doc_id"], docs["text"]]).alias("d"))
    made = M.manifest(rows, "lang", ["doc_id"], "d", height=2)
    made.write(str(tmp_path / "m"))
    again = {(r["tree"], r["round"], r["g"], r["block"]): r for r in spark.read.parquet(str(tmp_path / "m")).collect()}
    assert len(again) == made.nodes().count()
    for r in made.leaves.collect():   # from the stored blocks alone, up to the root
        d, g, at, tree, n, rnd = r["digest"].hex(), r["g"], r["idx"], "group", r["n"], 0
        while True:
            b = again[tree, rnd, g, at >> 2]
            d = M.fold(d, M.ways(bytes(b["nodes"]), M.block_levels(n, 2), b["leaves"])[at & 3])
            if n > 4:
                at, n, rnd = at >> 2, -(-n // 4), rnd + 1
            elif tree == "group":
                tree, g, at, n, rnd = "top", "", ["=en", "=fr"].index(g), 2, 0
            else:
                break
        assert d == made.root


def test_no_rows(no_docs):  # noqa: F811
    out = M.document_proofs(no_docs)
    assert out.collect() == [] and out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_query_matches_brute_force(spark):
    got = sorted((tuple(r) for r in Q.op12_merkle_manifest(spark, SF).collect()), key=str)
    rows = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got == brute(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert sorted(con.execute(M.oracle()).fetchall(), key=str) == got

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import DOCS, no_docs, odd, odd_docs, odd_path, prose  # noqa: F401

from tidewater.llm import fingerprints as P


def brute_entropy(w):
    c = Counter(w)
    s = sum(round(n * math.log2(n) * (1 << 20)) for n in c.values())
    top = round(P.WINDOW * math.log2(P.WINDOW) * (1 << 20))
    return (top - s) * P.SCALE // top


def brute_features(data, ranks):
    """(window, hash seed) by the rules of the docstring, one at a time."""
    n = len(data) - P.WINDOW + 1
    got = []
    if n > 0:
        r = [ranks[brute_entropy(data[i:i + P.WINDOW])] for i in range(n)]
        runs = [min(range(i, i + P.REACH), key=lambda j: (r[j], j)) for i in range(n - P.REACH + 1)] or [min(range(n), key=lambda j: (r[j], j))]
        votes = Counter(runs)
        got = [(j, data[j:j + P.WINDOW], 0) for j, v in votes.items() if v >= min(P.VOTES, max(votes.values()))]
    if len(data) < 256:
        got += [(j, data[j:j + 8], min(len(data), 8) + 1) for j in range(max(len(data) - 7, 1))]
    return list(dict.fromkeys((w, seed) for _, w, seed in sorted(got, key=lambda g: g[0])))


def test_entropies_and_features_match_brute_force(monkeypatch):
    rng = random.Random(1)
    texts = [b"", b"x", b"y" * 31, b"z" * 32, bytes(range(40)), b"ab" * 23, b"ab" * 24, bytes(rng.randrange(4) for _ in range(47)),
             bytes(rng.randrange(256) for _ in range(49)), bytes(rng.randrange(256) for _ in range(50)), b"q" * 500,
             b"a" * 20 + bytes(range(100, 140)), bytes(range(100, 140)) + b"a" * 40,
             bytes(rng.randrange(97, 110) for _ in range(3000))]
    texts += [prose(rng, rng.randrange(1, 60)).encode() for _ in range(40)]
    counts = Counter(brute_entropy(t[i:i + P.WINDOW]) for t in texts for i in range(len(t) - P.WINDOW + 1))
    for block in (1 << 20, 700):   # also with texts longer than a block
        monkeypatch.setattr(P, "_BLOCK", block)
        hist = P.histogram(texts)
        assert {e: int(n) for e, n in enumerate(hist) if n} == dict(counts)
        ranks = P.rank_table(hist)
        assert sorted(ranks) == list(range(P.SCALE + 1))
        base = 0
        for run in P._batches(texts):
            owner, hashes = P._features(run, ranks)
            for i, t in enumerate(run):
                want = [int(P._hashes(np.frombuffer(w.ljust(P.WINDOW, b"\0"), dtype=np.uint8)[None], seed)[0])
                        for w, seed in brute_features(t, ranks)]
                assert sorted(hashes[owner == i].tolist()) == sorted(want), (block, base + i)
            base += len(run)


def test_rare_entropies_come_first_and_weak_ones_last():
    counts = np.zeros(P.SCALE + 1, dtype=np.int64)
    counts[500], counts[600], counts[20] = 10, 3, 1
    ranks = P.rank_table(counts)
    assert ranks[700] < ranks[600] < ranks[500] < ranks[20]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=300), st.text(max_size=300))
def test_likeness_is_symmetric_and_one_for_equal_texts(a, b):
    ranks = P.rank_table(np.arange(P.SCALE + 1))
    x, y, again = P.digests([a, b, a], ranks)
    assert P.likeness(x, again) == 1 and x.text() == again.text()
    assert P.likeness(x, y) == P.likeness(y, x)
    assert 0 <= P.likeness(x, y) <= 1
    assert P.likeness(P.Digest.parse(x.text()), P.Digest.parse(y.text())) == P.likeness(x, y)


def test_likeness_follows_the_shared_part():
    rng = random.Random(3)
    a, b = prose(rng, 2000), prose(rng, 2000, words=9000)
    ranks = P.rank_table(P.histogram([a.encode(), b.encode()]))
    cuts = [a[:len(a) * k // 4] + b[:len(b) * (4 - k) // 4] for k in range(5)]
    base = P.digests([a], ranks)[0]
    near = [P.likeness(base, d) for d in P.digests(cuts, ranks)]
    assert near == sorted(near) and near[0] < 0.1 and 0.6 < near[3] < 0.9 and near[4] == 1
    moved = P.digests(["an opening of its own " + a], ranks)[0]
    assert P.likeness(base, moved) > 0.8


def brute_table(rows, ranks):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        k = len(t) // 4
        edited = t[:len(t) - k] + after[:k]
        p, q, f = P.digests([t, edited, after], ranks)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), p.text(), q.text(), P.likeness(p, q), P.likeness(p, f)))
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 57])
def test_edited_fingerprints_match_brute_force(spark, n):
    rng = random.Random(n)
    rows = [(i * 7, prose(rng, rng.randrange(1, 200))) for i in range(n)]
    rows[0] = (None, rows[0][1])
    rows[-1] = (rows[-1][0], "")
    shuffled = rng.sample(rows, n)
    docs = spark.createDataFrame(shuffled, "doc_id bigint, text string").repartition(3).selectExpr("*", "1 AS part", "'x' AS fingerprint")
    got = [tuple(r) for r in P.edited_fingerprints(docs).collect()]
    assert sorted(got, key=str) == sorted(brute_table(rows, P.rarity(docs)), key=str)


def test_odd_rows_and_hot_ids(odd, spark):  # noqa: F811
    rows = P.edited_fingerprints(odd).collect()
    assert len(rows) == odd.count()
    by_text = {}
    for r in odd.collect():
        by_text.setdefault((r["doc_id"], len(r["text"] or "")), set()).add(r["text"] or "")
    assert all((r["doc_id"], r["n_chars"]) in by_text for r in rows)
    assert all(r["fingerprint"] and 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    hot = spark.createDataFrame([(1, "the same text " * 20)] * 60 + [(i, f"text {i} " * 9) for i in range(2, 30)], "doc_id bigint, text string")
    got = P.edited_fingerprints(hot).collect()
    assert len(got) == 88 and sum(r["near_next"] == 1 and r["near_edited"] > 0 for r in got if r["doc_id"] == 1) >= 59
    assert len({r["fingerprint"] for r in got if r["doc_id"] == 1}) == 1


def test_columns_for_any_text(spark, no_docs):  # noqa: F811
    df = spark.createDataFrame([("some words that make a text " * 9,), (None,)], "t string")
    ranks = P.rarity(df, "t")
    f = df.select("t", P.fingerprint(df["t"], ranks).alias("f"))
    rows = f.select("t", "f", P.similarity("f", "f").alias("s")).collect()
    assert all(r["s"] == 1 for r in rows) and len({r["f"] for r in rows}) == 2
    assert P.edited_fingerprints(no_docs).collect() == []

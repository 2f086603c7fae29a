import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_fixtures import no_docs, odd, odd_docs, odd_path  # noqa: F401

from tidewater.llm import decontaminate as D
from tidewater.llm import ngram_join as N
from tidewater.llm import ranks as R
from tidewater.llm import suffix_dedup as S
from tidewater.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def word_sets(rows):
    out = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        n = min(5, len(w))
        if w:
            out[i] = frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1))
    return out


def brute_classes(sets, threshold=0.8):
    ids = list(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    links = defaultdict(set)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            if (c := len(sets[a] & sets[b])) and c / len(sets[a] | sets[b]) >= threshold:
                root[find(b)] = find(a)
                if sets[a] != sets[b]:
                    links[a].add(sets[b])
                    links[b].add(sets[a])
    groups = defaultdict(set)
    for i in ids:
        groups[find(i)].add(i)
    return {frozenset(g) for g in groups.values()}, {i: len(links[i]) for i in ids}


def family(rng, n, words=150, edits=3):
    base = [f"w{rng.randrange(3000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(rng.randrange(edits + 1)):
            t[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(t))
    return out


def test_blocks_are_bounded_by_their_grams(spark, monkeypatch):
    """Few long texts are dealt to several blocks, one a text at most, and no link is lost."""
    rng = random.Random(8)
    texts = family(rng, 6, 2000, 20) + family(rng, 9, 60, 2)
    df = N.stored(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), "t")
    want = sorted(map(tuple, N.pairs(df).collect()))
    monkeypatch.setattr(N, "BLOCK_GRAMS", 1500)
    rows = df.withColumnRenamed("doc_id", "rid")
    blocks = N.families(rows, N.stored(N.sketches(rows, N.Banding()), "sketches"), N.Banding()).collect()
    of = defaultdict(dict)
    for b in blocks:
        of[b["family"]][b["rid"]] = b["block"]
    assert len(of) == 2
    for f, placed in of.items():
        many = 1 + max(b["hi"] for b in blocks if b["family"] == f)
        assert many == (len(placed) if min(placed) < 6 else 1)  # 1,996 n-grams a text, and 56
    assert len(want) >= 10 and sorted(map(tuple, N.pairs(df).collect())) == want


@pytest.mark.parametrize("block", [256, 8])
def test_jaccard_classes_match_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    rng = random.Random(4)
    texts = family(rng, 40) + family(rng, 25, 60, 2) + family(rng, 10, 400, 40) + [None, "", "a b", "a b", "a b c"]
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(50)) for _ in range(50)]
    rng.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: r for r in N.jaccard_classes(N.stored(df, "t")).collect()}
    sets = word_sets(enumerate(texts))
    groups, links = brute_classes(sets)
    have = defaultdict(set)
    for i, r in got.items():
        have[r["class_id"]].add(i)
    assert {frozenset(v) for v in have.values() if next(iter(v)) in sets} == groups
    assert {i: got[i]["n_links"] for i in sets} == links
    assert len(got) == len(texts)


def test_pairs(spark):
    rng = random.Random(9)
    texts = family(rng, 12)
    df = N.stored(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), "t")
    sets = word_sets(enumerate(texts))
    found = [(frozenset((sets[r["id_a"]], sets[r["id_b"]])), r["jaccard"]) for r in N.pairs(df).collect()]
    want = {frozenset((a, b)): len(a & b) / len(a | b) for a in sets.values() for b in sets.values() if a != b}
    want = {k: v for k, v in want.items() if v >= 0.8}
    assert len(found) == len(want) and all(abs(want[k] - v) < 1e-9 for k, v in found)


def test_classes_of_odd_rows(odd, no_docs):
    rows = N.jaccard_classes(odd).collect()
    assert len(rows) == odd.count()
    assert N.jaccard_classes(no_docs).collect() == []


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 102), (102, 101), (7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in components(df, "a", "b").collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100, 102: 100}


def brute_cut(texts, length=200):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[k:k + length] for b in data for k in range(len(b) - length + 1))
    out = []
    for b in data:
        mark = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                mark[k:k + length] = b"\1" * length
        kept = bytes(x for x, m in zip(b, mark) if not m)
        spans = sum(m and (k == 0 or not mark[k - 1]) for k, m in enumerate(mark))
        out.append((len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("piece", [1 << 22, 700])
def test_suffix_dedup_matches_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(S, "PIECE", piece)
    rng = random.Random(8)
    letters = "abcdefghij éß日 "
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [text(n) for n in (150, 199, 200, 201, 215, 400, 1500)]
    texts = [None, "", "a" * 150, "a" * 900, "ab" * 700, text(5000), "x" * 200, "x" * 200, "y" * 200]
    for s in shared:
        texts += [text(rng.randrange(300)) + s + text(rng.randrange(300)) for _ in range(3)]
    texts += [shared[-1][:700] + text(40) + shared[-1][700:], shared[-1][300:900], shared[-1], shared[-1]]
    df = S.stored(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), "t")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in S.suffix_dedup(df).collect()}
    assert [got[i] for i in range(len(texts))] == brute_cut(texts)


def test_suffix_dedup_of_odd_rows(odd, no_docs):
    rows = odd.select("doc_id", "text").collect()
    want = sorted(((r["doc_id"], *x) for r, x in zip(rows, brute_cut([r["text"] for r in rows]))), key=str)
    assert sorted((tuple(r) for r in S.suffix_dedup(odd).collect()), key=str) == want
    assert S.suffix_dedup(no_docs).collect() == []


def test_ranks_are_equal_exactly_for_equal_strings():
    data = np.frombuffer(bytes(np.random.default_rng(1).integers(97, 99, 3000, dtype=np.uint8)), dtype=np.uint8)
    for length, rank in zip((1, 7, 32), R.doubled(data, [1, 7, 32])):
        strings = [data[k:k + length].tobytes() for k in range(len(data) - length + 1)]
        assert len(rank) == len(strings) and len(set(zip(strings, rank.tolist()))) == len(set(strings)) == len(set(rank.tolist()))


def brute_hits(docs, items, size=10):
    word = re.compile(r"[0-9a-z\u0080-\U0010FFFF]+")
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    split = lambda t: word.findall((t or "").translate(low))
    windows = defaultdict(set)
    for item, t in items:
        w = split(t)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k:k + n])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for i, t in docs:
        w = split(t)
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= {str(x) for x in windows[tuple(w[k:k + n])] if x is not None}
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_decontamination_matches_brute_force(spark, odd, no_docs):
    rng = random.Random(3)
    docs = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    long = max((t or "" for _, t in docs), key=len).split()
    items = [(1, " ".join(long[100:160])), (2, " ".join(long[130:139])), (3, None), (4, ""), (5, "same SAME same"), (6, "x " * 12),
             (7, " ".join(long[300:315] + ["no"] + long[316:330])), (1, " ".join(long[100:160])), (None, " ".join(long[700:720])),
             (12, "one"), (13, "".join("é日𝄞 ünï " * 4)), (14, "zz nothing here like this at all in any of the texts of this"),
             (15, " ".join(f"w{rng.randrange(4000)}" for _ in range(30)))]
    bench = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'c' AS cid", "'t' AS term")
    got = sorted((tuple(r) for r in D.decontaminate(odd, bench).collect()), key=str)
    assert got == brute_hits(docs, items)
    assert not any(r["contaminated"] for r in D.decontaminate(odd, bench.limit(0)).collect())
    assert D.decontaminate(no_docs, bench).collect() == []


def test_proximity(spark):
    docs = D.stored(spark.createDataFrame([(0, 0, "alpha x x beta x gamma"), (1, 1, "alpha x x x x x x x beta gamma"), (2, 2, "gamma beta alpha")],
                                          "rid bigint, doc_id bigint, text string"), "t")
    phrases = spark.createDataFrame([(9, ["alpha", "beta", "gamma"])], "cid bigint, words array<string>")
    vocabulary = D.vocabulary_of(phrases)
    got = {r["rid"] for r in D.proximity_matches(D.build_index(docs, vocabulary), phrases, vocabulary, 5).collect()}
    assert got == {0, 2}


def test_row_numbers_outlive_a_change_of_file_splits(spark, odd):
    """The splits of a scan follow the cores; a job after an executor is lost must see the rows of the job before."""
    from tidewater.llm.common import packed, with_row_id
    conf = ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")
    for number in (packed, with_row_id):
        rows, seen = number(odd.select("doc_id", "text")), []
        for splits, cost in (("1", "1"), ("64", "4194304")):
            spark.conf.set(conf[0], splits)
            spark.conf.set(conf[1], cost)
            try:
                seen.append(sorted(((r["rid"], str(r)) for r in rows.select(*rows.columns).collect())))
            finally:
                for c in conf:
                    spark.conf.unset(c)
        assert seen[0] == seen[1]

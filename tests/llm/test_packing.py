import pickle
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_fixtures import no_docs, odd, odd_docs, odd_path  # noqa: F401

from tidewater.llm import packing as P

FILES = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "the", " ", "  ", "\n", "\n\n", "\t", "é", "日", "𝄞", "'s", "12", "½", "<|endoftext|>", ".", "\xa0"]), max_size=14))
def test_chunked_ids_are_the_library_ids(parts):
    text = "".join(parts)
    full = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    enc = P.encoder(*FILES)
    assert np.frombuffer(enc.ids(text), enc.dtype).tolist() == full.encode(text, add_special_tokens=False).ids


def check_pieces(pieces, want):
    """``want``: ids of each (doc, copy); every token in one piece, sequences gapless and full."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append((p["offset"], p["length"]))
    for doc, ids in want.items():
        have = sorted((p["start"], p["length"], p["ids_crc32"]) for p in by_doc.pop(doc))
        for one in ids:
            at = 0
            while at < len(one):
                hit = next(h for h in have if h[0] == at and h[2] == zlib.crc32(np.array(one[at:at + h[1]], dtype="<u4").tobytes()))
                have.remove(hit)
                at += hit[1]
        assert not have
    assert not by_doc
    for seq in by_seq.values():
        at = 0
        for offset, length in sorted(seq):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0


def test_pack_odd_rows(odd):
    full = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    want = defaultdict(list)
    for r in odd.select("doc_id", "text").collect():
        want[r["doc_id"]].append(full.encode(r["text"] or "", add_special_tokens=False).ids + [1])
    for shard_docs in (1024, 7):
        check_pieces([r.asDict() for r in P.digests(P.pack(odd, shard_docs=shard_docs)).collect()], want)


def test_neighbours_are_the_best_by_bm25():
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 60, 30) for _ in range(40)]
    index = P.Index(docs)
    size = np.array([len(d) for d in docs])
    score = np.zeros(len(docs))
    seed = 3
    for t in np.unique(docs[seed]):
        df = sum(t in d for d in docs)
        if df > 1:
            for i, d in enumerate(docs):
                tf = (d == t).sum()
                score[i] += np.log(1 + (len(docs) - df + .5) / (df + .5)) * tf * 2.2 / (tf + 1.2 * (.25 + .75 * size[i] / size.mean()))
    got = index.neighbours(seed, 10_000)
    assert np.allclose(score[got], np.sort(score[score > 0])[::-1])


def test_packing_asks_for_scores_on_all_shared_terms(monkeypatch):
    """The call that pack_shard makes gives every document that shares a term, by its full score."""
    rng = np.random.default_rng(2)
    docs = [rng.permutation(400)[:200] for _ in range(30)]
    asked, real = {}, P.Index.neighbours

    def spy(self, seed, *args):
        asked[seed] = (real(self, seed, *args), real(self, seed, 10_000))
        return asked[seed][0]
    monkeypatch.setattr(P.Index, "neighbours", spy)
    assert sum(n for _, _, n, _, _ in P.pack_shard(docs, 2048)) == 6000
    assert asked and all(a.tolist() == b.tolist() for a, b in asked.values())


def test_related_documents_share_a_window():
    topics = [np.arange(100 * k, 100 * k + 50) for k in range(8)]
    docs = [np.tile(t, 4) for t in topics for _ in range(10)]
    seqs = defaultdict(list)
    for d, _, n, q, _ in P.pack_shard(docs, 2048):
        seqs[q].append((d // 10, n))
    share = sum(max(sum(n for t, n in s if t == k) for k in {t for t, _ in s}) for s in seqs.values()) / 16000
    assert share > 0.8


def test_no_rows(no_docs):
    assert P.pack(no_docs).collect() == []


def corpus_of_topics(spark, topics, copies, path):
    """Rows whose words are their topic's alone, dealt over several files; doc_id // copies is the topic."""
    rng = random.Random(9)
    words = [["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(20)] for _ in range(topics)]
    rows = [(t * copies + i, " ".join(rng.choices(words[t], k=60))) for t in range(topics) for i in range(copies)]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5).write.parquet(path)
    return spark.read.parquet(path)


def test_related_documents_meet_across_the_corpus(spark, tmp_path):
    docs = corpus_of_topics(spark, 40, 10, str(tmp_path / "topics"))
    seqs = defaultdict(lambda: defaultdict(int))
    for p in P.digests(P.pack(docs, window=1024, shard_docs=16)).collect():
        seqs[p["sequence_id"]][p["doc_id"] // 10] += p["length"]
    assert sum(max(s.values()) for s in seqs.values()) / sum(sum(s.values()) for s in seqs.values()) > 0.7


def test_nearest_is_brute_force_over_the_corpus(spark, tmp_path):
    docs = corpus_of_topics(spark, 12, 25, str(tmp_path / "near"))
    bag = P.stored(P.bags(P.stored(P.encoded(docs, "text", "doc_id", *FILES), "encoded"), 2048, P.encoder(*FILES).dtype), "bags")
    rows = sorted(bag.collect(), key=lambda r: r["rid"])
    corpus = P.Corpus.of(bag)
    for often in (0.0, 0.05, 2.0):
        seeds = P.Seeds(corpus, [r["rid"] for r in rows], [bytes(r["terms"]) for r in rows], chunk=64, often=often)
        score, rid, rest = P.nearest(bag, seeds, 8)
        for q, r in enumerate(rows):
            mine, want = set(np.frombuffer(r["terms"], "<u4").tolist()), []
            for other in rows:
                terms, tf = (np.frombuffer(other[c], "<u4").astype(np.int64) for c in ("terms", "counts"))
                w = corpus.weights(terms, tf, np.full(len(terms), other["size"]))
                want.append(0 if other is r else sum(x for t, x in zip(terms.tolist(), w) if t in mine))
            assert np.allclose(score[q], np.sort(want)[::-1][:8], rtol=1e-4)
            assert r["rid"] not in rid[q]


def stored_bags(docs, window=2048):
    return P.stored(P.bags(P.stored(P.encoded(docs, "text", "doc_id", *FILES), "encoded"), window, P.encoder(*FILES).dtype), "bags")


def test_short_lists_are_the_head_of_the_whole_ones(spark, tmp_path, monkeypatch):
    """What tasks leave out ends a list before anything is missing; documents out of reach change nothing."""
    bag = stored_bags(corpus_of_topics(spark, 12, 25, str(tmp_path / "short"))).repartition(6)
    rows = sorted(bag.collect(), key=lambda r: r["rid"])
    corpus = P.Corpus.of(bag)
    seeds = P.Seeds(corpus, [r["rid"] for r in rows], [bytes(r["terms"]) for r in rows], chunk=32)
    score, rid, rest = P.nearest(bag, seeds, 40)  # each task has one block: nothing is known yet to leave documents out by
    monkeypatch.setattr(P, "_BLOCK", 8)
    for each in (1, 4, 40):
        some, its_rid, its_rest = P.nearest(bag, seeds, 40, each)
        sure = some >= 0
        length = sure.sum(axis=1)
        assert (length >= each).all() and (sure == (np.arange(40) < length[:, None])).all()
        assert np.allclose(some[sure], score[sure], rtol=1e-4)
        clear = sure & (np.abs(np.diff(score, axis=1, prepend=np.inf)) > 1e-3) & (np.abs(np.diff(score, axis=1, append=-1)) > 1e-3)
        assert clear.any() and (its_rid[clear] == rid[clear]).all() and (its_rest[clear] == rest[clear]).all()
    assert sure.all()


def test_seeds_keep_their_terms_on_the_way():
    rng = np.random.default_rng(4)
    docs = [np.unique(rng.integers(0, 300, 40) ** 2 // 300).astype("<u4") for _ in range(50)]
    corpus = P.Corpus(50, 40.0, np.bincount(np.concatenate(docs)))
    seeds = P.Seeds(corpus, list(range(50)), [d.tobytes() for d in docs], chunk=16, often=0.3)
    sent = pickle.loads(pickle.dumps(seeds))
    assert sorted(seeds.order.tolist()) == list(range(50)) and sent.rids.tolist() == seeds.order.tolist()
    for mine, theirs in zip(seeds.chunks, sent.chunks, strict=True):
        assert all(a.dtype == b.dtype and np.array_equal(a, b) for a, b in zip(mine, theirs, strict=True))


def test_rounds_search_for_windows_that_need_it(spark, tmp_path, monkeypatch):
    """No seed is searched for that no window can take, what a search found serves later rounds, and tasks do not send whole lists."""
    docs = corpus_of_topics(spark, 40, 10, str(tmp_path / "rounds"))
    rounds, real, asked, search = [], P.Packer.round, [], P.nearest

    def spy(self):
        self.seeds = 64
        waiting = sum(w.terms is not None for w in self.open)
        free = (self.left - sum(w.room - w.at for w in self.open)) // self.window + len(self.open) - waiting
        rounds.append((waiting, free, len(asked)))
        return real(self)

    def nearest(alive, seeds, k, each=None):
        asked.append((len(seeds.rids), k, each, alive.rdd.getNumPartitions()))
        return search(alive, seeds, k, each)
    monkeypatch.setattr(P.Packer, "round", spy)
    monkeypatch.setattr(P, "nearest", nearest)
    assert P.pack(docs, window=1024, shard_docs=16).count() >= 400
    assert len(rounds) > 1 and asked
    for (waiting, free, lo), hi in zip(rounds, [r[2] for r in rounds[1:]] + [len(asked)]):
        assert all(seeds <= max(waiting, free + waiting + (free + waiting) // 4 + 1) for seeds, *_ in asked[lo:hi])
        assert waiting or free or lo == hi
    assert all(k >= 64 and each * tasks <= 2 * k + 3 * tasks for _, k, each, tasks in asked)


def test_a_bag_of_many_files_is_read_in_a_bounded_number_of_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "_TASKS", 2)
    bag = stored_bags(corpus_of_topics(spark, 4, 10, str(tmp_path / "files"))).repartition(9)
    packer = P.Packer(bag, 2048, 0)
    most = max(2, spark.sparkContext.defaultParallelism)
    assert packer.tasks == packer.bag.rdd.getNumPartitions() == most and packer.bag.count() == 40

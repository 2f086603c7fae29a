"""Lexical retrieval packing over the whole corpus.

Seeds are the longest unused documents. Each asks every unused document of the corpus for
its BM25 score over token ids, with document counts of the corpus and on all shared terms; the
best follow the seed into its window, the last one cut where the window ends. What is cut
off stays in the pool. Windows longer than a document thus hold related texts and no
padding; the few tokens left at the end go into windows of a power of two.

Seeds go in rounds of bounded size: one scan scores all unused documents against the
round's seeds and keeps each seed's best; the driver then deals them out, longest seed
first. A window that others left short asks again in the next round, before new seeds. A
search finds more than a round uses, for later rounds, and the more the fewer seeds ask. So the
search has no cut, and its work grows with the square of the corpus.
"""

from __future__ import annotations

import heapq
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import numbered, stored
from tidewater.session import checkpoint_dir

_CHUNKS_KEPT = 1_000_000
_LONGEST_KEPT = 64
_ENDS = re.compile(r"\s\s|^\s|\s$")
_BLANK = re.compile(r"(?<=\S) (?=\S)")
_ROWS = 500  # that go back to Spark together
END_ID = 1


class ChunkEncoder(dict):
    """Ids of byte-level BPE as the ``tokenizers`` file gives them, by chunks that repeat.

    The file's pre-tokenizer always cuts before a single space, and around a single line
    break, between two other characters; so a text's ids are its chunks' ids one after the other. Chunks are
    encoded by the same vocabulary's ranks and kept as bytes; texts with a special token's
    string go through the ``tokenizers`` library itself.
    """

    def __init__(self, model: str, ranks: str):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        self.full = Tokenizer.from_file(public_tokenizers.path(model))
        self.dtype = np.dtype("<u2" if self.full.get_vocab_size(True) <= 1 << 16 else "<u4")
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        with open(public_tokenizers.path(ranks), "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding(model, pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                        special_tokens={}).encode_ordinary

    def __missing__(self, chunk: str) -> bytes:
        """Of a chunk led by a line break as it stands, of any other led by a space that is not written."""
        out = np.array(self.encode(chunk if chunk.startswith("\n") else " " + chunk), dtype=self.dtype).tobytes()
        if len(chunk) <= _LONGEST_KEPT:
            if len(self) >= _CHUNKS_KEPT:
                self.clear()
            self[chunk] = out
        return out

    def ids(self, text: str | None) -> bytes:
        """The ids of the whole text, little-endian, ``dtype`` wide."""
        if not text:
            return b""
        if any(s in text for s in self.special):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()
        if _ENDS.search(text):  # blanks in a row, or at an end
            chunks = _BLANK.split(text)
        else:
            chunks = text.replace("\n", " \n").split(" ")
        first = np.array(self.encode(chunks[0]), dtype=self.dtype).tobytes()
        return first + b"".join(map(self.__getitem__, chunks[1:]))


_ENCODERS: dict[tuple[str, str], ChunkEncoder] = {}


def encoder(model: str, ranks: str) -> ChunkEncoder:
    if (model, ranks) not in _ENCODERS:
        _ENCODERS[model, ranks] = ChunkEncoder(model, ranks)
    return _ENCODERS[model, ranks]


@dataclass
class Corpus:
    """What BM25 needs of the corpus: documents, their mean size, and for each term the documents that hold it."""
    n: int
    mean: float
    df: np.ndarray
    k1: float = 1.2
    b: float = 0.75

    @classmethod
    def of(cls, bag: DataFrame) -> Corpus:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            df = np.zeros(0, dtype=np.int64)
            for b in batches:
                got = np.bincount(np.frombuffer(b"".join(b["terms"]), dtype="<u4"))
                df, got = (df, got) if len(df) >= len(got) else (got, df)
                df[:len(got)] += got
            yield pd.DataFrame({"term": np.flatnonzero(df), "df": df[df > 0]})
        found = bag.select("terms").mapInPandas(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toPandas()
        n, mean = bag.agg(F.count("*"), F.avg("size")).first()
        df = np.zeros(int(found["term"].max()) + 1 if len(found) else 0, dtype=np.int64)  # as long as the vocabulary at most
        df[found["term"]] = found["df"]
        return cls(n, mean or 1.0, df)

    def weights(self, terms: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        df = self.df[terms]
        idf = np.log(1 + (self.n - df + 0.5) / (df + 0.5))
        return idf * counts * (self.k1 + 1) / (counts + self.k1 * (1 - self.b + self.b * sizes / self.mean))


class Index:
    """BM25 over the token ids of documents in memory, with counts of ``corpus`` or else of these documents."""

    def __init__(self, docs: list[np.ndarray], corpus: Corpus | None = None):
        n = len(docs)
        size = np.array([len(d) for d in docs], dtype=np.int64)
        key = np.repeat(np.arange(n, dtype=np.int64), size) << 32 | np.concatenate(docs or [np.zeros(0)]).astype(np.int64)
        key, tf = np.unique(key, return_counts=True)
        doc, term = key >> 32, key & 0xFFFFFFFF
        corpus = corpus or Corpus(n, size.mean() if n else 1.0, np.bincount(term))
        self._post(doc, term, corpus.weights(term, tf, size[doc]), n)

    @classmethod
    def of_bags(cls, rows: list, corpus: Corpus) -> Index:
        self = cls.__new__(cls)
        doc = np.repeat(np.arange(len(rows)), [len(r["terms"]) // 4 for r in rows])
        term, tf = (np.frombuffer(b"".join(bytes(r[c]) for r in rows), dtype="<u4").astype(np.int64) for c in ("terms", "counts"))
        size = np.array([r["size"] for r in rows], dtype=np.int64)
        self._post(doc, term, corpus.weights(term, tf, size[doc]), len(rows))
        return self

    def _post(self, doc: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int) -> None:
        order = np.argsort(term, kind="stable")
        self.doc, term, self.weight = doc[order], term[order], weight[order]
        self.starts = np.flatnonzero(np.diff(term, prepend=-1))
        self.ends = np.append(self.starts[1:], len(term))
        self.terms = term[self.starts]
        df = self.ends - self.starts
        of = np.repeat(np.arange(len(df)), df)  # which posting list a posting is in
        # posting lists by document, the most telling first; lists of one document lead nowhere
        shared = df[of] > 1
        by_doc = np.lexsort((-self.weight[shared], self.doc[shared]))
        self.lists = of[shared][by_doc]
        self.cut = np.searchsorted(self.doc[shared][by_doc], np.arange(n + 1))
        self.n = n

    def _ranked(self, lists: np.ndarray) -> np.ndarray:
        if not len(lists):
            return np.zeros(0, dtype=np.int64)
        at = np.concatenate([np.arange(self.starts[x], self.ends[x]) for x in lists])
        score = np.bincount(self.doc[at], weights=self.weight[at], minlength=self.n)
        found = np.flatnonzero(score)
        return found[np.lexsort((found, -score[found]))]

    def neighbours(self, seed: int, terms: int | None = None) -> np.ndarray:
        """Documents that share a term with the seed, best first, scored on all shared terms; ``terms``: on the heaviest alone."""
        stop = self.cut[seed + 1] if terms is None else min(self.cut[seed + 1], self.cut[seed] + terms)
        return self._ranked(self.lists[self.cut[seed]:stop])

    def sharing(self, terms: bytes) -> np.ndarray:
        """As ``neighbours``, of a document that need not be here."""
        return self._ranked(np.flatnonzero(np.isin(self.terms, np.frombuffer(terms, dtype="<u4"))))


@dataclass
class Window:
    seq: int
    room: int
    at: int = 0
    rid: int = -1
    terms: bytes | None = None  # of the last seed; None: a new seed is due
    found: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None  # what its last search gave: score, rid, unused tokens
    next: int = 0  # place there of the first that is not in ``head``
    head: list[tuple[int, int]] = field(default_factory=list)  # rid and unused tokens of the best


def pack_rest(index: Index, rest: np.ndarray, window: int, opened: Iterable[Window] = (), seq: int = 0) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, its unused tokens before, length, sequence, offset) of pieces that use all of ``rest``; ``opened`` windows first."""
    rest = rest.copy()
    # the longest rest is the next seed; entries of documents used since are passed over
    pool = [(-int(rest[d]), int(d)) for d in np.flatnonzero(rest)]
    heapq.heapify(pool)
    left = int(rest.sum())

    def put(d: int, w: Window) -> tuple[int, int, int, int, int]:
        nonlocal left
        n = int(min(rest[d], w.room - w.at))
        piece = (d, int(rest[d]), n, w.seq, w.at)
        rest[d] -= n
        left -= n
        w.at += n
        if rest[d]:
            heapq.heappush(pool, (-int(rest[d]), d))
        return piece

    def windows() -> Iterator[Window]:
        nonlocal seq
        yield from opened
        while left:
            yield Window(seq, window if left >= window else 1 << (left.bit_length() - 1))
            seq += 1

    for w in windows():
        seed, found = -1, index.sharing(w.terms) if w.terms is not None else ()
        while True:
            for d in found:
                if w.at == w.room:
                    break
                if d != seed and rest[d]:
                    yield put(int(d), w)
            if w.at == w.room:
                break
            longest, seed = heapq.heappop(pool)
            while -longest != rest[seed]:
                longest, seed = heapq.heappop(pool)  # used in another window meanwhile
            yield put(seed, w)
            found = index.neighbours(seed) if w.at < w.room else ()


def pack_shard(docs: list[np.ndarray], window: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of documents in memory; each token lies in exactly one."""
    size = np.array([len(d) for d in docs], dtype=np.int64)
    seq = 0
    for d in np.flatnonzero(size >= window):
        for start in range(0, int(size[d]) // window * window, window):
            yield int(d), start, window, seq, 0
            seq += 1
    for d, before, n, q, at in pack_rest(Index(docs), size % window, window, seq=seq):
        yield d, int(size[d]) - before, n, q, at


def encoded(docs: DataFrame, text_col: str, id_col: str, model: str, ranks: str) -> DataFrame:
    """rid, doc_id, ids (binary, END_ID last) of each row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(model, ranks)
        end = np.array([END_ID], dtype=enc.dtype).tobytes()
        for batch in batches:
            for at in range(0, len(batch), _ROWS):
                b = batch.iloc[at:at + _ROWS]
                yield pd.DataFrame({"rid": b["rid"], "doc_id": b["doc_id"], "ids": [enc.ids(t) + end for t in b["text"]]})
        enc.clear()  # the worker lives on, and later stages need the memory
    rows = numbered(docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")))
    return rows.mapInPandas(run, "rid bigint, doc_id string, ids binary")


def bags(docs: DataFrame, window: int, width: np.dtype) -> DataFrame:
    """rid, size, rest (what whole windows leave), terms and counts (distinct ids and how often, unsigned 32 bit) of each row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), _ROWS):
                out = []
                for rid, x in batch.iloc[at:at + _ROWS].itertuples(index=False):
                    ids = np.frombuffer(x, dtype=width)
                    term, tf = np.unique(ids, return_counts=True)
                    out.append((rid, len(ids), len(ids) % window, term.astype("<u4").tobytes(), tf.astype("<u4").tobytes()))
                yield pd.DataFrame(out, columns=["rid", "size", "rest", "terms", "counts"])
    return docs.select("rid", "ids").mapInPandas(run, "rid bigint, size bigint, rest bigint, terms binary, counts binary")


def _alike(x: np.ndarray, rows: np.ndarray, size: int) -> list[np.ndarray]:
    """``rows`` in runs of ``size`` that are alike in ``x``: halves along the main axis, again and again."""
    if len(rows) <= size:
        return [rows]
    y = x[rows] - x[rows].mean(axis=0)
    axis = y[np.argmax((y * y).sum(axis=1))]
    for _ in range(8):
        axis = y.T @ (y @ axis)
        axis /= np.linalg.norm(axis) or 1
    rows = rows[np.argsort(y @ axis, kind="stable")]
    half = size * max(1, round(len(rows) / size / 2))
    return _alike(x, rows[:half], size) + _alike(x, rows[half:], size)


_COLUMNS = 256  # by which seeds are alike


class Seeds:
    """The queries of a round, in chunks of like ones: terms of many documents as columns of a matrix, the others as posting lists.

    ``order`` has the places that the seeds were given in.
    """

    def __init__(self, corpus: Corpus, rids: list[int], terms: list[bytes], chunk: int = 512, often: float = 0.02):
        self.corpus, self.chunk = corpus, chunk
        wide = np.flatnonzero(corpus.df > often * corpus.n)
        self.column = np.full(len(corpus.df), -1, dtype=np.int32)
        self.column[wide] = np.arange(len(wide))
        telling = np.full(len(corpus.df) + 1, -1)
        best = np.argsort(corpus.df * (corpus.df - float(corpus.n)), kind="stable")[:_COLUMNS]
        telling[best] = np.arange(len(best))
        held = np.zeros((len(terms), len(best)), dtype=np.float32)
        for row, t in zip(held, terms):
            at = telling[np.frombuffer(t, dtype="<u4")]
            row[at[at >= 0]] = 1
        self.order = np.concatenate(_alike(held, np.arange(len(terms)), chunk))
        self.rids = np.array(rids, dtype=np.int64)[self.order]
        self.chunks = []
        for lo in range(0, len(terms), chunk):
            part = [terms[i] for i in self.order[lo:lo + chunk]]
            term = np.frombuffer(b"".join(part), dtype="<u4").astype(np.int64)
            of = np.repeat(np.arange(len(part), dtype=np.int32), [len(t) // 4 for t in part])
            dense = self.column[term] >= 0
            used = np.unique(self.column[term[dense]])
            member = np.zeros((len(part), len(used)), dtype=bool)
            member[of[dense], np.searchsorted(used, self.column[term[dense]])] = True
            order = np.argsort(term[~dense], kind="stable")
            starts = np.searchsorted(term[~dense][order], np.arange(len(corpus.df) + 1)).astype(np.int32)
            self.chunks.append((member, used, of[~dense][order], starts))

    def __getstate__(self) -> dict:
        """As every executor gets them in each round: the matrices as bits, the posting lists by their lengths."""
        chunks = []
        for member, used, of, starts in self.chunks:
            many = np.diff(starts)
            listed = np.flatnonzero(many).astype(np.int32)
            chunks.append((member.shape, np.packbits(member), used, of.astype(np.min_scalar_type(self.chunk)), listed, many[listed]))
        return self.__dict__ | {"chunks": chunks}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.chunks = []
        for shape, bits, used, of, listed, many in state["chunks"]:
            starts = np.zeros(len(self.corpus.df) + 1, dtype=np.int32)
            starts[listed + 1] = many
            member = np.unpackbits(bits, count=shape[0] * shape[1]).astype(bool).reshape(shape)
            self.chunks.append((member, used, of.astype(np.int32), np.cumsum(starts, dtype=np.int32)))

    def scores(self, doc: np.ndarray, term: np.ndarray, weight: np.ndarray, rid: np.ndarray,
               least: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first seed, documents, its chunk's BM25 by seed and document) for documents given as postings; 0 for a seed itself.

        A document is left out where all its terms that any of the chunk's seeds has weigh less
        together than the least score that counts for one of them (``least``, by seed).
        """
        n = len(rid)
        column = self.column[term]
        dense = column >= 0
        held = np.zeros(((self.column >= 0).sum(), n), dtype=np.float32)
        held[column[dense], doc[dense]] = weight[dense]
        rare = doc[~dense], term[~dense], weight[~dense]
        for k, (member, used, of, starts) in enumerate(self.chunks):
            lo = k * self.chunk
            asked = np.diff(starts) > 0
            asked[np.flatnonzero(self.column >= 0)[used]] = True
            bound = np.bincount(doc, weights=weight * asked[term], minlength=n)
            live = np.flatnonzero((bound > 0) & (bound * 1.0001 >= least[lo:lo + self.chunk].min()))
            if not len(live):
                continue
            out = member.astype(np.float32) @ held[np.ix_(used, live)]
            place = np.full(n, -1)
            place[live] = np.arange(len(live))
            kept = (place[rare[0]] >= 0) & asked[rare[1]]
            at, rare_term, rare_weight = place[rare[0][kept]], rare[1][kept], rare[2][kept]
            first = starts[rare_term].astype(np.int64)
            many = starts[rare_term + 1] - first
            hit = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
            cell = of[hit].astype(np.int64) * len(live) + np.repeat(at, many)
            out += np.bincount(cell, weights=np.repeat(rare_weight, many), minlength=out.size).reshape(out.shape).astype(np.float32)
            mine = self.rids[lo:lo + len(out)]
            own = np.flatnonzero(np.isin(rid[live], mine))
            i, j = np.nonzero(mine[:, None] == rid[live[own]][None, :])
            out[i, own[j]] = 0
            yield lo, live, out


def _best(score: np.ndarray, rid: np.ndarray, rest: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best columns of each row; of equal scores the least rid goes first."""
    order = np.argsort(rid, kind="stable", axis=-1)
    score, rid, rest = (np.take_along_axis(x, order, -1) for x in (score, rid, rest))
    order = np.argsort(-score, kind="stable", axis=-1)[:, :k]
    return tuple(np.take_along_axis(x, order, -1) for x in (score, rid, rest))


def _planes(x: np.ndarray) -> bytes:
    """First bytes of all numbers, then second ones and so on: most are alike and take little room in a shuffle."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def _of_planes(x: bytes, kind: type, width: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(x, dtype=np.uint8).reshape(size, -1).T).view(kind).reshape(-1, width)


_BLOCK = 2048  # documents that are scored together
_TASKS = 64  # that scan the corpus, or as many as there are cores


def nearest(alive: DataFrame, seeds: Seeds, k: int, each: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(scores, rids, unused tokens) of the ``k`` best of ``alive`` for each seed; a score of 0 stands for none.

    Each task keeps the ``each`` best of its documents, or ``k``; those of all tasks meet by
    chunks of seeds. What a task left out comes after the last that it kept; so a seed's list is
    sure up to the first such last one, and ends there: -1 stands for documents not found yet.
    """
    spark = alive.sparkSession
    m, each, kinds = len(seeds.rids), min(each or k, k), (("score", np.float32), ("rid", np.int64), ("rest", np.int32))
    chunk, sent = seeds.chunk, spark.sparkContext.broadcast(seeds)

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for enc in _ENCODERS.values():
            enc.clear()
        seeds = sent.value
        kept = [np.full((m, each), -1 if c == "rid" else 0, dtype=t) for c, t in kinds]
        for batch in batches:
            batch = batch.iloc[np.argsort([-len(t) for t in batch["terms"]], kind="stable")]  # short ones are soon out of reach
            for at in range(0, len(batch), _BLOCK):
                b = batch.iloc[at:at + _BLOCK]
                rid, size, rest = b["rid"].to_numpy(), b["size"].to_numpy(), b["rest"].to_numpy()
                doc = np.repeat(np.arange(len(b)), [len(t) // 4 for t in b["terms"]])
                term, tf = (np.frombuffer(b"".join(b[c]), dtype="<u4").astype(np.int64) for c in ("terms", "counts"))
                for lo, live, score in seeds.scores(doc, term, seeds.corpus.weights(term, tf, size[doc]), rid, kept[0][:, -1]):
                    mine = [x[lo:lo + len(score)] for x in kept]
                    # what is below a seed's last best so far is none of its best
                    least = np.maximum(mine[0][:, -1:], np.finfo(np.float32).tiny)
                    if (mine[0][:, -1] == 0).any() and score.shape[1] > each:
                        least = np.maximum(least, np.partition(score, score.shape[1] - each, axis=1)[:, score.shape[1] - each, None])
                    row, col = np.nonzero(score >= least)
                    if not len(row):
                        continue
                    many = np.bincount(row, minlength=len(score))
                    place = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                    new = [np.zeros((len(score), many.max()), dtype=t) for _, t in kinds]
                    for x, v in zip(new, (score[row, col], rid[live[col]], rest[live[col]])):
                        x[row, place] = v
                    for x, y in zip(mine, _best(*(np.concatenate(x, axis=1) for x in zip(mine, new)), each)):
                        x[:] = y
        yield pd.DataFrame([(lo, *(_planes(x[lo:lo + chunk]) for x in kept)) for lo in range(0, m, chunk)],
                           columns=["seeds", *(c for c, _ in kinds)])

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        kept = last = None  # the best so far, and the first of the tasks' last ones: (score, rid) as columns
        for r in rows.to_dict("records"):
            one = [_of_planes(r[c], t, each) for c, t in kinds]
            kept = one if kept is None else _best(*(np.concatenate(x, axis=1) for x in zip(kept, one)), k)
            mine = [x[:, -1:] for x in one]
            last = mine if last is None else _best(*(np.concatenate(x, axis=1) for x in zip(last, mine)), 1)
        score, rid, rest = kept
        if score.shape[1] < k:
            score, rid, rest = (np.pad(x, ((0, 0), (0, k - x.shape[1])), constant_values=-1 if c == "rid" else 0) for x, (c, _) in zip(kept, kinds))
        if each < k:
            score = np.where((last[0] > 0) & ((score < last[0]) | (score == last[0]) & (rid > last[1])), np.float32(-1), score)
        return pd.DataFrame([(rows["seeds"].iloc[0], *(_planes(x) for x in (score, rid, rest)))], columns=rows.columns)

    schema = "seeds int, score binary, rid binary, rest binary"
    rows = sorted(alive.mapInPandas(task, schema).groupBy("seeds").applyInPandas(meet, schema).collect())
    sent.destroy()  # its files too, on every machine
    if not rows:  # of an input without partitions
        return tuple(np.full((m, k), -1 if c == "rid" else 0, dtype=t) for c, t in kinds)
    given = np.argsort(seeds.order)
    return tuple(np.concatenate([_of_planes(bytes(r[c]), t, k) for r in rows])[given] for c, t in kinds)


_LONGEST_LIST = 1024
_PLACED = "rid bigint, before bigint, length bigint, sequence_id bigint, offset bigint"


class Packer:
    """Deals documents to windows in rounds; the driver holds what a round touches, never the corpus."""

    def __init__(self, bag: DataFrame, window: int, last: int, seeds: int = 16384, k: int = 16, spare: int = 4):
        self.window, self.last, self.seeds, self.k, self.spare = window, last, seeds, k, spare
        self._scan(bag)
        self.corpus = Corpus.of(bag)
        self.by_rest = np.zeros(window, dtype=np.int64)  # documents by their number of unused tokens
        for rest, n in bag.groupBy("rest").agg(F.count("*")).collect():
            self.by_rest[rest] = n
        self.rest: dict[int, int] = {}  # of documents touched since ``bag`` was written
        self.sent: Broadcast | None = None  # them, to the executors
        self.open: list[Window] = []
        self.seq = 0

    def _scan(self, bag: DataFrame) -> None:
        """Read ``bag`` from now on, in a bounded number of tasks: each sends its best to every seed."""
        most = max(_TASKS, bag.sparkSession.sparkContext.defaultParallelism)
        self.tasks = bag.rdd.getNumPartitions()
        self.bag = bag if self.tasks <= most else bag.coalesce(most)
        self.tasks = max(1, min(self.tasks, most))

    @property
    def left(self) -> int:
        return int(self.by_rest @ np.arange(self.window))

    def alive(self) -> DataFrame:
        """The documents with unused tokens, as they stand."""
        if len(self.rest) > 1_000_000:
            self._scan(stored(self._alive(), "bags", compression="zstd"))
            self.rest = {}
            for w in self.open:  # what they have found may be used by now
                w.found, w.head = None, []
        return self._alive()

    def _alive(self) -> DataFrame:
        touched = np.array(sorted(self.rest), dtype=np.int64)
        now = np.array([self.rest[r] for r in touched.tolist()], dtype=np.min_scalar_type(self.window))
        if self.sent:
            self.sent.destroy()  # what earlier rounds sent is not read again
        self.sent = sent = self.bag.sparkSession.sparkContext.broadcast((touched, now))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            touched, now = sent.value
            for b in batches:
                if len(touched):
                    at = np.minimum(np.searchsorted(touched, b["rid"]), len(touched) - 1)
                    b["rest"] = np.where(touched[at] == b["rid"], now[at], b["rest"])
                yield b[b["rest"] > 0]
        return self.bag.mapInPandas(run, self.bag.schema)

    def longest(self, alive: DataFrame, n: int, by_rest: np.ndarray | None = None) -> list:
        """The ``n`` rows with most unused tokens, in order; ``by_rest``: of ``alive``, where that is not as they stand."""
        by_rest = self.by_rest if by_rest is None else by_rest
        above = np.cumsum(by_rest[:0:-1])[::-1]  # of rest 1, 2, ... : documents with as many or more
        least = int((above > n).sum())  # all longer rests are wanted, of this one some
        rows = alive.where(F.col("rest") > least).select("rid", "size", "rest", "terms").collect()
        if least and len(rows) < n:
            rows += (alive.where(F.col("rest") == least).select("rid", "size", "rest", "terms")
                     .orderBy("rid").limit(n - len(rows)).collect())
        return sorted(rows, key=lambda r: (-r["rest"], r["rid"]))

    def search(self, alive: DataFrame, rids: list[int], terms: list[bytes]) -> list[tuple]:
        """Scores, rids and unused tokens of the best for each seed, as ``nearest`` gives them."""
        if not rids:
            return []
        k = self.k * max(self.spare, min(_LONGEST_LIST // self.k, self.spare * self.seeds // len(rids)))
        return list(zip(*nearest(alive, Seeds(self.corpus, rids, terms), k, 2 + -(-2 * k // self.tasks))))

    def told(self, w: Window) -> bool:
        """Bring the window's ``head`` to the ``k`` best that have unused tokens as the round began; whether it is all of them."""
        w.head = [(d, now) for d, then in w.head if (now := self.rest.get(d, then))]
        if w.found is None:
            return False
        score, rid, rest = w.found
        while len(w.head) < self.k and w.next < len(score) and score[w.next] > 0:
            d = int(rid[w.next])
            if now := self.rest.get(d, int(rest[w.next])):
                w.head.append((d, now))
            w.next += 1
        return len(w.head) == self.k or w.next < len(score) and score[w.next] == 0

    def round(self) -> list[tuple[int, int, int, int, int]]:
        """(rid, unused tokens before, length, sequence, offset) of the pieces that one round places."""
        alive, by_rest = self.alive(), self.by_rest.copy()
        asking = [w for w in self.open if w.terms is not None]
        due = [w for w in self.open if w.terms is None]
        short = [w for w in asking if not self.told(w)]
        for w, w.found in zip(short, self.search(alive, [w.rid for w in short], [w.terms for w in short])):
            w.next, w.head = 0, []
        now: dict[int, int] = {}  # unused tokens of documents that this round has touched
        pieces = []
        free = self.left - sum(w.room - w.at for w in self.open)  # tokens that no open window needs

        def put(w: Window, d: int, unused: int) -> None:
            unused = now.get(d, unused)
            n = min(unused, w.room - w.at)
            pieces.append((d, unused, n, w.seq, w.at))
            w.at += n
            now[d] = unused - n
            self.by_rest[unused] -= 1
            self.by_rest[unused - n] += 1

        def fill(w: Window) -> None:
            known = self.told(w)
            for d, unused in w.head:
                if w.at == w.room:
                    return
                if now.get(d, 1):
                    put(w, d, unused)
            if w.at < w.room and known and len(w.head) < self.k:  # no other document shares a term
                w.terms = None
                due.append(w)

        for w in asking:
            fill(w)
        most, done = max(1, self.seeds - len(asking)), 0
        while done < most and (due or free >= self.window):
            want = len(due) + max(0, free) // self.window  # windows that can get a seed; earlier windows use some of the seeds
            fresh = self.longest(alive, min(most, done + want + want // 4 + 1), by_rest)[done:]
            if not fresh:
                break
            done += len(fresh)
            # those used by an earlier window are passed over; what is left of them comes again
            fresh = [r for r in fresh if r["rid"] not in now]
            for r, found in zip(fresh, self.search(alive, [r["rid"] for r in fresh], [bytes(r["terms"]) for r in fresh])):
                if r["rid"] in now:
                    continue
                if due:
                    w = due.pop(0)
                elif free >= self.window:
                    w = Window(self.seq, self.window)
                    self.seq += 1
                    self.open.append(w)
                    free -= self.window
                else:
                    break
                w.rid, w.terms, w.found, w.next, w.head = r["rid"], bytes(r["terms"]), found, 0, []
                put(w, r["rid"], r["rest"])
                fill(w)
        self.open = [w for w in self.open if w.at < w.room]
        self.rest.update(now)
        return pieces

    def run(self) -> Iterator[list[tuple[int, int, int, int, int]]]:
        """The pieces of one round after the other; at last those of the documents that then fit into memory."""
        while self.by_rest[1:].sum() > self.last and self.left >= self.window:
            yield self.round()
        rows = sorted(self.alive().collect(), key=lambda r: r["rid"])
        rest = np.array([r["rest"] for r in rows], dtype=np.int64)
        yield [(rows[d]["rid"], *piece) for d, *piece in
               pack_rest(Index.of_bags(rows, self.corpus), rest, self.window, self.open, self.seq)]


def pack(docs: DataFrame, window: int = 2048, shard_docs: int = 1024, text_col: str = "text", id_col: str = "doc_id",
         model: str = "byte_bpe_50k.json", ranks: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """Per piece: doc_id, start, length, ids (binary, unsigned 32 bit little-endian), doc_tokens, sequence_id, offset.

    ``sequence_id`` and ``offset`` place a piece; a sequence holds ``window`` tokens or, at
    the very end, a smaller power of two. When ``shard_docs`` documents are left they are
    packed in memory. NULL and empty texts are the end id alone; NULL ids and repeated rows
    are rows of their own; other columns are not read; no rows give no pieces.
    """
    spark, width = docs.sparkSession, encoder(model, ranks).dtype
    rows = stored(encoded(docs, text_col, id_col, model, ranks), "encoded", compression="zstd")  # rids and ids are read from here alone
    bag = stored(bags(rows, window, width), "bags", compression="zstd")
    place = F.explode(F.sequence(F.lit(1), F.floor(F.col("size") / window)))
    whole = (bag.where(F.col("size") >= window).select("rid", "size", place.alias("k"))
             .select("rid", (F.col("size") - (F.col("k") - 1) * window).alias("before"), F.lit(window).cast("bigint").alias("length"),
                     (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")))
    path = f"{checkpoint_dir(spark).rstrip('/')}/pieces-{uuid.uuid4().hex}"
    whole.write.parquet(path)
    for placed in Packer(bag, window, shard_docs).run():
        spark.createDataFrame([(*p[:3], 2 * p[3], p[4]) for p in placed], _PLACED).coalesce(1).write.mode("append").parquet(path)
    pieces = spark.read.schema(_PLACED).parquet(path)
    pieces = pieces.groupBy("rid").agg(F.collect_list(F.struct("before", "length", "sequence_id", "offset")).alias("pieces"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc_id, x, found in zip(b["doc_id"], b["ids"], b["pieces"]):
                ids = np.frombuffer(x, dtype=width)
                for p in found:
                    start = len(ids) - p["before"]
                    out.append((doc_id, start, p["length"], ids[start:start + p["length"]].astype("<u4").tobytes(), len(ids),
                                p["sequence_id"], p["offset"]))
            yield pd.DataFrame(out, columns=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
    return (rows.join(pieces, "rid").select("doc_id", "ids", "pieces").mapInPandas(
        cut, "doc_id string, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")
        .withColumn("doc_id", F.col("doc_id").cast("bigint")))


def digests(pieces: DataFrame) -> DataFrame:
    """Per piece, with the crc32 of its ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

"""Language identification of mixed texts: scripts narrow, word scores and Viterbi decide.

Each word is scored by the letter trigrams of every language, its script rules out
languages not written in it, and Viterbi finds the labels of the words of a text that
score best when each change of language costs a penalty. Runs of one label are the
spans; the language with most letters is the text's.

Trigram counts come from a bounded sample of labelled rows and are summed by Spark; the
table that workers get has a fixed number of buckets for each language.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import held_out_bucket

#: Labelled rows that a fit uses at most, about: a hash of the id picks them.
SAMPLE_ROWS = 20_000
BUCKETS = 1 << 16
SWITCH_PENALTY = 12.0
UNDETERMINED = "und"
_CHUNK = 1 << 20

# First and last code points of blocks of one script.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
OTHER, MARK = len(SCRIPTS) + 1, len(SCRIPTS) + 2


@lru_cache(maxsize=1)
def script_table() -> np.ndarray:
    """Code point -> 0 no letter, 1.. the script of a letter, OTHER any other letter, MARK a combining mark."""
    kind = np.zeros(0x110000, dtype=np.uint8)
    for c in range(0x110000):
        k = unicodedata.category(chr(c))[0]
        if k == "L":
            kind[c] = OTHER
        elif k == "M":
            kind[c] = MARK
    for s, ranges in enumerate(SCRIPTS.values(), 1):
        for a, b in ranges:
            kind[a:b + 1][kind[a:b + 1] == OTHER] = s
    return kind


def lowered(text: str) -> str:
    """Lower case, one character for one."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


@dataclass
class Words:
    """The words of a run of texts: place and text of each, script, and its trigrams' buckets one after the other."""
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    script: np.ndarray
    letters: np.ndarray
    bucket: np.ndarray
    first: np.ndarray


def words_of(texts: list[str | None]) -> Words:
    kind = script_table()
    joined = "\0".join(lowered(t or "") for t in texts) + "\0"
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    k = kind[cp]
    inside = k > 0
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # texts are told apart by their lengths, as they can hold NUL characters themselves
    size = np.fromiter((len(t or "") + 1 for t in texts), dtype=np.int64, count=len(texts))
    begin = np.cumsum(size) - size
    text = np.searchsorted(begin, start, side="right") - 1
    c = np.where(inside, cp, 32).astype(np.uint64)
    before, before2 = (np.concatenate((np.full(n, 32, dtype=np.uint64), c))[:len(c)] for n in (1, 2))
    mixed = (c * np.uint64(0x9E3779B97F4A7C15)) ^ (before * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (before2 * np.uint64(0x165667B19E3779F9))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    bucket = (mixed >> np.uint64(48)).astype(np.int64)  # 16 bits
    after = inside | np.concatenate(([False], inside[:-1]))  # a word's characters and the one that ends it
    place = np.cumsum(after) - 1
    letters = np.add.reduceat(((k > 0) & (k < MARK)).astype(np.int64), start) if len(start) else np.zeros(0, dtype=np.int64)
    return Words(text, start - begin[text], end - begin[text], k[start], letters, bucket[after], place[start])


@dataclass
class Model:
    langs: list[str]
    logp: np.ndarray       # BUCKETS x languages
    script_cost: np.ndarray  # scripts x languages, subtracted from the score of a word in that script

    def word_scores(self, w: Words) -> np.ndarray:
        if not len(w.start):
            return np.zeros((0, len(self.langs)), dtype=np.float32)
        s = np.add.reduceat(self.logp[w.bucket], w.first, axis=0)
        return s - self.script_cost[w.script]


_CELLS = 1 << 18  # words of texts that are labelled side by side, the padding of shorter ones included


def viterbi(scores: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """The best label of each word of each text, texts of like length side by side, a long one alone.

    Beside the scores it holds one byte for each word and label (two from 256 labels on): where the best way to it came from.
    """
    out: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(scores)
    order = sorted((i for i in range(len(scores)) if len(scores[i])), key=lambda i: -len(scores[i]))
    lo = 0
    while lo < len(order):
        size = min(128, max(1, _CELLS // len(scores[order[lo]])))
        group = order[lo:lo + size]
        lo += size
        n = np.array([len(scores[i]) for i in group])
        flat = np.concatenate([scores[i] for i in group])
        begin = np.cumsum(n) - n
        best = flat[begin].astype(np.float64)
        own = np.arange(best.shape[1], dtype=np.min_scalar_type(best.shape[1]))
        came = np.empty((n[0], len(group), best.shape[1]), dtype=own.dtype)
        alive_at = np.searchsorted(-n, -np.arange(n[0]), side="left")  # texts with more than t words
        for t in range(1, n[0]):
            a = alive_at[t]
            v = best[:a]
            top = v.argmax(axis=1)
            move = v[np.arange(a), top] - penalty
            stay = v >= move[:, None]
            best[:a] = np.where(stay, v, move[:, None]) + flat[begin[:a] + t]
            came[t, :a] = np.where(stay, own, top[:, None])
        label = best.argmax(axis=1)
        path = np.empty((n[0], len(group)), dtype=own.dtype)
        path[n - 1, np.arange(len(group))] = label
        for t in range(n[0] - 1, 0, -1):
            a = alive_at[t]
            path[t - 1, :a] = came[t, np.arange(a), path[t, :a]]
        for g, i in enumerate(group):
            out[i] = path[:n[g], g].astype(np.int64)
    return out


def _blocks(text: str) -> Iterator[tuple[int, str]]:
    """(offset, block) of a long text, cut between words; a block begins with the two characters before it."""
    kind, at = script_table(), 0
    while at < len(text):
        end = min(len(text), at + _CHUNK)
        while end < len(text) and kind[ord(text[end])] > 0:
            end += 1
        lead = min(2, at)
        yield at - lead, text[at - lead:end]
        at = end


def _words_in_blocks(run: list[str | None]) -> Iterator[tuple[Words, int]]:
    """The words of a run of texts, and how many of the first to leave out; those of a long text block by block."""
    if len(run) > 1 or len(run[0] or "") <= _CHUNK:
        yield words_of(run), 0
        return
    for offset, block in _blocks(run[0]):
        w = words_of([block])
        w.start, w.end, lead = w.start + offset, w.end + offset, min(2, offset)
        yield w, int(np.searchsorted(w.start, offset + lead))   # words of the leading characters belong to the block before


def _runs(texts: Iterable[str | None]) -> Iterator[list[str | None]]:
    """Texts of about _CHUNK characters together; a longer one alone."""
    run, held = [], 0
    for t in texts:
        if run and held + len(t or "") > _CHUNK:
            yield run
            run, held = [], 0
        run.append(t)
        held += len(t or "")
    if run:
        yield run


def label(model: Model, texts: list[str | None], penalty: float) -> list[tuple[str, float, list[dict]]]:
    """(language, score, spans) of each text."""
    if not model.langs:
        return [(UNDETERMINED, 0.0, [])] * len(texts)
    found = [(w.text[k:], w.start[k:], w.end[k:], w.letters[k:], model.word_scores(w)[k:]) for w, k in _words_in_blocks(texts)]
    of, start, end, letters, scores = map(np.concatenate, zip(*found))
    cut = np.searchsorted(of, np.arange(len(texts) + 1))
    paths = viterbi([scores[a:b] for a, b in zip(cut, cut[1:])], penalty)
    out = []
    for t, path in enumerate(paths):
        a, b = cut[t], cut[t + 1]
        share = np.bincount(path, weights=letters[a:b], minlength=len(model.langs)) if b > a else np.zeros(1)
        if not share.sum():
            out.append((UNDETERMINED, 0.0, []))
            continue
        turn = np.flatnonzero(np.diff(path)) + 1
        first, last = np.concatenate(([0], turn)), np.concatenate((turn, [b - a])) - 1
        spans = [{"start": int(start[a + i]), "end": int(end[a + j]), "lang": model.langs[path[i]]}
                 for i, j in zip(first, last)]
        out.append((model.langs[int(share.argmax())], float(share.max() / share.sum()), spans))
    return out


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.5) -> Model:
    """Trigram and script counts by language, summed by Spark; rows without text or language are left out."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, rows in batch.groupby("lang"):
                c = held.setdefault(lang, np.zeros(BUCKETS + MARK + 1, dtype=np.int64))
                for run in _runs(rows["text"]):
                    for w, skip in _words_in_blocks(run):
                        first = w.first[skip] if skip < len(w.first) else len(w.bucket)
                        c[:BUCKETS] += np.bincount(w.bucket[first:], minlength=BUCKETS)
                        c[BUCKETS:] += np.bincount(w.script[skip:], minlength=MARK + 1)
        for lang, c in held.items():
            at = np.flatnonzero(c)
            yield pd.DataFrame({"lang": lang, "slot": at, "n": c[at]})
    got = (labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()
           .mapInPandas(count, "lang string, slot bigint, n bigint")
           .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas())  # a fixed number of slots for each language
    langs = sorted(got["lang"].unique())
    table = np.zeros((BUCKETS + MARK + 1, len(langs)))
    table[got["slot"].to_numpy(dtype=np.int64), np.searchsorted(langs, got["lang"]) if langs else []] = got["n"]
    grams, scripts = table[:BUCKETS], table[BUCKETS:]
    logp = np.log((grams + smoothing) / (grams.sum(axis=0) + smoothing * BUCKETS)).astype(np.float32)
    share = scripts / np.maximum(1, scripts.sum(axis=0))
    candidate = share >= 0.01
    candidate[~candidate.any(axis=1)] = True  # a script that no language uses rules out none
    return Model(list(langs), logp, np.where(candidate, 0.0, 1000.0).astype(np.float32))


def identify(text: Column, model: Model, penalty: float = SWITCH_PENALTY) -> Column:
    """struct(lang, score, spans): spans are (start, end, lang) in code points."""
    @F.pandas_udf("struct<lang: string, score: double, spans: array<struct<start: bigint, end: bigint, lang: string>>>")
    def udf(texts: pd.Series) -> pd.DataFrame:
        out = [x for run in _runs(texts) for x in label(model, run, penalty)]
        return pd.DataFrame(out, columns=["lang", "score", "spans"])
    return udf(text)


def sample_bound(n: int, sample_rows: int) -> int | None:
    """Hashes (signed, 64 bit) below this are about four times as many as the sample wants of ``n`` rows; None: all."""
    return None if n <= 4 * sample_rows else -(1 << 63) + (4 * sample_rows << 64) // n


def sample(usable: DataFrame, sample_rows: int) -> DataFrame:
    """(lang, text): the ``sample_rows`` different rows with the least hashes, and one of each language at least.

    A bound on the hash thins the rows before any are compared, whatever their number; copies of a row
    have one hash and count once.
    """
    h = F.xxhash64("doc_id", "lang", "text")
    light = usable.select("lang", h.alias("h"))   # rows are chosen by their hashes alone, texts are fetched after
    n, least = light.agg(F.count("*")).first()[0], [r[0] for r in light.groupBy("lang").agg(F.min("h")).select("min(h)").collect()]
    bound = sample_bound(n, sample_rows)
    few = light.select("h") if bound is None else light.where(F.col("h") < bound).select("h")
    last = few.distinct().orderBy("h").limit(sample_rows).agg(F.max("h")).first()[0]
    chosen = usable.withColumn("h", h).where((F.col("h") <= F.lit(last)) | F.col("h").isin(least))
    return chosen.groupBy("h").agg(F.first("lang").alias("lang"), F.first("text").alias("text")).select("lang", "text")


def language_id(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
                sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_spans for each row.

    Learns from rows with a language whose crc32 (of the id as text, modulo 5) is not 0,
    ``sample_rows`` of them or all (:func:`sample`); predictions see the text only. A long text is
    looked at in blocks of words, so memory grows with about 60 bytes for each of its words. ``score`` is
    the share of letters in spans of the predicted language. NULL text or no letter: ``und``,
    score 0, as for every text if nothing could be learned. Ties go to the language first in
    the alphabet. Repeated rows and NULL ids keep their rows; other columns are not read.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    held_out = held_out_bucket(F.col("doc_id"), 5) == 0
    usable = d.where(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull())
    picked = sample(usable, sample_rows)
    model = train(picked)
    return (d.select("doc_id", held_out.alias("held_out"), identify(F.col("text"), model).alias("i"))
            .select("doc_id", "held_out", F.col("i.lang").alias("lang_pred"), F.col("i.score").alias("score"),
                    F.size("i.spans").alias("n_spans")))

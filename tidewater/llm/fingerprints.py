"""Document fingerprints: improbable byte windows in chained Bloom filters.

Every window of 32 bytes has an entropy, on a scale of 0 to 1000. The rarer an entropy is
among all windows of the corpus, the less probable the window; near-constant windows count
as the most probable, as they say nothing. In each run of 16 neighbouring windows the least
probable one (the leftmost of equals) gets a vote, and windows with 4 votes or more are the
features of a text; where none has so many, those with the most; in a text of fewer windows
than a run, the least probable one. A text of less than 256 bytes also keeps all its windows of
8 bytes (of less than 8: itself), as a choice among so few would be chance. A text's distinct features go, 160 to a filter of 2,048 bits, into a
chain of Bloom filters: the fingerprint. Two filters are alike by the bits they share,
normalised between what chance gives (two standard deviations above its mean) and all bits of
the emptier one; two chains by the best partner of each filter of the shorter chain.

Selection looks at no more than 47 bytes around a window, so texts that share a passage share
the features inside it wherever it stands.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import stored

WINDOW = 32       # bytes of a feature
REACH = 16        # neighbouring windows that elect one; a power of two
VOTES = 4         # votes that make a window a feature
SCALE = 1000      # entropies go from 0 to this
LITTLE = 8        # bytes of the windows that a short text keeps, all of them
SHORT = 256       # bytes from which a text is not short
WEAK = 100        # windows below this entropy are chosen only where nothing else is
BITS = 2048       # of a filter
HASHES = 5        # bits set by a feature
FULL = 160        # features in a filter before the next one begins
_RECORD = 1 + BITS // 8
_BLOCK = 1 << 20  # bytes looked at together
_SPAN = WINDOW + REACH - 1

_COUNTS = np.arange(WINDOW + 1, dtype=np.float64)
_WEIGHT = np.round(_COUNTS * np.log2(np.maximum(_COUNTS, 1)) * (1 << 20)).astype(np.int64)
_GAIN = np.diff(_WEIGHT, prepend=0)          # what the n-th equal byte of a window adds to the sum of n log2 n
_GAIN[0] = 0
_MOST = int(_WEIGHT[WINDOW])


def entropies(buf: np.ndarray) -> np.ndarray:
    """Entropy (0 to SCALE) of every window of the bytes.

    A window's sum of n log2 n grows by a known gain as a byte enters and shrinks as one
    leaves, so it is a difference of two running sums of the gains.
    """
    n = len(buf)
    if n < WINDOW:
        return np.zeros(0, dtype=np.int64)
    before, after = np.ones(n, dtype=np.uint8), np.ones(n, dtype=np.uint8)
    for k in range(1, WINDOW):
        same = (buf[k:] == buf[:-k]).view(np.uint8)
        before[k:] += same
        after[:-k] += same
    total = np.cumsum(_GAIN[before])[WINDOW - 1:]
    total[1:] -= np.cumsum(_GAIN[after[:n - WINDOW]])
    return (_MOST - total) * SCALE // _MOST


def rank_table(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy, the least probable first, from its number of windows; weak ones last."""
    key = counts.astype(np.int64)
    order = np.lexsort((np.arange(SCALE + 1), key, np.arange(SCALE + 1) < WEAK))
    ranks = np.empty(SCALE + 1, dtype=np.int64)
    ranks[order] = np.arange(SCALE + 1)
    return ranks


def _batches(texts: Iterable[bytes]) -> Iterator[list[bytes]]:
    """Runs of texts of at most _BLOCK bytes together; a longer text is alone."""
    run, size = [], 0
    for t in texts:
        if run and size + len(t) > _BLOCK:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


def _blocks(texts: list[bytes], width: int) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """(bytes, offset, ok) pieces of the texts in a row: ok marks the places where ``width`` bytes of one text begin."""
    buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    for at in range(0, max(len(buf) - width + 1, 0), _BLOCK):
        piece = buf[at:at + _BLOCK + width - 1]
        ok = np.ones(len(piece) - width + 1, dtype=bool)
        lo = np.searchsorted(ends, at, side="right")
        for end in ends[lo:np.searchsorted(ends, at + len(ok) + width)]:
            ok[max(end - at - width + 1, 0):max(end - at, 0)] = False
        yield piece, at, ok


def histogram(texts: list[bytes]) -> np.ndarray:
    """Number of windows of each entropy."""
    out = np.zeros(SCALE + 1, dtype=np.int64)
    for run in _batches(texts):
        for piece, _, ok in _blocks(run, WINDOW):
            out += np.bincount(entropies(piece)[ok], minlength=SCALE + 1)
    return out


def _vote(ranks: np.ndarray) -> np.ndarray:
    """For each run of REACH windows, the place of the least rank, the leftmost of equals."""
    key = (ranks << 32) | np.arange(len(ranks))
    step = 1
    while step < REACH:
        key = np.minimum(key[:-step], key[step:])
        step *= 2
    return key & 0xFFFFFFFF


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: multiply and shift until every bit of the input moves every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(windows: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of rows of WINDOW bytes."""
    words = np.ascontiguousarray(windows).view("<u8").reshape(len(windows), WINDOW // 8)
    h = np.full(len(windows), seed + 1, dtype=np.uint64)
    for k in range(words.shape[1]):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + words[:, k])
    return h


def _features(run: list[bytes], ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the features of the texts, by text and place."""
    buf = np.frombuffer(b"".join(run) + b"\0" * WINDOW, dtype=np.uint8)
    sizes = np.array([len(t) for t in run], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    votes = np.zeros(len(buf), dtype=np.uint8)
    for piece, at, ok in _blocks(run, _SPAN):
        chosen = _vote(ranks[entropies(piece)])[ok]
        if len(chosen):
            got = np.bincount(chosen)
            votes[at:at + len(got)] += got.astype(np.uint8)
    places = np.flatnonzero(votes >= VOTES)
    owner = np.searchsorted(starts, places, side="right") - 1
    for i in np.flatnonzero(np.bincount(owner, minlength=len(run)) == 0):   # too short for so many votes, or never so many
        got = votes[starts[i]:starts[i] + sizes[i]]
        if sizes[i] >= _SPAN:
            pick = np.flatnonzero(got == got.max())
        else:
            score = ranks[entropies(buf[starts[i]:starts[i] + sizes[i]])]
            pick = [int(np.argmin(score))] if len(score) else []
        owner = np.concatenate([owner, np.full(len(pick), i)])
        places = np.concatenate([places, np.asarray(pick, dtype=np.int64) + starts[i]])
    hashes = _hashes(buf[places[:, None] + np.arange(WINDOW)])
    owners, at, parts = [owner], [places], [hashes]
    for i in np.flatnonzero(sizes < SHORT):
        text = buf[starts[i]:starts[i] + sizes[i]]
        rows = sliding_window_view(text, LITTLE) if len(text) >= LITTLE else text[None]
        owners.append(np.full(len(rows), i))
        at.append(starts[i] + np.arange(len(rows)))
        parts.append(_hashes(np.pad(rows, ((0, 0), (0, WINDOW - rows.shape[1]))), rows.shape[1] + 1))
    owner, at, hashes = map(np.concatenate, (owners, at, parts))
    order = np.lexsort((at, hashes, owner))                # the first place of each feature of a text ...
    o, h = owner[order], hashes[order]
    new = np.ones(len(o), dtype=bool)
    new[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
    first = order[new]
    first = first[np.lexsort((at[first], owner[first]))]   # ... in the order of the text
    return owner[first], hashes[first]


class Digest:
    """A chain of filters: how many features each holds, and its bits as 64-bit words."""

    __slots__ = ("counts", "words")

    def __init__(self, counts: np.ndarray, words: np.ndarray):
        self.counts, self.words = counts, words

    def text(self) -> str:
        """Base64 of one record for each filter: a byte with its number of features, then its bits."""
        rows = np.concatenate([self.counts.astype(np.uint8)[:, None], self.words.view(np.uint8)], axis=1)
        return base64.b64encode(rows.tobytes()).decode()

    @classmethod
    def parse(cls, text: str) -> Digest:
        rows = np.frombuffer(base64.b64decode(text), dtype=np.uint8).reshape(-1, _RECORD)
        return cls(rows[:, 0].astype(np.int64), np.ascontiguousarray(rows[:, 1:]).view(np.uint64))


def digests(texts: list[str | None], ranks: np.ndarray) -> list[Digest]:
    """The fingerprint of each text (None: empty), of at least one feature."""
    out = []
    for run in _batches((t or "").encode("utf-8", "surrogatepass") for t in texts):
        owner, hashes = _features(run, ranks)
        n = np.bincount(owner, minlength=len(run))
        chain = -(-n // FULL)
        base = np.cumsum(chain) - chain
        place = np.arange(len(owner)) - (np.cumsum(n) - n)[owner]
        slot = base[owner] + place // FULL
        bits = np.zeros((int(chain.sum()), BITS), dtype=bool)
        for k in range(HASHES):
            bits[slot, (hashes >> np.uint64(11 * k)) & np.uint64(BITS - 1)] = True
        words = np.packbits(bits, axis=1).view(np.uint64)
        counts = np.bincount(slot, minlength=len(bits))
        out += [Digest(counts[b:b + c], words[b:b + c]) for b, c in zip(base, chain)]
    return out


def likeness(a: Digest, b: Digest) -> float:
    """0 (no more bits shared than by chance) to 1 (all of the lesser chain's)."""
    if (b.counts.sum(), b.words.tobytes()) < (a.counts.sum(), a.words.tobytes()):
        a, b = b, a
    set_a, set_b = (np.bitwise_count(x.words).sum(axis=1).astype(np.float64) for x in (a, b))
    best = np.empty(len(set_a))
    step = max(1, (1 << 15) // len(set_b))   # a bounded block of pairs at a time
    for lo in range(0, len(set_a), step):
        rows = slice(lo, lo + step)
        x, y = set_a[rows, None], set_b[None]
        shared = np.bitwise_count(a.words[rows, None] & b.words[None]).sum(axis=2, dtype=np.int32)
        chance = x * y / BITS
        chance += 2 * np.sqrt(chance * (1 - x / BITS) * (1 - y / BITS))
        best[rows] = np.clip((shared - chance) / (np.minimum(x, y) - chance), 0, 1).max(axis=1)
    return float(best @ a.counts / a.counts.sum())


def rarity(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Ranks of the entropies by their number of windows in all texts: 1,001 sums, combined before the shuffle."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SCALE + 1, dtype=np.int64)
        for batch in batches:
            total += histogram([(t or "").encode("utf-8", "surrogatepass") for t in batch["t"]])
        yield pd.DataFrame({"e": np.flatnonzero(total), "n": total[total > 0]})
    rows = (docs.select(F.col(f"`{text}`").alias("t")).mapInPandas(count, "e int, n bigint")
            .groupBy("e").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(SCALE + 1, dtype=np.int64)
    for r in rows:
        counts[r["e"]] = r["n"]
    return rank_table(counts)


def fingerprint(text, ranks: np.ndarray):
    """Column of the fingerprint of a text column, with the ranks of ``rarity``."""
    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([d.text() for d in digests(list(texts), ranks)], dtype=object)
    return of(text)


def similarity(a, b):
    """Column of the likeness of two fingerprint columns (NULL where either is)."""
    @F.pandas_udf("double")
    def of(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else likeness(Digest.parse(x), Digest.parse(y))
                          for x, y in zip(xs, ys)], dtype="float64")
    return of(a, b)


_SCHEMA = ("part int, first boolean, last boolean, doc_id string, text string, n_chars bigint, edited_sha256 string, "
           "fingerprint string, edited_fingerprint string, near_edited double, near_next double")
_NAMES = [f.split()[0] for f in _SCHEMA.split(", ")]
_RESULT = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _edited(text: str, after: str) -> str:
    k = len(text) // 4
    return text[:len(text) - k] + after[:k]


def _compared(texts: list[str], prints: list[Digest], ranks: np.ndarray) -> list[tuple]:
    """The result columns of each text but the last, which only follows."""
    edits = [_edited(t, n) for t, n in zip(texts, texts[1:])]
    return [(len(t), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), p.text(), q.text(),
             likeness(p, q), likeness(p, after))
            for t, e, p, q, after in zip(texts, edits, prints, digests(edits, ranks), prints[1:])]


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and their likeness to it and its follower.

    The edited text swaps the last quarter of a document's code points for the beginning of
    the document that follows it by doc_id (NULL ids first; equal ids by a hash of their text;
    after the last comes the first). NULL texts are empty; an empty text is one feature; repeated rows are documents of their own; an empty table gives no
    rows. Only doc_id and text are read, so other columns may have any name. Texts are looked at
    in blocks of 1 MB, and comparing two texts takes time in the product of their filters (one for
    about 1.5 kB).

    Documents, their texts compressed, are dealt by ranges of doc_id (copies of one row by row number, so no hot id fills
    a range), sorted, and each task follows its own rows; only the last row of a range meets the
    first of the next in a second, small step.
    """
    ranks = rarity(docs)

    @F.pandas_udf("binary")
    def squeezed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: zlib.compress(t.encode("utf-8", "surrogatepass"), 1))
    text = F.coalesce("text", F.lit(""))
    rows = (docs.select("doc_id", F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("rid"), F.octet_length(text).alias("size"), squeezed(text).alias("text"))
            .repartitionByRange("doc_id", "h", "rid").sortWithinPartitions("doc_id", "h", "rid")
            .select(F.col("doc_id").cast("string"), "size", "text"))  # pandas would turn ids beside a NULL into floats

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, first, held = TaskContext.get().partitionId(), True, None
        for batch in batches:
            for lo, hi in _slices(batch["size"]):
                ids = list(batch["doc_id"][lo:hi])
                texts = [zlib.decompress(t).decode("utf-8", "surrogatepass") for t in batch["text"][lo:hi]]
                prints = digests(texts, ranks)
                if held:
                    ids, texts, prints = [held[0]] + ids, [held[1]] + texts, [held[2]] + prints
                out = [(part, False, False, i, None, *r) for i, r in zip(ids, _compared(texts, prints, ranks))]
                if first and out:
                    out[0] = (part, True, False, ids[0], texts[0], *out[0][5:])
                    first = False
                held = (ids[-1], texts[-1], prints[-1])
                if out:
                    yield pd.DataFrame(out, columns=_NAMES)
        if held:
            yield pd.DataFrame([(part, first, True, held[0], held[1], len(held[1]), None, None, None, None, None)], columns=_NAMES)
    found = stored(rows.mapInPandas(walk, _SCHEMA), "fingerprints", compression="zstd")

    heads = found.where("first").select(F.col("part").alias("next"), F.col("text").alias("after"))
    in_turn = Window.orderBy("next")  # one row for each range
    heads = (heads.join(heads.select("next").withColumn("part", F.lag("next").over(in_turn))
                        .withColumn("part", F.coalesce("part", F.max("next").over(in_turn.rowsBetween(
                            Window.unboundedPreceding, Window.unboundedFollowing)))), "next"))

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for i, text, after in zip(batch["doc_id"], batch["text"], batch["after"]):
                out.append((i, *_compared([text, after], digests([text, after], ranks), ranks)[0]))
            yield pd.DataFrame(out, columns=["doc_id", *_RESULT])
    kinds = {f.name: f.dataType.simpleString() for f in found.schema}
    tails = (found.where("last").join(heads, "part").select("doc_id", "text", "after")
             .mapInPandas(close, "doc_id string, " + ", ".join(f"{c} {kinds[c]}" for c in _RESULT)))
    return (found.where("not last").select("doc_id", *_RESULT).union(tails)
            .withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType)))


def _slices(sizes: pd.Series) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most _BLOCK bytes of text together, or one row."""
    lo = total = 0
    for i, size in enumerate(sizes):
        if i > lo and total + size > _BLOCK:
            yield lo, i
            lo, total = i, 0
        total += size
    if lo < len(sizes):
        yield lo, len(sizes)

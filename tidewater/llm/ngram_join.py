"""N-gram Jaccard join by MinHash banding.

Texts are sets of word n-grams. Band and row counts follow from the similarity threshold
and a target recall; texts that agree on all values of a band meet in a shuffle on band
hashes, and texts that meet are verified on their full n-gram sets.

Copies (equal sets) are one text from the start. Texts that meet, directly or through
others, form a family; a family is verified in blocks of bounded size, each pair of
blocks in its own task, so neither a large family nor its pairs ever sit in one place, and
what a task emits is a row per text: its links there and one link that keeps it
connected. Pairs are written out only by ``pairs``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bands_for, stored, with_row_id
from tidewater.llm.graph import components

_BLANKS = str.maketrans("\t\n\x0b\x0c\r", "     ")
_WORDS_KEPT = 500_000
BLOCK = 256  # texts
BLOCK_GRAMS = 1 << 22  # 32 MB; a block holds about as many, and one text whatever its length


@dataclass(frozen=True)
class Banding:
    """Texts at the threshold share a band with probability ``recall``; more alike ones do more surely."""
    threshold: float = 0.8
    recall: float = 0.999
    rows: int = 6
    n: int = 5
    seed: int = 11

    @property
    def bands(self) -> int:
        return bands_for(self.threshold, self.recall, self.rows)


class _WordHash(dict):
    def __missing__(self, word: str) -> int:
        import xxhash
        h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) >= _WORDS_KEPT:
            self.clear()
        if len(word) <= 64:
            self[word] = h
        return h


_HASHES = _WordHash()


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted 64-bit values of the distinct n-grams of words; of all words if there are fewer than n; none without words."""
    words = [w for w in (text or "").translate(_BLANKS).split(" ") if w]
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    n = min(n, len(h))
    out = np.full(len(h) - n + 1, np.uint64(n), dtype=np.uint64)
    for k in range(n):
        out = (out ^ h[k:len(h) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return np.unique(out)


class Sketcher:
    def __init__(self, banding: Banding):
        rng = np.random.default_rng(banding.seed)
        k = banding.bands * banding.rows
        self.shape = (banding.bands, banding.rows)
        self.flip = rng.integers(0, 1 << 32, k, dtype=np.uint32)
        self.odd = rng.integers(0, 1 << 31, k, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

    def bands(self, grams: np.ndarray) -> list[int]:
        """One 64-bit value for each band of MinHash values."""
        low = np.full(len(self.odd), 0xFFFFFFFF, dtype=np.uint32)
        x = (grams >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(x), 2048):  # a long text in pieces that stay in cache
            low = np.minimum(low, ((x[at:at + 2048, None] ^ self.flip) * self.odd).min(axis=0))
        rows = low.reshape(self.shape).astype(np.uint64)
        out = np.arange(len(rows), dtype=np.uint64)
        for r in range(rows.shape[1]):
            out = (out ^ rows[:, r]) * np.uint64(0xC2B2AE3D27D4EB4F)
            out ^= out >> np.uint64(29)
        return out.view(np.int64).tolist()


def sketches(rows: DataFrame, banding: Banding) -> DataFrame:
    """rid, copy_key (equal for equal n-gram sets; NULL without words), n_grams, bands, for rows of (rid, text)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sketch = Sketcher(banding)
        for b in batches:
            key, size, bands = [], [], []
            for text in b["text"]:
                g = shingles(text, banding.n)
                key.append(blake2b(g.tobytes(), digest_size=16).digest() if len(g) else None)
                size.append(len(g))
                bands.append(sketch.bands(g) if len(g) else [])
            yield pd.DataFrame({"rid": b["rid"], "copy_key": key, "n_grams": size, "bands": bands})
    return rows.mapInPandas(run, "rid bigint, copy_key binary, n_grams bigint, bands array<bigint>")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of every two sets, by products of their membership columns."""
    m = len(sets)
    common = np.zeros((m, m), dtype=np.float64)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    owner, values = owner[order], values[order]
    column = np.cumsum(np.diff(values, prepend=values[:1]) != 0) if len(values) else values
    width = np.bincount(column) if len(values) else np.zeros(0, dtype=np.int64)
    keep = width[column] > 1  # an n-gram of one set is in no intersection
    owner = owner[keep]
    column = np.unique(column[keep], return_inverse=True)[1]
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 8192):
        a, b = np.searchsorted(column, [lo, lo + 8192])
        member = np.zeros((m, int(column[b - 1]) - lo + 1), dtype=np.float32)
        member[owner[a:b], column[a:b] - lo] = 1
        common += member @ member.T
    return common


def linked(block: pd.DataFrame, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(rids, matrix of Jaccard values) of a pair of blocks; 0 for pairs that another pair of blocks judges."""
    sets = [np.frombuffer(s, dtype=np.uint64) for s in block["grams"]]
    size = np.array([len(s) for s in sets], dtype=np.float64)
    common = overlaps(sets)
    jaccard = common / (size[:, None] + size[None, :] - common)
    side = block["block"].to_numpy()
    if block["lo"].iloc[0] != block["hi"].iloc[0]:
        jaccard[side[:, None] == side[None, :]] = 0
    np.fill_diagonal(jaccard, 0)
    jaccard[jaccard < threshold - 1e-9] = 0
    return block["rid"].to_numpy(), jaccard


def families(rows: DataFrame, sk: DataFrame, banding: Banding) -> DataFrame:
    """Blocks to verify: family, lo, hi, block, rid, grams; each text once for each pair of blocks its block is in."""
    first = sk.where(F.col("copy_key").isNotNull()).groupBy("copy_key").agg(F.min("rid").alias("rid")).select("rid")
    banded = sk.join(first, "rid").select("rid", F.posexplode("bands").alias("band", "h"))
    # stored, as a join of two plain shuffles is one that Spark can split where a band is hot
    meet = stored(banded.groupBy("band", "h").agg(F.min("rid").alias("hub"), F.count("*").alias("n"))
                  .where("n > 1").select("band", "h", "hub"), "meetings")
    family = stored(components(banded.join(meet, ["band", "h"]).select("rid", "hub"), "rid", "hub")
                    .select(F.col("node").alias("rid"), F.col("component").alias("family")).join(sk.select("rid", "n_grams"), "rid"), "families")
    # a block is bounded by its texts and by their n-grams: a few very long texts fill one too
    many = F.greatest(F.ceil(F.count("*") / BLOCK), F.least(F.ceil(F.sum("n_grams") / BLOCK_GRAMS), F.count("*")))
    blocks = family.groupBy("family").agg(many.cast("int").alias("blocks"))
    family = family.drop("n_grams")
    placed = family.join(blocks, "family").withColumn("block", F.pmod(F.xxhash64("rid"), "blocks").cast("int"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["grams"] = [shingles(t, banding.n).tobytes() for t in b.pop("text")]
            yield b
    # families grow with the corpus, so their texts are fetched by a shuffle at every size
    grams = (rows.join(placed.hint("shuffle_hash"), "rid").select("rid", "family", "blocks", "block", "text")
             .mapInPandas(run, "rid bigint, family bigint, blocks int, block int, grams binary"))
    return (grams.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("family", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "rid", "grams"))


def pairs(docs: DataFrame, banding: Banding = Banding(), text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id_a, id_b, jaccard) of every two different texts at least as alike as the threshold, by their first rows' ids."""
    rows = _rows(docs, text_col, id_col)
    blocks = families(rows, stored(sketches(rows.select("rid", "text"), banding), "sketches"), banding)

    def run(block: pd.DataFrame) -> pd.DataFrame:
        rid, jaccard = linked(block, banding.threshold)
        i, j = np.nonzero(np.triu(jaccard))
        a, b = np.minimum(rid[i], rid[j]), np.maximum(rid[i], rid[j])
        return pd.DataFrame({"a": a, "b": b, "jaccard": jaccard[i, j]})
    found = blocks.groupBy("family", "lo", "hi").applyInPandas(run, "a bigint, b bigint, jaccard double")
    ids = rows.select("rid", "doc_id")
    return (found.join(ids.toDF("a", "id_a"), "a").join(ids.toDF("b", "id_b"), "b").select("id_a", "id_b", "jaccard"))


def _rows(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    return with_row_id(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))


def classes(rows: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """For rows of (rid, text): rid, class_rid (least rid of its class), n_links, n_copies.

    A class holds copies and texts joined by links; ``n_links`` counts the other texts (each
    with its copies) at least as alike as the threshold, ``n_copies`` the rows of the same
    n-gram set. A text without words is alone.
    """
    sk = stored(sketches(rows.select("rid", "text"), banding), "sketches")
    blocks = families(rows.select("rid", "text"), sk, banding)

    def run(block: pd.DataFrame) -> pd.DataFrame:
        rid, jaccard = linked(block, banding.threshold)
        hub = np.arange(len(rid))
        link = jaccard > 0
        n = link.sum(axis=1)
        while True:  # least member that a text reaches through links of this block
            low = np.minimum(hub, np.where(link, hub[None, :], len(rid)).min(axis=1))
            low = low[low]
            if (low == hub).all():
                break
            hub = low
        return pd.DataFrame({"rid": rid, "hub": rid[hub], "n": n})[n > 0]
    found = stored(blocks.groupBy("family", "lo", "hi").applyInPandas(run, "rid bigint, hub bigint, n bigint"), "links")
    links = found.groupBy("rid").agg(F.sum("n").alias("n_links"))
    joined = components(found.select("rid", "hub"), "rid", "hub").select(F.col("node").alias("first"), F.col("component"))
    # stored, so that the rows of a text with many copies can be split in the join below
    copies = stored(sk.where(F.col("copy_key").isNotNull()).groupBy("copy_key")
                    .agg(F.min("rid").alias("first"), F.count("*").alias("n_copies"))
                    .join(joined, "first", "left").join(links.withColumnRenamed("rid", "first"), "first", "left"), "copies")
    return (sk.select("rid", "copy_key").join(copies, "copy_key", "left")
            .select("rid", F.coalesce("component", "first", "rid").alias("class_rid"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_copies", F.lit(1)).alias("n_copies")))


def jaccard_classes(docs: DataFrame, banding: Banding = Banding(), text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, class_id, n_links, n_copies for each row; class_id is the doc_id of the class's first row.

    Words are runs of non-blank characters as written, so NULL and empty texts are classes of
    their own, and texts of fewer than n words are one n-gram. Repeated rows are copies; NULL
    ids keep their rows; other columns are not read; an empty table gives no rows.
    """
    rows = _rows(docs, text_col, id_col)
    found = classes(rows, banding)
    ids = rows.select("rid", "doc_id")
    return (found.join(ids, "rid").join(ids.toDF("class_rid", "class_id"), "class_rid")
            .select("doc_id", "class_id", "n_links", "n_copies"))

"""Exact removal of repeated strings by hash ranks, in place of a suffix array.

Two positions hold the same 200 bytes exactly if their ranks at length 200 agree. A rank
here is a 64-bit hash that numpy doubles within one text (``ranks.doubled``): the rank of a
length is that of a pair of ranks of half of it. No table of positions is sorted or ranked
anew across the corpus; Spark counts equal ranks by groupBy, and positions whose rank is
unique leave, as no longer string there can repeat.

Not every position takes part from the start. The windows of a text fall into runs that
share their least 32-byte gram, and equal windows have theirs at the same offset; so first
one row a run is ranked by that gram, at 32 bytes. What repeats is ranked by the hull of
the run, all bytes of its windows: a hull that repeats settles the whole run at once. Only
runs at the edge of a repeat are cut into steps of 16 windows and ranked by what the
windows of a step share (185 bytes) and by the step's hull; and only steps at an edge go
window by window at 200 bytes. One of the settled equals stays in play for the edges that it matches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import stored, with_row_id
from tidewater.llm.ranks import GRAM, PIECE, anchors, doubled, pair

STEP = 16


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


def _frames(docs: Iterator[pd.DataFrame], of_row: Callable, columns: list[str]) -> Iterator[pd.DataFrame]:
    """Columns that ``of_row`` gives for each row, gathered until they are about a piece of text long."""
    held, size = [], 0
    for batch in docs:
        for row in batch.itertuples(index=False):
            for got in of_row(row):
                held.append(got)
                size += len(got[0])
            if size >= 200_000:
                yield pd.DataFrame({c: np.concatenate([h[k] for h in held]) for k, c in enumerate(columns)})
                held, size = [], 0
    if held:
        yield pd.DataFrame({c: np.concatenate([h[k] for h in held]) for k, c in enumerate(columns)})


def runs(rows: DataFrame, length: int) -> DataFrame:
    """(rid, lo, n, off, gram, hull): windows lo ... lo + n have their least gram at lo + off."""
    def of_row(row):
        data = _bytes(row.text)
        # a long text in pieces that overlap by a window; a run cut there is an edge like any other
        for at in range(0, max(0, len(data) - length + 1), PIECE - length + 1):
            grams, rank = doubled(data[at:at + PIECE], [GRAM, length])
            place, first, last = anchors(grams, length - GRAM + 1)
            n = last - first
            hull = pair(pair(rank[first], rank[last]), n.astype(np.uint64))
            yield (np.full(len(place), row.rid), first + at, n.astype(np.int32), (place - first).astype(np.int32),
                   _signed(grams[place]), _signed(hull))
    names = ["rid", "lo", "n", "off", "gram", "hull"]
    return rows.mapInPandas(lambda b: _frames(b, of_row, names), "rid bigint, lo bigint, n int, off int, gram bigint, hull bigint")


def _with_text(rows: DataFrame, places: DataFrame, item) -> DataFrame:
    """(rid, text, items) of the texts that have places; ``item``: the struct to gather of each."""
    return rows.join(places.groupBy("rid").agg(F.collect_list(item).alias("items")), "rid")


def steps(rows: DataFrame, edge: DataFrame, length: int) -> DataFrame:
    """(step, core, hull, rid, lo, n): the runs of ``edge`` in steps of STEP windows by their distance to the least gram."""
    core_len = length - STEP + 1

    def of_row(row):
        data = _bytes(row.text)
        lo, n, off, gram = (np.array([x[k] for x in row.items], dtype=np.int64) for k in ("lo", "n", "off", "gram"))
        place, hi = lo + off, lo + n
        piece = lo // (PIECE - length + 1)
        for p in np.unique(piece):
            at = int(p) * (PIECE - length + 1)
            cores, rank = doubled(data[at:at + PIECE], [core_len, length])
            mine = piece == p
            near, far = (place - hi)[mine] // STEP, off[mine] // STEP
            count = far - near + 1
            of = np.repeat(np.arange(mine.sum()), count)
            step = near[of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            anchor = place[mine][of] - step * STEP
            last = np.minimum(hi[mine][of], anchor)
            first = np.maximum(lo[mine][of], anchor - STEP + 1)
            key = pair(gram[mine][of].view(np.uint64), step.astype(np.uint64))
            hull = pair(pair(rank[first - at], rank[last - at]), (last - first).astype(np.uint64))
            core = cores[anchor - at]  # the bytes that all windows of the step share, whole or cut
            yield (_signed(key), _signed(core), _signed(hull), np.full(len(of), row.rid), first, (last - first).astype(np.int32))
    names = ["step", "core", "hull", "rid", "lo", "n"]
    return (_with_text(rows, edge, F.struct("lo", "n", "off", "gram"))
            .mapInPandas(lambda b: _frames(b, of_row, names), "step bigint, core bigint, hull bigint, rid bigint, lo bigint, n int"))


def windows(rows: DataFrame, edge: DataFrame, length: int) -> DataFrame:
    """(step, rank, rid, lo) of every window of the steps in ``edge``."""
    def of_row(row):
        data = _bytes(row.text)
        lo, n, step = (np.array([x[k] for x in row.items], dtype=np.int64) for k in ("lo", "n", "step"))
        piece = lo // (PIECE - length + 1)
        for p in np.unique(piece):
            at = int(p) * (PIECE - length + 1)
            rank, = doubled(data[at:at + PIECE], [length])
            mine = piece == p
            count = n[mine] + 1
            of = np.repeat(np.arange(mine.sum()), count)
            place = lo[mine][of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            yield step[mine][of], _signed(rank[place - at]), np.full(len(of), row.rid), place
    names = ["step", "rank", "rid", "lo"]
    return (_with_text(rows, edge, F.struct("lo", "n", "step"))
            .mapInPandas(lambda b: _frames(b, of_row, names), "step bigint, rank bigint, rid bigint, lo bigint"))


def repeated(rows: DataFrame, length: int = 200) -> DataFrame:
    """(rid, start, stop): byte spans of ``rows`` (rid, text) that strings of ``length`` bytes found elsewhere too cover.

    Spans overlap; their union is what repeats. Ranks are 64-bit values, compared together
    with those of the shorter lengths, so that 128 bits or more agree where strings are held equal.
    """
    if length < GRAM + STEP:
        raise ValueError(f"strings of at least {GRAM + STEP} bytes")
    span = lambda n: (F.col("lo") + n + length).alias("stop")

    run = stored(runs(rows.select("rid", "text"), length), "runs")
    # stored, as a join of two plain shuffles is one that Spark can split where a gram is hot
    twice = stored(run.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram"), "grams")
    run = stored(run.join(twice, "gram", "left_semi"), "runs-repeated")
    kinds = stored(run.groupBy("gram", "hull").agg(F.count("*").alias("c"), F.min(F.struct("rid", "lo", "n", "off")).alias("f")), "hulls")
    settled = kinds.where("c > 1").select("gram", "hull")
    whole = run.join(settled, ["gram", "hull"], "left_semi").select("rid", F.col("lo").alias("start"), span(F.col("n")))
    alone = kinds.where("c = 1")
    partner = kinds.where("c > 1").join(alone.select("gram").distinct(), "gram", "left_semi")
    edge = alone.union(partner.select(alone.columns)).select("gram", "f.*")

    step = stored(steps(rows.select("rid", "text"), edge, length), "steps")
    kinds = step.groupBy("step", "core", "hull").agg(F.count("*").alias("c"), F.min(F.struct("rid", "lo", "n")).alias("f"))
    kinds = stored(kinds, "step-hulls")
    cores = kinds.groupBy("step", "core").agg(F.sum("c").alias("c"), F.sum((F.col("c") == 1).cast("int")).alias("alone"))
    open_cores = cores.where("c > 1 AND alone > 0").select("step", "core")
    settled = kinds.where("c > 1").select("step", "core", "hull")
    whole_steps = step.join(settled, ["step", "core", "hull"], "left_semi").select("rid", F.col("lo").alias("start"), span(F.col("n")))
    edge = kinds.join(open_cores, ["step", "core"], "left_semi").select("step", "f.*")

    window = stored(windows(rows.select("rid", "text"), edge, length), "windows")
    twice = stored(window.groupBy("step", "rank").agg(F.count("*").alias("c")).where("c > 1").select("step", "rank"), "ranks")
    single = window.join(twice, ["step", "rank"], "left_semi").select("rid", F.col("lo").alias("start"), span(F.lit(0)))
    return whole.union(whole_steps).union(single)


def merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans of a union of spans; spans that touch are one."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    gap = np.concatenate(([True], starts[1:] > stops[:-1])) if len(starts) else np.zeros(0, dtype=bool)
    first = np.flatnonzero(gap)
    return starts[first], stops[np.append(first[1:], len(starts)) - 1] if len(first) else stops[:0]


def cut(rows: DataFrame, length: int = 200, keep: bool = True) -> DataFrame:
    """For ``rows`` (rid, text): rid, kept, n_bytes, n_removed, n_spans, kept_sha256.

    ``kept``: with ``keep``, the text left where bytes went, without the rest of a character
    that a span cut apart; NULL where nothing went.
    """
    spans = stored(repeated(rows, length), "spans")
    gathered = spans.groupBy("rid").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for rid, text, found in zip(b["rid"], b["text"], b["spans"]):
                data = (text or "").encode("utf-8", "surrogatepass")
                found = [] if found is None else found
                starts, stops = merged(np.array([s["start"] for s in found], dtype=np.int64),
                                       np.array([s["stop"] for s in found], dtype=np.int64))
                edges = [0, *np.stack([starts, stops], 1).ravel().tolist(), len(data)]
                kept = b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2]))
                left = kept.decode("utf-8", "ignore") if keep and len(starts) else None
                out.append((rid, left, len(data), len(data) - len(kept), len(starts), hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=["rid", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return (rows.select("rid", "text").join(gathered, "rid", "left").select("rid", "text", "spans")
            .mapInPandas(run, "rid bigint, kept string, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"))


def suffix_dedup(docs: DataFrame, length: int = 200, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row.

    Every byte that a repeated string covers goes, in all places it stands in, the first
    too. NULL text is empty; repeated rows repeat each other's strings; NULL ids keep their
    rows; other columns are not read; an empty table gives no rows.
    """
    rows = with_row_id(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    return (cut(rows.select("rid", "text"), length, keep=False).drop("kept").join(rows.select("rid", "doc_id"), "rid")
            .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))

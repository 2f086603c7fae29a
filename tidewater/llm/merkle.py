"""Merkle dataset manifest: aligned subtrees in Van Emde Boas layout, recursing over block roots.

The leaves of a group, in order, are cut into aligned blocks of 2^height. A block is built and
stored as one row: its nodes in Van Emde Boas order, that is the top half of its levels first
and then, one after the other, the subtrees that hang below, each laid out in the same way.
Building recurses over that order, and the address of any node follows from its depth and place
alone, so a proof reads its siblings without pointers and without the block being rehashed.
Block roots are the leaves of the next round, until one block is left in each group; the groups'
roots are the leaves of one more tree. Proofs come down the same way: a block's way to the root
is found once and shared by all its leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import crc32_sql, stored

HEIGHT = 12     # levels above the leaves of a block: 4,096 leaves, 8,191 nodes of 32 bytes
_SIZE = 32      # bytes of a digest
_NODES = "g string, block bigint, n bigint, leaves int, nodes binary, root binary"


def parent(digests: list[bytes]) -> bytes:
    """SHA-256 of the digests' hexadecimal text, one after the other."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places, in the layout of a tree of ``levels`` levels, of the nodes ``index`` at ``depth`` (the root's is 0)."""
    at = np.zeros_like(index)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        below, levels, depth = levels - top, levels - top, depth - top
        at = at + (1 << top) - 1 + (index >> depth) * ((1 << below) - 1)
        index = index & ((1 << depth) - 1)
    return at


def build(nodes: bytearray, at: int, levels: int, low: list[bytes]) -> bytes:
    """Write the tree over the digests ``low`` of its lowest level at place ``at``; its root.

    A level may end early: its last run is a lone node, which is hashed by itself.
    """
    if levels == 1:
        nodes[at * _SIZE:(at + 1) * _SIZE] = low[0]
        return low[0]
    top = levels // 2
    below = levels - top
    first, size, width = at + (1 << top) - 1, (1 << below) - 1, 1 << (below - 1)
    roots = [build(nodes, first + k * size, below, low[k * width:(k + 1) * width]) for k in range(-(-len(low) // width))]
    return build(nodes, at, top, [parent(roots[i:i + 2]) for i in range(0, len(roots), 2)])


def block_levels(n: int, height: int) -> int:
    """Levels of the blocks of a group with n leaves: no more than its tree has."""
    return min(height, (n - 1).bit_length()) + 1


def ways(nodes: bytes, levels: int, leaves: int) -> list[list[str]]:
    """For each leaf its siblings, from the lowest level up: 'L' or 'R' for their side and the digest, or '-' for none."""
    out: list[list[str]] = [[] for _ in range(leaves)]
    place = np.arange(leaves)
    for up in range(levels - 1):
        at = place >> up
        count = -(-leaves // (1 << up))
        beside = at ^ 1
        found = address(levels, levels - 1 - up, np.minimum(beside, count - 1)) * _SIZE
        for way, a, b, f in zip(out, at.tolist(), beside.tolist(), found.tolist()):
            way.append("-" if b >= count else ("L" if b < a else "R") + nodes[f:f + _SIZE].hex())
    return out


def fold(digest: str, way: list[str]) -> str:
    """The root that a leaf's hexadecimal digest and its siblings lead to."""
    for step in way:
        said = digest if step == "-" else step[1:] + digest if step[0] == "L" else digest + step[1:]
        digest = hashlib.sha256(said.encode()).hexdigest()
    return digest


def row_digest(columns: list[Column]) -> Column:
    """SHA-256 (bytes) of the values: '-' for NULL, else the UTF-8 length, ':' and the value as text."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text), F.lit(":"), text))
    return F.unhex(F.sha2(F.concat(*[part(c) for c in columns]), 256))


def indexed(rows: DataFrame, group: str, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``idx``, the place of each in its group by ``order`` from 0, and ``n``, the group's size.

    Rows are dealt by ranges of (group, order, row number), sorted and stored, so no group and no
    run of equal rows fills one task; a range's share of a group starts where the ranges before
    end, which is summed over one row for each range and group.
    """
    sort = [group, *order, "rid"]
    kept = [c for c in rows.columns if c != "rid"]
    placed = stored(rows.withColumn("rid", F.monotonically_increasing_id()).repartitionByRange(*sort)
                    .sortWithinPartitions(*sort).select(*kept, F.monotonically_increasing_id().alias("seq"))
                    .withColumn("piece", F.shiftright("seq", 33)), label, compression="zstd")
    whole = Window.partitionBy(group)
    before = whole.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy(group, "piece").agg(F.min("seq").alias("lo"), F.count("*").alias("m"))
              .select(group, "piece", (F.coalesce(F.sum("m").over(before), F.lit(0)) - F.col("lo")).alias("shift"),
                      F.sum("m").over(whole).alias("n")))
    return (placed.join(starts, [group, "piece"])
            .select(*kept, (F.col("seq") + F.col("shift")).alias("idx"), "n"))


@dataclass
class Tree:
    """Stored blocks of a forest, one frame for each round from the leaves up, and the root of each group."""
    rounds: list[DataFrame]
    roots: DataFrame
    height: int


def grow(rows: DataFrame, label: str, height: int = HEIGHT) -> Tree:
    """Trees over rows (g, idx, n, digest): blocks of leaves, then of block roots, and so on."""
    def of_block(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("idx")
        n = int(part["n"].iloc[0])
        levels = block_levels(n, height)
        nodes = bytearray(((1 << levels) - 1) * _SIZE)
        root = build(nodes, 0, levels, [bytes(d) for d in part["digest"]])
        return pd.DataFrame({"g": [key[0]], "block": [key[1]], "n": [n], "leaves": [len(part)], "nodes": [bytes(nodes)], "root": [root]})

    rounds, roots = [], None
    most = rows.agg(F.max("n")).first()[0] or 0
    while True:
        blocks = stored(rows.withColumn("block", F.shiftright("idx", height)).groupBy("g", "block")
                        .applyInPandas(of_block, _NODES), label, compression="zstd")
        rounds.append(blocks)
        done = blocks.where(F.col("n") <= 1 << height).select("g", "root")
        roots = done if roots is None else roots.union(done)
        if most <= 1 << height:
            return Tree(rounds, roots, height)
        rows = (blocks.where(F.col("n") > 1 << height)
                .select("g", F.col("block").alias("idx"), F.shiftright(F.col("n") + ((1 << height) - 1), height).alias("n"), F.col("root").alias("digest")))
        most = -(-most // (1 << height))


def block_ways(tree: Tree, above: DataFrame) -> DataFrame:
    """(g, block, up): for each block of leaves the steps from its root up, where ``above`` (g, up) goes on from a group's root."""
    height = tree.height

    def of_leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for g, block, n, leaves, nodes, up in zip(*(batch[c] for c in ("g", "block", "n", "leaves", "nodes", "up"))):
                found = ways(nodes, block_levels(n, height), leaves)
                yield pd.DataFrame({"g": g, "block": (block << height) + np.arange(leaves), "up": [",".join([*w, up] if up else w) for w in found]})
    ups = None
    for depth in range(len(tree.rounds) - 1, -1, -1):
        blocks = tree.rounds[depth]
        own = blocks.where(F.col("n") <= 1 << height).select("g", "block").join(above, "g")
        ups = own if ups is None else own.unionByName(ups)
        if depth:
            ups = stored(blocks.join(ups, ["g", "block"]).mapInPandas(of_leaves, "g string, block bigint, up string"), "ways")
    return ups


@dataclass
class Manifest:
    """Leaves (g, idx, n, digest and kept columns), the groups' trees, the roots in turn (name, idx, digest), the tree over them, its root."""
    leaves: DataFrame
    groups: Tree
    tops: DataFrame
    top: Tree
    root: str | None

    def nodes(self) -> DataFrame:
        """All blocks: tree ('group' or 'top'), round, g ('=' and the group's value; '' for NULL), block, n, leaves, nodes, root."""
        frames = [b.select(F.lit(name).alias("tree"), F.lit(r).alias("round"), "*")
                  for name, tree in (("group", self.groups), ("top", self.top)) for r, b in enumerate(tree.rounds)]
        out = frames[0]
        for f in frames[1:]:
            out = out.union(f)
        return out

    def write(self, path: str) -> None:
        self.nodes().write.partitionBy("tree", "round").parquet(path)


def manifest(rows: DataFrame, group: str, order: list[str], digest: str, keep: list[str] = (), height: int = HEIGHT) -> Manifest:
    """Trees over the ``digest`` (bytes) of rows by ``group``, in ``order``; equal rows are leaves of their own.

    NULL ranks first in ``order`` and among the groups, which go by their UTF-8 bytes. Rows
    that agree in ``order`` go by their digest. Only the named columns are read; the leaves
    carry those of ``keep``.
    """
    keyed = rows.select(F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("g"),
                        F.col(digest).alias("digest"), *[F.col(c).alias(f"by{k}") for k, c in enumerate(order)],
                        F.struct(*[F.col(c) for c in keep] or [F.lit(0)]).alias("own"))
    by = [f"by{k}" for k in range(len(order))]
    leaves = stored(indexed(keyed, "g", [*by, "digest"], "leaves").drop(*by), "leaves", compression="zstd")
    groups = grow(leaves, "blocks", height)
    tops = stored(indexed(groups.roots.select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("root").alias("digest")),
                          "g", ["name"], "subroots"), "tops")
    top = grow(tops, "tops", height)
    last = top.roots.first()
    return Manifest(leaves, groups, tops, top, last["root"].hex() if last else None)


def proofs(made: Manifest, keep: list[str], suspect: str) -> DataFrame:
    """Each leaf's proof: its siblings' hash and the root that ``suspect`` (bytes; NULL: the leaf itself) leads to.

    ``suspect`` and ``keep`` are columns that the manifest kept.
    """
    spark = made.leaves.sparkSession
    above_top = spark.createDataFrame([("", "")], "g string, up string")
    height = made.top.height
    in_top = block_ways(made.top, above_top)

    def of_tops(key: tuple, rows: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        block = blocks.iloc[0]
        found = ways(block["nodes"], block_levels(int(block["n"]), height), int(block["leaves"]))
        up = [block["up"]] if block["up"] else []
        rows = rows.sort_values("idx")
        return pd.DataFrame({"g": rows["name"], "up": [",".join(w + up) for w in found], "subroot": [d.hex() for d in rows["digest"]]})

    def with_ways(tree: Tree, ups: DataFrame) -> DataFrame:
        return tree.rounds[0].select("g", "block", "n", "leaves", "nodes").join(ups, ["g", "block"])
    blocked = [F.col("g"), F.shiftright("idx", height).alias("block")]
    above = stored(made.tops.select(*blocked, "idx", "name", "digest").groupBy("g", "block")
                   .cogroup(with_ways(made.top, in_top).groupBy("g", "block"))
                   .applyInPandas(of_tops, "g string, up string, subroot string"), "subroots")
    root, kinds = made.root, {f.name: f.dataType for f in made.leaves.schema["own"].dataType}

    def of_leaves(key: tuple, rows: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        block = blocks.iloc[0]
        rows = rows.sort_values("idx")
        up = block["up"].split(",") if block["up"] else []
        out = []
        for leaf, other, way in zip(rows["digest"], rows["suspect"], ways(block["nodes"], block_levels(int(block["n"]), height), int(block["leaves"]))):
            way = way + up
            reached = fold((leaf if other is None else other).hex(), way)
            proof = hashlib.sha256("".join(s[1:] for s in way).encode()).hexdigest()
            out.append((leaf.hex(), block["subroot"], root, proof, reached, reached == root))
        found = pd.DataFrame(out, columns=["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
        return pd.concat([rows[keep].reset_index(drop=True), found], axis=1)
    found = with_ways(made.groups, block_ways(made.groups, above.select("g", "up"))).join(above.select("g", "subroot"), "g")
    texts = made.leaves.select(*blocked, "idx", "digest", F.col(f"own.{suspect}").alias("suspect"),
                               *[F.col(f"own.{c}").cast("string").alias(c) for c in keep])
    out = (texts.groupBy("g", "block").cogroup(found.groupBy("g", "block"))
           .applyInPandas(of_leaves, ", ".join(f"{c} string" for c in keep)  # pandas would turn ids beside a NULL into floats
                          + ", leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"))
    return out.select(*[F.col(c).cast(kinds[c]).alias(c) for c in keep], "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def document_proofs(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Per document its leaf, the roots, its proof's hash, and whether the proof holds after tampering.

    A leaf hashes doc_id, source, lang, n_chars and text. Leaves go by lang, then doc_id (NULL
    first, equal ids by digest). Where 7 divides the CRC-32 of the id's text, the leaf that is
    proved has n_chars + 1 (NULL stays NULL; a NULL id is never tampered with). Repeated rows
    are leaves of their own, whose proofs differ by place; an empty table gives no rows. Only these
    five columns are read. What a task holds is a block of 2^height leaves, or one text's hash.
    """
    cols = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    more = [F.col("n_chars").cast("decimal(38,0)") + 1 if k == 3 else c for k, c in enumerate(cols)]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    hashed = stored(docs.select("doc_id", "lang", row_digest(cols).alias("leaf"), F.when(hit, row_digest(more)).alias("tampered")),
                    "digests", compression="zstd")
    return proofs(manifest(hashed, "lang", ["doc_id"], "leaf", ["doc_id", "tampered"], height), ["doc_id"], "tampered")


def oracle(table: str = "documents") -> str:
    """DuckDB SQL for ``document_proofs``: trees level by level, proofs and folds by recursion."""
    def said(v: str) -> str:
        return f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR) END"

    def leaf(n_chars: str) -> str:
        return f"sha256({' || '.join(said(v) for v in ('doc_id', 'source', 'lang', n_chars, 'text'))})"
    tree = """
{name}(g, lvl, idx, h) AS (
  SELECT g, 0, idx, h FROM {start}
  UNION ALL
  SELECT g, lvl + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS m FROM {name}) WHERE m > 1 GROUP BY g, lvl, idx // 2)"""
    return f"""
WITH RECURSIVE ids AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS s FROM {table} WHERE doc_id IS NOT NULL),{crc32_sql('crc', 'ids')},
hit AS (SELECT s FROM crc WHERE crc % 7 = 0),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS idx
  FROM (SELECT doc_id, coalesce('=' || lang, '') AS g, {leaf('n_chars')} AS h,
               CASE WHEN CAST(doc_id AS VARCHAR) IN (SELECT s FROM hit) THEN {leaf('(n_chars::HUGEINT + 1)')} END AS tampered FROM {table})),
{tree.format(name='low', start='leaves')},
tops AS (SELECT '' AS g, g AS name, h, row_number() OVER (ORDER BY g) - 1 AS idx
         FROM (SELECT g, arg_max(h, lvl) AS h FROM low GROUP BY g)),
{tree.format(name='high', start='tops')},
nodes AS (SELECT g, lvl, idx, h, max(lvl) OVER (PARTITION BY g) AS top FROM (SELECT 'l' || g AS g, lvl, idx, h FROM low UNION ALL SELECT 't', lvl, idx, h FROM high)),
-- each leaf's steps: up its own tree, then up the tree of the subroots
steps AS (
  SELECT l.g, l.idx, l.doc_id, l.h, n.lvl AS step, (l.idx >> n.lvl) % 2 AS odd, n.g AS tree, xor(l.idx >> n.lvl, 1) AS beside, n.lvl
  FROM leaves l JOIN (SELECT DISTINCT g, lvl, top FROM nodes) n ON n.g = 'l' || l.g AND n.lvl < n.top
  UNION ALL
  SELECT l.g, l.idx, l.doc_id, l.h, 1000 + n.lvl, (t.idx >> n.lvl) % 2, n.g, xor(t.idx >> n.lvl, 1), n.lvl
  FROM leaves l JOIN tops t ON t.name = l.g JOIN (SELECT DISTINCT g, lvl, top FROM nodes) n ON n.g = 't' AND n.lvl < n.top),
way AS (
  SELECT s.g, s.idx, odd, n.h AS sib, row_number() OVER (PARTITION BY s.g, s.idx ORDER BY step) AS k
  FROM steps s LEFT JOIN nodes n ON n.g = s.tree AND n.lvl = s.lvl AND n.idx = s.beside),
proof AS (SELECT g, idx, sha256(coalesce(string_agg(sib, '' ORDER BY k), '')) AS proof_sha256 FROM way GROUP BY g, idx),
folded(g, idx, k, h) AS (
  SELECT g, idx, CAST(1 AS BIGINT), coalesce(tampered, h) FROM leaves
  UNION ALL
  SELECT f.g, f.idx, f.k + 1, sha256(CASE WHEN sib IS NULL THEN f.h WHEN odd = 1 THEN sib || f.h ELSE f.h || sib END)
  FROM folded f JOIN way w ON w.g = f.g AND w.idx = f.idx AND w.k = f.k),
reached AS (SELECT g, idx, arg_max(h, k) AS folded_root FROM folded GROUP BY g, idx)
SELECT doc_id, l.h AS leaf, t.h AS subroot, r.h AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = r.h AS verified
FROM leaves l JOIN tops t ON t.name = l.g JOIN reached f ON f.g = l.g AND f.idx = l.idx
CROSS JOIN (SELECT arg_max(h, lvl) AS h FROM high) r LEFT JOIN proof p ON p.g = l.g AND p.idx = l.idx"""

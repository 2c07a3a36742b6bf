"""Merkle manifest of a table: a persistent tree whose versions copy only the path to the changed leaf.

Leaves are hashed by Spark and numbered per tree over range partitions.  The tree is cut into
aligned blocks of ``FAN ** levels`` leaves (a row each), blocks of block roots, and so on, so no
task holds more than one block however large a tree is.  A changed leaf makes a version: its
ancestors in the block are copied, every other node is shared with the first version, and the copying
goes on through the upper blocks along the path that each block row gets from the tiers above.

Defined cases: null fields are `-`; null lang is a tree of its own, the first; a null doc_id comes
first in its tree and is not tampered with; rows of equal doc_id go by leaf hash, equal rows are leaves of
their own; an empty table has no rows, no tree and no root; a text of any length is hashed in the JVM;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import column, sized, stored, table, tuned
from .order import numbered

FAN = 8
#: Levels of the tree in one block: 4096 leaves.
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _h(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


class BlockTree:
    """One block's part of a tree: ``levels[0]`` are its leaves, the last level its only root.

    A version is the list of copied ancestors of one leaf; it shares all other nodes with the block."""

    def __init__(self, leaves: list[bytes], steps: int):
        self.levels, self.runs = [leaves], []
        for _ in range(steps):
            below = self.levels[-1]
            runs = [b"".join(below[k:k + FAN]) for k in range(0, len(below), FAN)]
            self.runs.append(runs)
            self.levels.append([_h(r) for r in runs])

    @property
    def root(self) -> bytes:
        return self.levels[-1][0]

    def path(self, i: int) -> tuple[list[bytes], list[bytes]]:
        """The siblings left and right of a leaf's ancestors, joined per level."""
        left, right = [], []
        for runs in self.runs:
            i, k = divmod(i, FAN)
            left.append(runs[i][:64 * k])
            right.append(runs[i][64 * (k + 1):])
        return left, right

    def copied(self, i: int, leaf: bytes) -> list[bytes]:
        """The ancestors of leaf ``i`` in the version in which it is ``leaf``."""
        out = []
        for left, right in zip(*self.path(i)):
            leaf = _h(left + leaf + right)
            out.append(leaf)
        return out


def steps_of(size: int, levels: int) -> int:
    """Levels above the nodes of a block, in a tree (from this tier up) of ``size`` nodes."""
    steps = 0
    while FAN ** steps < size and steps < levels:
        steps += 1
    return steps


@dataclass
class Tiers:
    """The blocks of all trees from the leaves up, and the root of each tree."""

    blocks: list[DataFrame]
    roots: DataFrame
    levels: int


def _blocks(nodes: DataFrame, extra: list[str], levels: int) -> DataFrame:
    """A row per block: its nodes (place, digest, others) by place."""
    block = nodes.groupBy("tree", F.expr(f"place div {FAN ** levels}").alias("block"))
    return block.agg(F.first("size").alias("size"), F.sort_array(F.collect_list(F.struct("place", "digest", *extra))).alias("nodes"))


def _tree(row: dict, levels: int) -> BlockTree:
    return BlockTree([n["digest"].hex().encode() for n in row["nodes"]], steps_of(row["size"], levels))


def _roots(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = column(batch, "size").to_pylist()
            roots = [bytes.fromhex(_tree(row, levels).root.decode()) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "tree"), column(batch, "block"), pa.array([-(-s // FAN ** levels) for s in size], pa.int64()), pa.array(roots, pa.binary())],
                names=["tree", "place", "size", "digest"])
    return run


def tiers(nodes: DataFrame, extra: list[str], levels: int = LEVELS) -> Tiers:
    """``nodes``: tree, place (0 .. size - 1), size, digest, and what the leaves carry."""
    blocks = []
    while True:
        blocks.append(stored(_blocks(nodes, [] if blocks else extra, levels), "blocks"))
        nodes = stored(blocks[-1].mapInArrow(_roots(levels), "tree long, place long, size long, digest binary"), "roots")
        if (nodes.agg(F.max("size").alias("m")).first()["m"] or 1) == 1:
            return Tiers(blocks, nodes, levels)


def _paths(levels: int):
    """The path of every node of a block: its own, then that of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes, block = row["nodes"], _tree(row, levels)
                paths = [block.path(i) for i in range(len(nodes))]
                yield pa.RecordBatch.from_pydict({
                    "tree": pa.array([row["tree"]] * len(nodes), pa.int64()), "place": pa.array([n["place"] for n in nodes], pa.int64()), "digest": pa.array([n["digest"] for n in nodes], pa.binary()),
                    "left": pa.array([[x.decode() for x in p[0]] + (row["left"] or []) for p in paths], pa.list_(pa.string())),
                    "right": pa.array([[x.decode() for x in p[1]] + (row["right"] or []) for p in paths], pa.list_(pa.string()))})
    return run


def _with_path(blocks: DataFrame, above: DataFrame | None) -> DataFrame:
    if above is None:
        none = F.lit(None).cast("array<string>")
        return blocks.select("tree", "block", "size", "nodes", none.alias("left"), none.alias("right"))
    path = above.select(F.col("tree").alias("_t"), F.col("place").alias("_p"), "left", "right")
    return blocks.join(path, (F.col("tree") == F.col("_t")) & (F.col("block") == F.col("_p"))).drop("_t", "_p")


def paths(built: Tiers, lowest: int = 0) -> DataFrame | None:
    """(tree, place, digest, left, right): the siblings on the way from each node of a tier to its tree's root."""
    above = None
    for blocks in reversed(built.blocks[lowest:]):
        above = stored(_with_path(blocks, above).mapInArrow(_paths(built.levels), "tree long, place long, digest binary, left array<string>, right array<string>"), "paths")
    return above


@dataclass
class Manifest:
    """The trees of all langs, the tree of their subroots, and the root (None for an empty table)."""

    langs: Tiers
    top: Tiers
    root: str | None


def _value(c: Column) -> Column:
    c = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))


def leaf_hash(docs: DataFrame, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*(_value(text if c == "text" else docs[c]) for c in FIELDS)).cast("binary"), 256))


def lowered(docs: DataFrame) -> Column:
    return F.translate(docs["text"], UPPER, LOWER)


def manifest(docs: DataFrame, tampered: Column, changed_text: Column, levels: int = LEVELS) -> Manifest:
    """The manifest of the documents.  A leaf also carries ``changed``, the hash of its row with
    ``changed_text`` for its text where ``tampered`` holds: the change that makes its version."""
    tuned(docs.sparkSession)
    leaves = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), leaf_hash(docs, docs["text"]).alias("digest"),
        F.when(tampered, leaf_hash(docs, changed_text)).alias("changed"), F.monotonically_increasing_id().alias("row")), "leaves")
    placed, langs = numbered(leaves, ["lang"], ["doc_id", "digest", "row"])
    trees, _ = numbered(langs.select("lang"), [], ["lang"])
    trees = stored(trees.select(F.col("lang").alias("_lang"), F.col("place").alias("tree")), "trees")
    nodes = placed.join(sized(trees, 64, F.octet_length("_lang")), F.col("lang").eqNullSafe(F.col("_lang"))).select("tree", "place", "size", "digest", "doc_id", "changed")
    built = tiers(nodes, ["doc_id", "changed"], levels)
    n = trees.count()
    top = tiers(built.roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(n).cast("long").alias("size"), "digest"), [], levels)
    root = top.roots.select(F.lower(F.hex("digest")).alias("h")).first()
    return Manifest(built, top, root and root["h"])


def _leaf_blocks(m: Manifest) -> DataFrame:
    """The leaf blocks with the path from each to the root of all, and with their subroot."""
    subs = paths(m.top).select(F.col("place").alias("_s"), F.lower(F.hex("digest")).alias("subroot"), F.col("left").alias("_l"), F.col("right").alias("_r"))
    blocks = _with_path(m.langs.blocks[0], paths(m.langs, 1) if len(m.langs.blocks) > 1 else None)
    blocks = blocks.join(sized(subs, 64 + 64 * FAN * 12), F.col("tree") == F.col("_s"))
    none = F.array().cast("array<string>")
    return blocks.select("tree", "size", "nodes", "subroot", F.concat(F.coalesce("left", none), "_l").alias("left"), F.concat(F.coalesce("right", none), "_r").alias("right"))


def _verify(root: str, levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes, block = row["nodes"], _tree(row, levels)
                leaves = block.levels[0]
                left, right = ([x.encode() for x in row[side]] for side in ("left", "right"))
                beyond = b"".join(a + b for a, b in zip(left, right))
                folded: dict[bytes, str] = {}

                def above(node: bytes) -> str:
                    """The version's root: the copying goes on above the block (once for each block root)."""
                    if node not in folded:
                        at = node
                        for a, b in zip(left, right):
                            at = _h(a + at + b)
                        folded[node] = at.decode()
                    return folded[node]

                proof, fold = [], []
                for i, n in enumerate(nodes):
                    proof.append(hashlib.sha256(b"".join(a + b for a, b in zip(*block.path(i))) + beyond).hexdigest())
                    own = leaves[i] if n["changed"] is None else n["changed"].hex().encode()
                    fold.append(above((block.copied(i, own) or [own])[-1]))
                k = len(nodes)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([n["doc_id"] for n in nodes], pa.int64()), "leaf": [x.decode() for x in leaves], "subroot": [row["subroot"]] * k, "root": [root] * k,
                    "proof_sha256": proof, "folded_root": fold, "verified": [f == root for f in fold]})
    return run


def verified(m: Manifest) -> DataFrame:
    """One row per leaf: its proof, the root of its version, and whether that is the manifest's."""
    return _leaf_blocks(m).mapInArrow(_verify(m.root, m.langs.levels), RESULT)


def _versions(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                out, block = [], _tree(row, levels)
                for i, n in enumerate(row["nodes"]):
                    if n["changed"] is None:
                        continue
                    at = n["changed"].hex().encode()
                    copies = [at, *block.copied(i, at)]
                    for a, b in zip(row["left"], row["right"]):
                        copies.append(_h(a.encode() + copies[-1] + b.encode()))
                    out += [(n["doc_id"], row["tree"], n["place"], level, c.decode()) for level, c in enumerate(copies)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string()))], names=["doc_id", "tree", "place", "level", "digest"])
    return run


def versions(m: Manifest) -> DataFrame:
    """The nodes that each changed leaf's version copies, from the leaf (level 0) to the root; all others are shared."""
    return _leaf_blocks(m).mapInArrow(_versions(m.langs.levels), "doc_id long, tree long, place long, level int, digest string")


def every_third(docs: DataFrame) -> Column:
    return F.coalesce(F.crc32(docs["doc_id"].cast("string").cast("binary")) % 3 == 0, F.lit(False))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return verified(manifest(docs, every_third(docs), lowered(docs)))


#: crc32 of a decimal id: eight shifts a character.
CRC32 = """xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
  lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295)"""


def _oracle(levels: int = 9) -> str:
    """The tree level by level; ``levels`` is enough for 8 ** 9 rows."""
    value = "CASE WHEN {0} IS NULL THEN '-' ELSE CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR) END".format
    lower = f"translate(text, '{UPPER}', '{LOWER}')"
    out = [f"""WITH docs AS (SELECT *, sha256({' || '.join(value(c) for c in FIELDS)}) AS leaf,
  CASE WHEN doc_id IS NOT NULL AND {CRC32.format('doc_id')} % 3 = 0 THEN sha256({' || '.join(value(lower if c == 'text' else c) for c in FIELDS)}) END AS changed FROM documents),
l0 AS (SELECT lang, doc_id, leaf, coalesce(changed, leaf) AS own, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM docs)"""]

    def climb(tag: str, first: str, group: str):
        out.append(f"{tag}0 AS ({first})")
        for k in range(levels):
            g = f"{group}, i // 8"
            out.append(f"""{tag}s{k} AS (SELECT {group}, i, d, count(*) OVER (PARTITION BY {group}) AS n,
  coalesce(string_agg(d, '') OVER (PARTITION BY {g} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(d, '') OVER (PARTITION BY {g} ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {tag}{k})""")
            out.append(f"{tag}{k + 1} AS (SELECT {group}, i // 8 AS i, CASE WHEN max(n) = 1 THEN max(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d FROM {tag}s{k} GROUP BY {g})")

    climb("t", "SELECT lang, i, leaf AS d FROM l0", "lang")
    climb("u", f"SELECT 0 AS g, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, d FROM t{levels}", "g")
    out.append(f"langs AS (SELECT lang, d AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM t{levels})")
    out.append("p0 AS (SELECT l0.lang AS lang, doc_id, leaf, subroot, l0.i AS i, langs.i AS li, own AS f, '' AS p FROM l0 JOIN langs ON l0.lang IS NOT DISTINCT FROM langs.lang)")
    step = 0
    for tag, at, on in (("t", "i", "p.lang IS NOT DISTINCT FROM s.lang"), ("u", "li", "true")):
        for k in range(levels):
            out.append(f"""p{step + 1} AS (SELECT p.lang AS lang, doc_id, leaf, subroot, p.i AS i, p.li AS li, CASE WHEN n = 1 THEN f ELSE sha256(l || f || r) END AS f, p || l || r AS p
  FROM p{step} p JOIN {tag}s{k} s ON {on} AND p.{at} // {FAN ** k} = s.i)""")
            step += 1
    return ",\n".join(out) + f"\nSELECT doc_id, leaf, subroot, u{levels}.d AS root, sha256(p) AS proof_sha256, f AS folded_root, f = u{levels}.d AS verified FROM p{step} CROSS JOIN u{levels}"


ORACLE = _oracle()

"""Prefix trie of conversations, with subtree totals rolled up over bands of depths.

Every conversation is dealt in pieces of ``PIECE`` turns, each of which knows the hash of the turns before it,
so a node (a distinct sequence of first turns) is the 122-bit polynomial hash of its turns, known
without walking the trie round by round.  Totals of subtrees: a node is exploded only to its ancestors in its own
band of ``BAND`` depths; band roots then are the nodes of a trie ``BAND`` times as flat, which is rolled up the same way, and the completed
totals of band roots go to their ancestors in the band above.  Rounds are the logarithm of the
depth (and one for each ``PIECE`` turns of the deepest conversation), and a node is exploded to ``BAND`` rows at most.

Defined cases: rows without conv_id belong to no conversation and are left out; null roles and texts are empty;
a null turn comes first, and equal turns of a conversation go by the hash of role and text; a repeated row is a turn of its own;
an empty table has no node, not even a root; texts and conversations of any length; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import column, groups, sized, stored, table, tuned
from .merkle import CRC32
from .order import numbered

BAND = 8
#: Levels of bands inside a piece of a conversation, and its turns.
LEVELS = 3
PIECE = BAND ** LEVELS

P = 2 ** 61 - 1
BASES = (0x1B873593CC9E2D51 % P, 0x0C2B2AE3D27D4EB3 % P)
ROOT = bytes(16)
WORD = r"[^\x20\x09-\x0D]+"
#: Ids in one stretch of the list that a node's digest runs over.
STRETCH = 4096

NODE = "key binary, depth long, conv_id long, words long, parent binary, " + ", ".join(f"{c}{i} array<binary>" for i in range(LEVELS) for c in "au")


def _turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the numbered turns: conv_id, place, digest, words; the conversations: conv_id, size)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    turns, sizes = numbered(stored(rows.withColumn("row", F.monotonically_increasing_id()), "turns"), ["conv_id"], ["turn", "digest", "row"])
    return turns.select("conv_id", "place", "digest", "words"), sizes


def _heads(conv: str = "conv_id") -> Column:
    return F.crc32(F.col(conv).cast("string").cast("binary")) % 4


def _base(conv: str = "conv_id") -> Column:
    return F.col(conv) - F.col(conv) % 20


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns: conv_id, place, digest, words; conversations: conv_id, size), with the heads taken from the first of twenty."""
    turns, sizes = _turns(conversations)
    turns = stored(turns, "numbered")
    bases = sizes.where("conv_id % 20 = 0").select(F.col("conv_id").alias("b"), F.col("size").alias("b_size"))
    convs = sizes.withColumn("h", _heads()).withColumn("b", _base()).join(bases, "b", "left")
    convs = stored(convs.withColumn("taken", F.least("h", F.coalesce("b_size", F.lit(0)))).select("conv_id", "b", "h", "taken", (F.col("taken") + F.greatest(F.col("size") - F.col("h"), F.lit(0))).alias("size")), "convs")
    plan = convs.select("conv_id", "h", "taken")
    own = turns.join(sized(plan, 24), "conv_id").where("place >= h").select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "digest", "words")
    heads = turns.where("place < 3 and conv_id % 20 = 0").withColumnRenamed("conv_id", "b")
    taken = convs.select("conv_id", "b", "h").join(heads, "b").where("place < h").select("conv_id", "place", "digest", "words")
    return own.unionByName(taken), convs.select("conv_id", "size")


def _terms(digests: list[bytes], place: int) -> Iterator[tuple[int, int]]:
    """The polynomial terms of consecutive turns, the first of which is at ``place``."""
    powers = [pow(b, place, P) for b in BASES]
    for d in digests:
        yield tuple(int.from_bytes(d[8 * k:8 * k + 8], "big") % P * powers[k] % P for k in (0, 1))
        powers = [p * b % P for p, b in zip(powers, BASES)]


#: Rows that a pass gathers from many (mostly short) pieces before it gives them out.
ROWS = 4000
LISTS = [f"{c}{i}" for i in range(LEVELS) for c in "au"]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The terms of each piece added up."""
    out: list[tuple] = []

    def given() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["conv_id", "piece", "a", "b"])

    for (conv, piece), rows in groups(batches, "conv_id", "piece"):
        a = b = 0
        for x, y in _terms(rows["digest"].to_pylist(), piece * PIECE):
            a, b = (a + x) % P, (b + y) % P
        out.append((conv, piece, a, b))
        if len(out) >= ROWS:
            yield given()
            out = []
    if out:
        yield given()


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per turn: the node of the turns up to it, its parent, and its ancestors by level of bands.

    a<i>: those at depths divisible by BAND ** i in its band of that level, itself last;
    u<i>: for the root of a band of level i, the nodes of the band above it."""
    names = ["key", "depth", "conv_id", "words", "parent", *LISTS]
    types = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.list_(pa.binary())] * len(LISTS)]
    out: list[tuple] = []

    def given() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    for (conv, piece), rows in groups(batches, "conv_id", "piece"):
        a, b = rows["a"][0].as_py(), rows["b"][0].as_py()
        key = a.to_bytes(8, "big") + b.to_bytes(8, "big")
        bands = [[key] for _ in range(LEVELS)]
        depth = piece * PIECE
        for (x, y), words in zip(_terms(rows["digest"].to_pylist(), depth), rows["words"].to_pylist()):
            parent = key
            a, b = (a + x) % P, (b + y) % P
            key = a.to_bytes(8, "big") + b.to_bytes(8, "big")
            depth += 1
            lists: list[list[bytes] | None] = []
            for i in range(LEVELS):
                own = above = None
                if depth % BAND ** i == 0:
                    if depth % BAND ** (i + 1) == 0:
                        above, bands[i] = bands[i], []
                    bands[i] = own = [*bands[i], key]
                lists += (own, above)
            out.append((key, depth, conv, words, parent, *lists))
        if len(out) >= ROWS:
            yield given()
            out = []
    if out:
        yield given()


def prefixes(turns: DataFrame) -> DataFrame:
    """The node of every turn of every conversation (stored)."""
    dealt = stored(turns.withColumn("piece", F.expr(f"place div {PIECE}")), "pieces")
    by_piece = dealt.select("conv_id", "piece", "place", "digest").repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", "place")
    sums = by_piece.mapInArrow(_sums, "conv_id long, piece long, a long, b long")
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    start = [(F.coalesce(F.sum(F.col(c).cast("decimal(38,0)")).over(before), F.lit(0).cast("decimal(38,0)")) % F.lit(P).cast("decimal(38,0)")).cast("long").alias(c) for c in "ab"]
    starts = stored(sums.select("conv_id", "piece", *start), "starts")
    placed = dealt.join(starts, ["conv_id", "piece"]).repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", "place")
    return stored(placed.mapInArrow(_nodes, NODE), "prefixes")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) as stretches of decimal ids, each of one node."""
    for batch in batches:
        keys, ids = column(batch, "key").to_pylist(), column(batch, "conv_id").to_pylist()
        cuts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1] or i % STRETCH == 0]
        yield pa.RecordBatch.from_arrays(
            [pa.array([keys[i] for i in cuts], pa.binary()), pa.array([ids[i] for i in cuts], pa.int64()), pa.array([",".join(map(str, ids[i:j])) for i, j in zip(cuts, [*cuts[1:], len(keys)])], pa.string())],
            names=["key", "first", "ids"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of a node, in order, run through one hash; nothing of them is kept."""
    key, run = None, None
    for batch in batches:
        done = []
        for k, ids in zip(column(batch, "key").to_pylist(), column(batch, "ids").to_pylist()):
            if k == key:
                run.update(b"," + ids.encode())
                continue
            if run is not None:
                done.append((key, run.hexdigest()))
            key, run = k, hashlib.sha256(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done])], names=["key", "ends_sha256"])
    if run is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([run.hexdigest()])], names=["key", "ends_sha256"])


def ends(last: DataFrame) -> DataFrame:
    """(key, ends_sha256) from (key, conv_id): the hash of each node's ids, joined in order.

    A hot node's ids are sorted over many range partitions; one task sees only their stretches,
    as a hash of a sequence has to be taken in sequence."""
    listed = last.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(_listed, "key binary, first long, ids string")
    return stored(listed.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digested, "key binary, ends_sha256 string"), "ends")


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))


def rolled_up(nodes: DataFrame) -> DataFrame:
    """(key, leaf, saved): both values of the (stored) nodes summed over subtrees."""
    deepest = nodes.agg(F.max("depth").alias("d")).first()["d"] or 0
    levels = next((i for i in range(1, LEVELS) if BAND ** i > deepest), LEVELS)
    inside, now = [], nodes
    for i in range(levels):
        inside.append(stored(_summed(now.select(F.explode(f"a{i}").alias("key"), "leaf", "saved")), "band"))
        now = nodes.where(F.col("depth") % BAND ** (i + 1) == 0).drop("leaf", "saved").join(inside[i], "key")
    # band roots of the last level: completed from the deepest up
    top = f"u{levels - 1}"
    now = stored(now.select("key", "depth", "leaf", "saved", top), "tops")
    for k in range(deepest // BAND ** levels, 0, -1):
        at = F.col("depth") == k * BAND ** levels
        more = _summed(now.where(at).select(F.element_at(top, 1).alias("key"), "leaf", "saved")).select("key", F.col("leaf").alias("l"), F.col("saved").alias("s"))
        now = stored(now.join(more, "key", "left").select("key", "depth", (F.col("leaf") + F.coalesce("l", F.lit(0))).alias("leaf"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"), top), "tops")
    total = now
    for i in range(levels - 1, -1, -1):
        roots = nodes.where((F.col("depth") > 0) & (F.col("depth") % BAND ** (i + 1) == 0)).select("key", f"u{i}")
        below = roots.join(total.select("key", "leaf", "saved"), "key")
        more = _summed(below.select(F.explode(f"u{i}").alias("key"), "leaf", "saved")).select("key", F.col("leaf").alias("l"), F.col("saved").alias("s"))
        total = stored(inside[i].join(more, "key", "left").select("key", (F.col("leaf") + F.coalesce("l", F.lit(0))).alias("leaf"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")), "totals")
    return total


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie of the given conversations (turns: conv_id, place, digest, words; convs: conv_id, size)."""
    rows = prefixes(turns)
    grouped = rows.groupBy("key", "depth").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *(F.any_value(c).alias(c) for c in ("words", "parent", *LISTS)))
    self_only, none = F.array(F.lit(ROOT)), F.lit(None).cast("array<binary>")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        F.lit(ROOT).alias("key"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("long").alias("words"), F.lit(None).cast("binary").alias("parent"),
        *((self_only if c[0] == "a" else none).alias(c) for c in LISTS))
    nodes = stored(grouped.unionByName(root), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(stored(children, "children"), "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = stored(nodes.withColumn("leaf", (F.col("n_children") == 0).cast("long")).withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "nodes")
    last = rows.select("key", "depth", "conv_id").join(convs.select(F.col("conv_id").alias("c"), "size"), (F.col("conv_id") == F.col("c")) & (F.col("depth") == F.col("size"))).select("key", "conv_id")
    last = last.unionByName(convs.where("size = 0").select(F.lit(ROOT).alias("key"), "conv_id"))
    totals = rolled_up(nodes).select("key", F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    parents = nodes.where("n_children > 0").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.select("key", "depth", "conv_id", "n_convs", "parent", "n_children").join(totals, "key").join(ends(last), "key", "left").join(parents, "parent", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    tuned(spark)
    return trie(*rebuilt(table(spark, sf_dir, "conversations")))


ORACLE = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, unhex(sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')))) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS b, {CRC32.format('conv_id')} % 4 AS h, count(*) AS n FROM t GROUP BY conv_id),
p AS (SELECT c.conv_id AS conv_id, c.b AS b, c.h AS h, least(c.h, coalesce(o.n, 0)) AS taken, least(c.h, coalesce(o.n, 0)) + greatest(c.n - c.h, 0) AS len FROM c LEFT JOIN c o ON o.conv_id = c.b),
r AS (SELECT p.conv_id AS conv_id, i - h + taken AS i, role, text FROM t JOIN p USING (conv_id) WHERE i >= h
  UNION ALL SELECT p.conv_id, i, role, text FROM p JOIN t ON t.conv_id = p.b WHERE i < p.h),
x AS (SELECT conv_id, i + 1 AS depth, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
  sha256(string_agg(CAST(strlen(role) AS VARCHAR) || ':' || role || CAST(strlen(text) AS VARCHAR) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY i)) AS k FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM p),
n AS (SELECT k, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words FROM x GROUP BY k, depth),
up AS (SELECT n.k AS k, x.k AS a, x.depth AS ad FROM n JOIN x ON n.conv_id = x.conv_id AND x.depth <= n.depth),
par AS (SELECT n.k AS k, m.k AS pk, m.conv_id AS parent_conv_id FROM n JOIN up ON up.k = n.k AND up.ad = n.depth - 1 JOIN n m ON m.k = up.a),
ch AS (SELECT pk AS k, count(*) AS n_children FROM par GROUP BY pk),
s AS (SELECT a AS k, CAST(sum(CASE WHEN ch.k IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens FROM up JOIN n USING (k) LEFT JOIN ch USING (k) GROUP BY a),
e AS (SELECT k, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends FROM x JOIN p USING (conv_id) WHERE x.depth = p.len GROUP BY k)
SELECT n.conv_id AS conv_id, CAST(n.depth AS BIGINT) AS depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM n LEFT JOIN par USING (k) LEFT JOIN ch USING (k) JOIN s USING (k) LEFT JOIN e USING (k)
"""

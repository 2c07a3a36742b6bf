"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets decide.

Words are ``[^\\x20\\x09-\\x0D]+``; a document's set holds its runs of ``n``
words (of all its words if it has fewer).  Equal texts form one class, of which
the smallest id takes part.  The number of bands follows from the rows per band
and the recall wanted for a pair at the threshold.

Work inside a bucket is done in blocks of two chunks of documents, bounded by their number and
their bytes (documents are dealt to chunks by hash, so the bounds hold on average): the block's
task verifies all its pairs on the full sets and returns counts and a spanning
forest, never pairs, so a group of thousands of near copies costs rows in
proportion to its size.  A pair that meets in several buckets counts in the
first only.

Defined cases: texts without words (null and empty ones) have no set: no links,
class of their own.  Repeated rows count as one document and give repeated result
rows.  A null id gives class null and no links.  No documents give no rows.  Of equal texts, and of a
class, the smallest id stands for the others.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import column, groups, sized, stored, table, tuned, unused
from .components import components
from .words import Words, pieces, run_hashes, signed

N = 5
THRESHOLD = 0.8
ROWS = 5
RECALL = 0.9999
#: Documents in one chunk of a large bucket; a task holds two chunks.
CHUNK = 512
#: Bytes of text in one chunk, but for a text that is longer by itself.
CHUNK_BYTES = 32_000_000
#: Distinct n-grams counted at once in a block.
COLUMNS = 4096


def band_count(threshold: float, rows: int, recall: float) -> int:
    """Bands with which a pair at the threshold shares a band with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))) if threshold < 1 else 1


def ngrams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the n-grams of all texts; a short text's only gram is all its words."""
    at, h = words.runs(n)
    d = words.doc[at]
    short = np.flatnonzero((words.count > 0) & (words.count < n))
    if len(short):
        own = np.array([run_hashes(words.hash[words.first[i]:words.first[i + 1]], words.count[i])[0] for i in short], dtype=np.uint64)
        d, h = np.concatenate([d, short]), np.concatenate([h, own])
        order = np.argsort(d, kind="stable")
        d, h = d[order], h[order]
    return d, h


def _signatures(n: int, rows: int, bands: int):
    random = np.random.Generator(np.random.PCG64(11))
    factor = random.integers(0, 2**63, rows * bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = random.integers(0, 2**63, rows * bands, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, size=400_000):
                words = Words(texts)
                d, h = ngrams(words, n)
                sets: list = [None] * part.num_rows
                if len(h):
                    first = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
                    least = np.stack([np.minimum.reduceat(h * a + b, first) for a, b in zip(factor, shift)], axis=1)
                    keys = signed(run_hashes(np.ascontiguousarray(least).ravel(), rows)[::rows].reshape(len(first), bands))
                    for i, k in zip(d[first].tolist(), keys):
                        sets[i] = k
                yield pa.RecordBatch.from_arrays([column(part, "doc_id"), column(part, "digest"), column(part, "bytes"), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "digest", "bytes", "bands"])
    return run


def _verify(n: int, threshold: float):
    """Per bucket block: for each document, the linked copies and the smallest id of its part of the block's link graph."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, _, i, j), rows in groups(batches, "bucket", "band", "i", "j"):
            ids, at = np.unique(rows["doc_id"].to_numpy(), return_index=True)
            if len(ids) < 2:
                continue
            rows = rows.take(at)
            chunk, copies, band = rows["chunk"].to_numpy(), rows["copies"].to_numpy(), int(rows["band"][0].as_py())
            keys = np.array(rows["kept"].to_pylist(), dtype=np.int64)
            grams = []
            batch = rows.combine_chunks().to_batches()[0]
            for _, texts in pieces(batch):
                d, h = ngrams(Words(texts), n)
                grams += [np.unique(x) for x in np.split(h, np.searchsorted(d, np.arange(1, len(texts))))]
            linked = _links(grams, threshold)
            # a pair counts in the first band that both kept; a chunk meets itself in its own block
            for k in range(band):
                linked &= ~((keys[:, k][:, None] == keys[:, k][None, :]) & (keys[:, k] != 0)[:, None])
            linked &= (chunk[:, None] != chunk[None, :]) if i != j else True
            np.fill_diagonal(linked, False)
            if linked.any():
                yield pa.RecordBatch.from_pydict({"doc_id": ids, "links": linked @ copies, "root": ids[_roots(linked)]})
    return run


def _links(grams: list[np.ndarray], threshold: float) -> np.ndarray:
    """Whether |A & B| >= threshold * |A or B|, for all pairs of sets, from their full contents."""
    size = np.array([len(g) for g in grams], dtype=np.float64)
    owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    values, ids, count = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    common = np.flatnonzero(count > 1)
    place = np.full(len(values), -1)
    place[common] = np.arange(len(common))
    ids = place[ids]
    owner, ids = owner[ids >= 0], ids[ids >= 0]
    order = np.argsort(ids, kind="stable")
    owner, ids = owner[order], ids[order]
    both = np.zeros((len(grams), len(grams)), dtype=np.float64)
    for lo in range(0, len(common), COLUMNS):
        a, b = np.searchsorted(ids, [lo, lo + COLUMNS])
        m = np.zeros((len(grams), min(COLUMNS, len(common) - lo)), dtype=np.float32)
        m[owner[a:b], ids[a:b] - lo] = 1
        both += m @ m.T
    union = size[:, None] + size[None, :] - both
    return both >= threshold * union - 1e-9


def _roots(linked: np.ndarray) -> np.ndarray:
    """For each node, the smallest node of its connected part."""
    root = np.arange(len(linked))
    while True:
        near = np.where(linked, root[None, :], len(linked)).min(axis=1)
        new = np.minimum(root, near)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def jaccard_join(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, rows: int = ROWS, recall: float = RECALL, chunk: int = CHUNK, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: doc_id, class_id (smallest id among the documents that links
    join it to, its copies included), copy_of (smallest id of an equal text), n_copies
    (documents of equal text) and n_links (other documents with a similarity of
    ``threshold`` or more, copies included)."""
    tuned(docs.sparkSession)
    bands = band_count(threshold, rows, recall)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    schema = "doc_id long, digest binary, bytes long, bands array<long>"
    signed_docs = stored(source.withColumn("digest", F.unhex(F.md5("text"))).withColumn("bytes", F.octet_length("text").cast("long")).mapInArrow(_signatures(n, rows, bands), schema), "minhash")

    # classes of equal texts; only their smallest ids go on
    named = signed_docs.where("doc_id IS NOT NULL AND bands IS NOT NULL").select("doc_id", "digest", "bytes", "bands")
    unique = named.groupBy("doc_id", "digest").agg(F.first("bytes").alias("bytes"), F.first("bands").alias("bands"))
    classes = stored(unique.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("bytes").alias("bytes"), F.first("bands").alias("bands")), "classes")

    # buckets of two or more classes; of buckets with the same members one is enough
    placed = classes.select("rep", "bytes", F.posexplode("bands").alias("band", "bucket"))
    met = placed.groupBy("band", "bucket").agg(
        F.count(F.lit(1)).alias("size"), F.sum("bytes").alias("bytes"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("members"), F.min("rep").alias("least")).where("size > 1")
    kept = stored(met.groupBy("size", "bytes", "members", "least").agg(F.min(F.struct("band", "bucket")).alias("b")).select("b.band", "b.bucket", "size", F.col("bytes").alias("text_bytes")), "buckets")
    member = stored(placed.drop("bytes").join(sized(kept, 32), ["band", "bucket"]), "members")
    own = member.groupBy("rep").agg(F.map_from_entries(F.collect_list(F.struct("band", "bucket"))).alias("m")).select(
        "rep", F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda k: F.coalesce(F.try_element_at("m", k), F.lit(0).cast("long"))).alias("kept"))

    # a document goes to the blocks of its chunk with every chunk of the bucket
    chunks = F.ceil(F.greatest(F.col("size") / F.lit(chunk), F.col("text_bytes") / F.lit(chunk_bytes))).cast("int")
    blocks = member.withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))) \
        .select("rep", "band", "bucket", "chunk", F.least("chunk", "other").cast("int").alias("i"), F.greatest("chunk", "other").cast("int").alias("j"))
    needed = stored(own.join(classes.select("rep", "copies", "digest"), "rep"), "candidates")
    texts = source.withColumnRenamed("doc_id", "rep").withColumn("digest", F.unhex(F.md5("text"))).join(sized(needed, 200), ["rep", "digest"])
    block_rows = blocks.join(texts, "rep").select(F.col("rep").alias("doc_id"), "text", "copies", "kept", "bucket", "band", "i", "j", "chunk")
    verified = stored(block_rows.repartition("bucket", "band", "i", "j").sortWithinPartitions("bucket", "band", "i", "j")
                      .mapInArrow(_verify(n, threshold), "doc_id long, links long, root long"), "links")

    linked = verified.groupBy("doc_id").agg(F.sum("links").alias("links")).withColumnRenamed("doc_id", "rep")
    joined = components(verified.select(F.col("doc_id").alias("u"), F.col("root").alias("v")))
    by_class = classes.select("digest", "rep", "copies").join(linked, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    found = named.select("doc_id", "digest").join(by_class, "digest").select(
        "doc_id", F.coalesce("component", "rep").alias("class_id"), F.col("rep").alias("copy_of"), F.col("copies").alias("n_copies"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"))
    alone = signed_docs.where("doc_id IS NULL OR bands IS NULL").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_of"), F.lit(1).cast("long").alias("n_copies"), F.lit(0).cast("long").alias("n_links"))
    return found.unionByName(alone)


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents, one of each class of near duplicates: that with the smallest id.

    Documents without words or without an id have no duplicates and stay."""
    classes = stored(jaccard_join(docs, **options), "classes")
    name = unused(docs, "id_of_class")
    same = F.col("doc_id").cast("long") == F.col(name)
    gone = stored(classes.where("doc_id <> class_id").select(F.col("doc_id").alias(name)).distinct(), "gone")
    again = classes.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(name))
    # rows that repeat a document: they are few or none, and only they are compared as rows
    again = stored(again, "repeated")
    rest = docs.join(sized(gone, 16), same, "left_anti")
    if not again.head(1):
        return rest
    repeated = rest.join(sized(again, 16), same, "left_semi").dropDuplicates(["doc_id"])
    return rest.join(sized(again, 16), same, "left_anti").unionByName(repeated)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


#: All pairs by shared 5-word runs, compared on whole sets; components by recursion.
ORACLE = """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws, md5(coalesce(text, '')) AS digest FROM documents),
c AS (SELECT digest, min(doc_id) AS rep, count(*) AS copies FROM d WHERE len(ws) > 0 GROUP BY digest),
r AS (SELECT rep, copies, ws FROM c JOIN d ON d.doc_id = c.rep),
g AS (
  SELECT DISTINCT rep, array_to_string(ws[i:i + least(5, len(ws)) - 1], chr(1)) AS gram
  FROM (SELECT rep, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM r)),
s AS (SELECT rep, count(*) AS size FROM g GROUP BY rep),
p AS (SELECT a.rep AS a, b.rep AS b, count(*) AS shared FROM g a JOIN g b ON a.gram = b.gram AND a.rep <> b.rep GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN s x ON x.rep = a JOIN s y ON y.rep = b WHERE 5 * shared >= 4 * (x.size + y.size - shared)),
t AS (SELECT rep AS a, rep AS b FROM c UNION SELECT t.a, l.b FROM t JOIN l ON t.b = l.a),
k AS (SELECT a AS rep, min(b) AS class_id FROM t GROUP BY a),
n AS (SELECT a AS rep, sum(copies) AS links FROM l JOIN c ON c.rep = l.b GROUP BY a)
SELECT doc_id, coalesce(k.class_id, doc_id) AS class_id, coalesce(c.rep, doc_id) AS copy_of, CAST(coalesce(c.copies, 1) AS BIGINT) AS n_copies,
  CAST(coalesce(n.links, 0) + coalesce(c.copies, 1) - 1 AS BIGINT) AS n_links
FROM d LEFT JOIN c ON c.digest = d.digest AND len(d.ws) > 0 LEFT JOIN k ON k.rep = c.rep LEFT JOIN n ON n.rep = c.rep
"""

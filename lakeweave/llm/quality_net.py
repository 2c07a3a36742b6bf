"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, learned filters slide over every position, and their
activations are max-pooled and averaged over overlapping chunks that cover the whole
document.  A hidden layer looks at each chunk; its units are max-pooled over the
chunks and combined into one probability.  For scoring, embedding and filters are
folded into two tables of byte pairs, so a position costs two lookups.

The network is fitted on a bounded sample of whole labelled documents: of each label, in the order of a
hash of their id, ``SAMPLE`` at most, and as many as ``SAMPLE_BYTES`` have room for; one longer than an
eighth of that is passed over, so that no step needs much memory.  Scoring reads whole documents.

Defined cases: null and empty texts get the score of the labels' prior; labels that
are null are ignored, of repeated labels of a document the lowest counts; without
labels of both kinds every score is the share of good labels (0.5 without any); repeated
rows give repeated rows; of several texts of one doc_id the one with the smallest hash is learned from, ids of equal hash go by id; texts of any length
are scored as a whole; an empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import column, sized, stored, table, tuned
from .words import pieces, text_bytes

FILTERS, WIDTH, EMBEDDING, HIDDEN = 16, 4, 8, 12
#: Bytes of half a chunk: chunks are two neighbouring halves.
HALF = 64
SAMPLE = 700
SAMPLE_BYTES = 1_800_000
EPOCHS, BATCH, RATE = 7, 32, 0.008
THRESHOLD = 0.3
#: Padded half chunks worked on at once.
ROUND = 256


class Network:
    """Parameters, and the forward pass over the half chunks of documents."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        f = np.float32
        self.p = {
            "embed": r.normal(0, 0.5, (256, EMBEDDING)).astype(f),
            "conv": r.normal(0, (EMBEDDING * WIDTH) ** -0.5, (WIDTH, EMBEDDING, FILTERS)).astype(f), "conv_b": np.zeros(FILTERS, f),
            "hid": r.normal(0, 0.3, (2 * FILTERS + 1, HIDDEN)).astype(f), "hid_b": np.zeros(HIDDEN, f),
            "out": r.normal(0, 0.3, HIDDEN).astype(f), "out_b": np.zeros(1, f)}
        self.prior = 0.5
        self.fitted = False

    def fold(self) -> None:
        """Two tables of byte pairs that together are the filters."""
        part = [self.p["embed"] @ self.p["conv"][k] for k in range(WIDTH)]
        self.tables = [(part[k][:, None, :] + part[k + 1][None, :, :]).reshape(65536, FILTERS) for k in (0, 2)]
        self.tables[0] = self.tables[0] + self.p["conv_b"]

    def halves(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(max, sum of activations, positions) of each half chunk, and n + 1 offsets of the texts' halves."""
        size = np.diff(off)
        count = np.maximum(1, -(-size // HALF))
        first = np.concatenate([[0], np.cumsum(count)])
        total = int(first[-1])
        owner = np.repeat(np.arange(len(size)), count)
        begin = off[owner] + (np.arange(total) - first[owner]) * HALF
        # a position sees WIDTH bytes, zero behind the text's end
        most, sums, number = np.zeros((total, FILTERS), np.float32), np.zeros((total, FILTERS), np.float32), np.clip(off[owner + 1] - begin, 0, HALF)
        padded = np.concatenate([raw, np.zeros(HALF + WIDTH, np.uint8)])
        reach = np.arange(HALF + WIDTH - 1)
        for lo in range(0, total, ROUND):
            hi = min(total, lo + ROUND)
            at = begin[lo:hi, None] + reach
            data = np.where(at < off[owner[lo:hi] + 1][:, None], padded[at], 0).astype(np.int64)
            pair = data[:, :-1] << 8 | data[:, 1:]
            a = self.tables[0][pair[:, :HALF]]
            a += self.tables[1][pair[:, 2:2 + HALF]]
            np.maximum(a, 0, out=a)
            inside = reach[:HALF] < number[lo:hi, None]
            if not inside.all():
                a *= inside[:, :, None]
            most[lo:hi] = a.max(axis=1)
            sums[lo:hi] = a.sum(axis=1)
        return most, sums, number, first

    def chunks(self, most, sums, number, first):
        """Features of the overlapping chunks and n + 1 offsets of the texts' chunks."""
        count = np.diff(first)
        last = first[1:] - 1
        single = count == 1
        # chunk i joins halves i and i + 1; a text of one half is one chunk
        keep = np.ones(len(most), dtype=bool)
        keep[last[~single]] = False
        i = np.flatnonzero(keep)
        j = np.where(np.isin(i, last[single]), i, i + 1) if single.any() else i + 1
        n = number[i] + np.where(j > i, number[j], 0)
        mean = (sums[i] + np.where((j > i)[:, None], sums[j], 0)) / np.maximum(n, 1)[:, None]
        feats = np.concatenate([np.maximum(most[i], most[j]), 4 * mean, (n / (2 * HALF))[:, None]], axis=1).astype(np.float32)
        return feats, np.concatenate([[0], np.cumsum(np.maximum(1, count - 1))]), i, j, n

    def scores(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        if not self.fitted or len(off) < 2:
            return np.full(len(off) - 1, self.prior)
        feats, first, *_ = self.chunks(*self.halves(raw, off))
        h = np.maximum(feats @ self.p["hid"] + self.p["hid_b"], 0)
        pooled = np.maximum.reduceat(h, first[:-1], axis=0)
        z = (pooled @ self.p["out"] + self.p["out_b"]).astype(np.float64)
        score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return np.where(np.diff(off) > 0, score, self.prior)

    def gradients(self, raw: np.ndarray, off: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict]:
        """Weighted log loss of the documents and its gradients."""
        p, n = self.p, len(raw)
        padded = np.concatenate([raw, np.zeros(WIDTH, np.uint8)]).astype(np.int64)
        doc = np.repeat(np.arange(len(y)), np.diff(off))
        end = off[1:][doc]
        ids = np.stack([np.where(np.arange(n) + k < end, padded[k:k + n], 0) for k in range(WIDTH)], axis=1)
        x = p["embed"][ids].reshape(n, WIDTH * EMBEDDING)
        w = p["conv"].reshape(WIDTH * EMBEDDING, FILTERS)
        a = x @ w + p["conv_b"]
        act = np.maximum(a, 0)
        size = np.diff(off)
        count = np.maximum(1, -(-size // HALF))
        first = np.concatenate([[0], np.cumsum(count)])
        owner = np.repeat(np.arange(len(y)), count)
        begin = off[owner] + (np.arange(first[-1]) - first[owner]) * HALF
        number = np.minimum(off[owner + 1] - begin, HALF)
        most, sums = np.maximum.reduceat(act, begin, axis=0), np.add.reduceat(act, begin, axis=0)
        feats, cfirst, i, j, cn = self.chunks(most, sums, number, first)
        hz = feats @ p["hid"] + p["hid_b"]
        h = np.maximum(hz, 0)
        pooled = np.maximum.reduceat(h, cfirst[:-1], axis=0)
        z = pooled @ p["out"] + p["out_b"]
        q = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        loss = -float((weight * (y * np.log(q + 1e-9) + (1 - y) * np.log(1 - q + 1e-9))).sum() / weight.sum())
        dz = (weight * (q - y) / weight.sum()).astype(np.float32)
        g = {"out": pooled.T @ dz, "out_b": dz.sum(keepdims=True)}
        cowner = np.repeat(np.arange(len(y)), np.diff(cfirst))
        # the first chunk that reaches the maximum takes the gradient
        top = (h == pooled[cowner]) & (h > 0)
        dh = np.zeros_like(h)
        for u in range(HIDDEN):
            at = np.flatnonzero(top[:, u])
            at = at[np.unique(cowner[at], return_index=True)[1]]
            dh[at, u] = dz[cowner[at]] * p["out"][u]
        g["hid"], g["hid_b"] = feats.T @ dh, dh.sum(axis=0)
        df = dh @ p["hid"].T
        dmost, dsums = np.zeros_like(most), np.zeros_like(sums)
        high = most[i] >= most[j]
        dm, ds = df[:, :FILTERS], 4 * df[:, FILTERS:2 * FILTERS] / np.maximum(cn, 1)[:, None]
        np.add.at(dmost, i, dm * high)
        np.add.at(dmost, j, dm * ~high)
        np.add.at(dsums, i, ds)
        two = j > i
        np.add.at(dsums, j[two], ds[two])
        half = np.repeat(np.arange(len(begin)), number)
        da = dsums[half]
        for f in range(FILTERS):
            at = np.flatnonzero(act[:, f] == most[half, f])
            at = at[np.unique(half[at], return_index=True)[1]]
            da[at, f] += dmost[half[at], f]
        da *= a > 0
        g["conv"], g["conv_b"] = (x.T @ da).reshape(WIDTH, EMBEDDING, FILTERS), da.sum(axis=0)
        dx = (da @ w.T).reshape(n * WIDTH, EMBEDDING)
        flat = ids.reshape(-1)
        g["embed"] = np.stack([np.bincount(flat, weights=dx[:, e], minlength=256) for e in range(EMBEDDING)], axis=1).astype(np.float32)
        return loss, g

    def fit(self, texts: list[bytes], labels: np.ndarray, prior: float, epochs: int = EPOCHS, seed: int = 9) -> list[float]:
        """Adam on the sample, both labels weighing the same."""
        self.prior = prior
        labels = np.asarray(labels, dtype=np.float32)
        keep = [i for i, t in enumerate(texts) if t]
        if len(set(labels[keep].tolist())) < 2:
            return []
        r = np.random.default_rng(seed)
        share = labels[keep].mean()
        weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        losses, step = [], 0
        for epoch in range(epochs):
            order = r.permutation(keep)
            rate = RATE * (1 - epoch / epochs) + 1e-4
            for lo in range(0, len(order), BATCH):
                chosen = order[lo:lo + BATCH]
                off = np.concatenate([[0], np.cumsum([len(texts[i]) for i in chosen])])
                raw = np.frombuffer(b"".join(texts[i] for i in chosen), np.uint8)
                loss, g = self.gradients(raw, off, labels[chosen], weight[chosen])
                losses.append(loss)
                step += 1
                for k, x in g.items():
                    m[k] = 0.9 * m[k] + 0.1 * x
                    v[k] = 0.99 * v[k] + 0.01 * x * x
                    self.p[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
        self.fitted = True
        self.fold()
        return losses


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Network:
    """The network fitted on the sample; ``docs`` gives doc_id and text, ``labels`` doc_id and quality."""
    tuned(docs.sparkSession)
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") > 0).cast("int").alias("quality"))
    marks = stored(marks.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality")), "marks")
    count = {r["quality"]: r["n"] for r in marks.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    network = Network()
    total = sum(count.values())
    if len(count) < 2:
        network.prior = (count.get(1, 0) / total) if total else 0.5
        return network
    place = F.struct(F.xxhash64("doc_id"), F.col("doc_id"))
    picked = [marks.where(F.col("quality") == q).orderBy(place).limit(sample) for q in (0, 1)]
    picked = stored(picked[0].unionByName(picked[1]), "sample")  # two times ``sample`` rows at most
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(sized(picked, 16), "doc_id")
    short = texts.where(F.octet_length("text") <= sample_bytes // 8).groupBy("quality", "doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))
    upto = F.sum(F.octet_length("text")).over(Window.partitionBy("quality").orderBy(place).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = stored(short, "texts").withColumn("upto", upto).where(F.col("upto") <= sample_bytes).select("quality", "doc_id", F.col("text").cast("binary").alias("data")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    if len({r["quality"] for r in rows}) == 2:
        network.fit([bytes(r["data"]) for r in rows], np.array([r["quality"] for r in rows]), count[1] / total)
    return network


def _score(network: Network, threshold: float, only_good: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch):
                score = network.scores(*text_bytes(texts))
                if only_good:
                    yield part.filter(pa.array(score >= threshold))
                else:
                    yield pa.RecordBatch.from_arrays([
                        column(part, "doc_id"), column(part, "held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])
    return run


def scored(docs: DataFrame, network: Network, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score and predicted."""
    tuned(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(_score(network, threshold, False), "doc_id long, held_out boolean, score double, predicted int")


def good_documents(docs: DataFrame, network: Network, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the network doesn't reject, unchanged."""
    tuned(docs.sparkSession)
    return docs.mapInArrow(_score(network, threshold, True), docs.schema)


def op1_quality_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, fit(docs, table(spark, sf_dir, "labels")))

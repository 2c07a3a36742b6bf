"""The quality network's sample, the archives' references and the tokenizer's guard against blocks that differ."""

import base64
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeweave.llm import bpe, quality_net, warc
from lakeweave.llm.base import shared_path


def test_the_sample_has_whole_texts_within_its_bounds(spark, monkeypatch):
    r = random.Random(4)
    rows = [(i, " ".join(r.choice("abc def ghij klm".split()) for _ in range(r.randint(1, 400)))) for i in range(300)] + [(5, "other text of five"), (300, "x" * 100_000), (301, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(302)], "doc_id long, quality int")
    taken = {}
    monkeypatch.setattr(quality_net.Network, "fit", lambda self, texts, labels, prior, **k: taken.update(texts=texts, labels=labels, prior=prior))
    quality_net.fit(docs, labels, sample=60, sample_bytes=40_000)
    texts = {t for _, t in rows if t}
    assert all(t.decode() in texts or not t for t in taken["texts"])          # whole texts only
    for q in (0, 1):
        mine = [t for t, y in zip(taken["texts"], taken["labels"]) if y == q]
        assert 10 < len(mine) <= 60 and sum(map(len, mine)) <= 40_000 and max(map(len, mine)) <= 5_000
    again = dict(taken)
    quality_net.fit(docs.repartition(7), labels, sample=60, sample_bytes=40_000)
    assert taken["texts"] == again["texts"]


def test_scores_are_those_of_the_plain_forward_pass():
    net = quality_net.Network(3)
    net.fitted = True
    net.fold()
    r = random.Random(1)
    texts = [bytes(r.randrange(256) for _ in range(n)) for n in (1, 3, 63, 64, 65, 127, 128, 129, 300, 1000)]
    p = net.p

    def plain(t):
        data = list(t) + [0] * quality_net.WIDTH
        act = []
        for i in range(len(t)):
            window = np.concatenate([p["embed"][b if i + k < len(t) else 0] for k, b in enumerate(data[i:i + quality_net.WIDTH])])
            act.append(np.maximum(window @ p["conv"].reshape(-1, quality_net.FILTERS) + p["conv_b"], 0))
        act, half = np.array(act), quality_net.HALF
        halves = [act[i:i + half] for i in range(0, len(act), half)]
        chunks = [np.concatenate(halves[i:i + 2]) for i in range(max(1, len(halves) - 1))]
        hidden = [np.maximum(np.concatenate([c.max(axis=0), 4 * c.mean(axis=0), [len(c) / (2 * half)]]) @ p["hid"] + p["hid_b"], 0) for c in chunks]
        z = float(np.max(hidden, axis=0) @ p["out"] + p["out_b"][0])
        return 1 / (1 + np.exp(-z))

    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = net.scores(np.frombuffer(b"".join(texts), np.uint8), off)
    np.testing.assert_allclose(got, [plain(t) for t in texts], rtol=1e-4)


def test_revisits_refer_to_records_that_are_there(spark):
    same, other = "<p>" + "same " * 400, "<p>" + "other " * 300
    rows = [(i, f"http://h/{i}" if i % 3 else None, same if i % 2 else other) for i in range(20)] + [(19, "http://again/", same), (None, "u", same), (7, "http://h/7", same), (30, "s", "short"), (31, "s", "short")]
    pages = spark.createDataFrame([(*x, 1, "d") for x in rows], "page_id long, url string, html string, target long, digest string").repartition(3)
    index = warc.write_archives(pages, shared_path(spark, "warc-test"))
    names = {r["record_id"] for r in index.collect()}
    fetched = warc.fetch(index, pages.where("page_id is not null").select("page_id")).collect()
    heads = [h for r in fetched for h, _, _ in warc.parse(bytes(r["data"]))]
    revisits = [h for h in heads if h["warc-type"] == "revisit"]
    responses = {h["warc-record-id"]: h["warc-payload-digest"] for h in heads if h["warc-type"] == "response"}
    assert revisits and all(h["warc-refers-to"] in names and responses[h["warc-refers-to"]] == h["warc-payload-digest"] for h in revisits)
    assert all(len(base64.b32decode(h["warc-payload-digest"].partition(":")[2])) == 20 for h in heads)
    assert warc.read_archives(index).where(F.col("record_type") == "revisit").agg(F.countDistinct("refers_to")).first()[0] == 2


def test_blocks_that_differ_between_the_passes_are_an_error():
    import public_tokenizers

    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as f:
        content = f.read()
    vocabulary = bpe._vocabulary(content, public_tokenizers.PATTERN)
    batches = lambda text: iter([pa.RecordBatch.from_pydict({"doc_id": pa.array([1], pa.int64()), "text": [text]})])

    class Context:
        @staticmethod
        def get():
            return Context()

        def partitionId(self):  # noqa: N802
            return 0

    real, bpe.TaskContext = bpe.TaskContext, Context
    try:
        places = list(bpe._places(content, public_tokenizers.PATTERN, 1 << 20, 4)(batches("one two three")))

        def answers(text):
            rows = [x for b in bpe._words(content, public_tokenizers.PATTERN, 1 << 20, 4)(batches(text)) for x in b.to_pylist()]
            schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("check", pa.int64()), ("lengths", pa.binary()), ("words", pa.binary())])
            return list(bpe._merge(content, public_tokenizers.PATTERN)(iter([pa.RecordBatch.from_pylist(sorted(rows, key=lambda x: x["bucket"]), schema=schema)])))

        def assembled(text):
            rows = sorted((x for b in [*places, *answers(text)] for x in b.to_pylist()), key=lambda x: (x["kind"], x["seq"]))
            return list(bpe._assemble(content, public_tokenizers.PATTERN, bpe._digest)(iter([pa.RecordBatch.from_pylist(rows, schema=places[0].schema)])))

        assert assembled("one two three")[0]["n_tokens"][0].as_py() == 3
        with pytest.raises(RuntimeError, match="different blocks"):
            assembled("one two seven")                     # as many words, other words
    finally:
        bpe.TaskContext = real
    assert vocabulary is not None

"""The pipeline against a plain chain of its stages, and stages under hostile column names and tight bounds."""

import hashlib
import random
import re
import struct

import pytest
from pyspark.sql import functions as F

from lakeweave.llm import decontaminate, ngram_join, pii, quality_net

SF = "/root/testdata/sf0.001"


def alnum_spans(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]


def hit_words(text, windows):
    words = [w for w, _, _ in alnum_spans(text)]
    hit = set()
    for size in {len(w) for w in windows}:
        for k in range(len(words) - size + 1):
            if tuple(words[k:k + size]) in windows:
                hit |= set(range(k, k + size))
    return hit


def without_hits(text, windows, most=0.5):
    """The text without its hit stretches, or None when it goes as a whole."""
    spans, hit = alnum_spans(text), hit_words(text, windows)
    if len(hit) > most * len(spans):
        return None
    out, at = [], 0
    for k in sorted(hit):
        if k - 1 not in hit:
            out.append(text[at:spans[k][1]])
        at = spans[k][2]
    return "".join([*out, text[at:]])


def windows_of(items):
    out = set()
    for text in items:
        words = [w for w, _, _ in alnum_spans(text or "")]
        out |= {tuple(words[k:k + 10]) for k in range(max(1, len(words) - 9) if words else 0)}
    return out


def first_of_classes(texts):
    """Ids that stay of {id: text}: the smallest of each class joined by 5-word similarity of 0.8 or more."""
    grams = {}
    for i, text in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        grams[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    left, kept = set(texts), set()
    while left:
        first = min(left)
        kept.add(first)
        todo, left = [first], left - {first}
        while todo:
            a = grams[todo.pop()]
            near = {j for j in left if a and grams[j] and len(a & grams[j]) >= 0.8 * len(a | grams[j])}
            left -= near
            todo += near
    return kept


def test_pipeline_equals_a_plain_chain(spark, tmp_path):
    import public_tokenizers
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    import corpus_pipeline

    r = random.Random(2)
    rows = [x.asDict() for x in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(150).collect()]
    bench = [x["text"] for x in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    good = sorted((x for x in rows if x["text"]), key=lambda x: -len(x["text"]))[:20]
    def more(text): rows.append({**rows[0], "doc_id": 10**6 + len(rows), "text": text, "n_chars": None if text is None else len(text)})
    for x in good[:5]:
        words = x["text"].split(" ")
        more(x["text"])
        more(" ".join(words[:3] + ["inserted"] + words[3:]))
    for k, x in enumerate(good[5:12]):
        at = x["text"].index(" ", r.randrange(len(x["text"]) // 2))
        more(f"{x['text'][:at]} {bench[k]} {x['text'][at:]}")
        more(f"{x['text'][:at]} mail ann.{k}@host{k}.example.org or +44 20 7946 0{k}18, host 10.1.{k}.2 {x['text'][at:]}")
    more(None)
    more("")
    sf = str(tmp_path)
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    spark.createDataFrame([tuple(x[c] for c in schema.names) for x in rows], schema).write.parquet(f"{sf}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{sf}/{name}.parquet")
    got = {x["doc_id"]: (x["n_tokens"], x["ids_sha256"], x["decoded_sha256"]) for x in corpus_pipeline.run(spark, sf).collect()}

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    network = quality_net.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    good_ids = {x["doc_id"] for x in quality_net.scored(docs, network).where("score >= 0.3").collect()}
    texts = {x["doc_id"]: x["text"] for x in rows if x["doc_id"] in good_ids}
    first = first_of_classes(texts)
    windows = windows_of(bench)
    cut = {i: None if texts[i] is None else without_hits(texts[i], windows) for i in first}
    cut = {i: t for i, t in cut.items() if t is not None or texts[i] is None}
    assert len(first) < len(texts) < len(rows) and any(cut[i] != texts[i] for i in cut)
    frame = spark.createDataFrame([(i, t) for i, t in cut.items()], "doc_id long, text string")
    spans = {x["doc_id"]: x["spans"] for x in pii.personal_data(frame, pii.fit(frame)).collect()}
    ranks = load_tiktoken_bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want, masked = {}, 0
    for i, text in cut.items():
        text, out, at = text or "", [], 0
        for kind, a, b in (x.split(":") for x in (spans[i].split(",") if spans[i] else [])):
            a, b = int(a), int(b)
            if b > at:
                out += [text[at:a], f"[{kind}]"] if a >= at else []
                at = b
        new = "".join([*out, text[at:]])
        masked += new != text
        ids = plain.encode_ordinary(new)
        want[i] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(new.encode()).hexdigest())
    assert masked >= 5
    assert got == want


CLASHING = ["hit_bits", "HIT_ITEMS", "id_of_class", "id_of_class_", "row", "digest", "bytes", "bands", "copies", "links", "batch", "n"]


@pytest.fixture(scope="module")
def hostile(spark):
    r = random.Random(8)
    lexicon = [f"w{i}" for i in range(300)]
    texts = [" ".join(r.choice(lexicon) for _ in range(80)) for _ in range(12)]
    texts += [texts[0], texts[1] + " more", texts[2] + " " + texts[3], None, "", " \n ", "x" * 200_000, " ".join(r.choice(lexicon) for _ in range(60_000))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return texts, df.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASHING}).repartition(3)


def test_blocks_of_items_over_several_stages(spark, hostile, monkeypatch):
    texts, docs = hostile
    items = [(f"i{k}", " ".join(t.split()[5:5 + n])) for k, (t, n) in enumerate(zip(texts[:12], (10, 11, 9, 30, 3, 50, 10, 12, 14, 10, 10, 20)))] + [(None, "w1 w2"), ("i0", texts[4])]
    bench = spark.createDataFrame(items, "item_id string, text string")
    windows = windows_of(t for _, t in items)
    cut = {i: None if t is None else without_hits(t, windows) for i, t in enumerate(texts)}
    want = {i: t for i, t in cut.items() if t is not None or texts[i] is None}
    whole = sorted(map(tuple, decontaminate.contamination(docs, bench).collect()))
    for blocks in (1, 2, 8):
        monkeypatch.setattr(decontaminate, "STAGE_BLOCKS", blocks)
        assert sorted(map(tuple, decontaminate.contamination(docs, bench, block_bytes=150).collect())) == whole
        left = decontaminate.remove_spans(docs, bench, block_bytes=150)
        assert left.schema == docs.schema
        rows = left.collect()
        assert {x["doc_id"]: x["text"] for x in rows} == want and len(rows) == len(want)
        assert all(x[c] == f"{c}{x['doc_id']}" for x in rows for c in CLASHING)


def test_near_duplicates_in_chunks_of_few_bytes(hostile):
    texts, docs = hostile
    want = first_of_classes(dict(enumerate(texts)))
    for bounds in ({}, {"chunk_bytes": 300}, {"chunk_bytes": 1}):
        left = ngram_join.one_of_each(docs, **bounds)
        assert left.schema == docs.schema
        rows = left.collect()
        assert {x["doc_id"] for x in rows} == want and len(rows) == len(want)
        assert all(x[c] == f"{c}{x['doc_id']}" for x in rows for c in CLASHING)
    again = {x["doc_id"] for x in ngram_join.one_of_each(docs.union(docs)).collect()}
    assert again == want

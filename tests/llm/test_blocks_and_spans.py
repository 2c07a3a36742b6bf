"""License blocks against all stretches; personal data in long texts, whole numbers, the best path against all paths."""

import itertools
import math
import random
import re
import time

import pyarrow as pa
import pytest

from lakeweave.llm import licenses, pii


def alnum(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def every_stretch(text):
    """(labels of templates, best share) over all stretches of at most the template's words / containment."""
    w, labels, best = alnum(text), set(), 0.0
    for label, template in licenses.TEMPLATES:
        words = alnum(template)
        tokens, length = set(words), math.ceil(len(words) / licenses.CONTAINMENT - 1e-9)
        held = max((len(set(w[k:k + length]) & tokens) for k in range(len(w))), default=0)
        if held >= licenses.CONTAINMENT * len(tokens) - 1e-9:
            labels.add(label)
            best = max(best, held / len(tokens))
    return labels, best


def test_blocks_are_all_stretches_and_no_others(spark):
    r = random.Random(6)
    texts = ["all " + "word " * 400 + "rights " + "word " * 400 + "reserved", "mit " * 3 + "x " * 50 + "under the " + "y " * 50 + "license released"]
    for _ in range(120):
        label, template = r.choice(licenses.TEMPLATES)
        w = template.split()
        for _ in range(r.randint(0, 4)):  # noise in and around: some stay over the threshold, some fall under it
            kind, k = r.randrange(3), r.randrange(len(w))
            w = w[:k] + ["noise"] + w[k:] if kind == 0 else w[:k] + w[k + 1:] if kind == 1 and len(w) > 1 else [*w[:k], r.choice(w), *w[k + 1:]]
        texts.append("before " * r.randint(0, 60) + r.choice([" ", "\n", " * "]).join(w) + " after" * r.randint(0, 60) + (" " + r.choice(licenses.TEMPLATES)[1] if r.random() < 0.2 else ""))
    docs = spark.createDataFrame([(i, t, 1, "b") for i, t in enumerate(texts)], "doc_id long, text string, place int, block string").repartition(4)
    for row in licenses.license_scan(docs).collect():
        labels, best = every_stretch(texts[row["doc_id"]])
        base = set(filter(None, row["base_labels"].split(",")))
        assert set(filter(None, row["labels"].split(","))) == labels | base, texts[row["doc_id"]]
        assert abs(row["score"] - max(best, 1.0 if base else 0.0)) < 1e-9
    got = {r["doc_id"]: r["labels"] for r in licenses.license_scan(docs.where("doc_id < 2")).collect()}
    assert got == {0: "", 1: ""}


def test_one_line_without_end_is_scanned_in_proportion(spark):
    filler = "the above copyright shall be free of charge to any person all rights "
    text = filler * 30_000 + "All rights reserved"
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string")
    t = time.time()
    row = licenses.license_scan(rows).first()
    assert row["labels"] == "all-rights-reserved" and row["n_words"] == 13 * 30_000 + 3 and time.time() - t < 60


def lines_of(n, r):
    return "\n".join(f"2024-05-{i % 28 + 1:02d} host 10.{i % 250}.3.{i % 200} user{i}@mail.example.org called +1 (244) 555-{i % 10000:04d} id {r.randrange(10**9)}" for i in range(n))


@pytest.fixture(scope="module")
def tagger(spark):
    r = random.Random(4)
    say = lambda: " ".join(r.choice("the of and call me at home today write".split()) for _ in range(r.randint(3, 12)))
    phone = lambda: f"+{r.randint(1, 99)} ({r.randint(100, 999)}) {r.randint(100, 999)}-{r.randint(1000, 9999)}"
    rows = [(i, f"{say()} {r.choice([phone(), f'a{i}.b@m{i % 7}.example.com', f'10.{i % 200}.7.{i % 90}'])} {say()}") for i in range(400)]
    return pii.fit(spark.createDataFrame(rows, "doc_id long, text string"), sample=300, plain=100)


def test_a_long_log_takes_time_in_proportion(tagger):
    def spent(n):
        text = lines_of(n, random.Random(1))
        t = time.process_time()
        base = sorted(pii.base_spans(text))
        starts = pii._windows(text)
        marked = [(s - s % 5 + 3, s - s % 5 + 9, 3) for s in starts]
        pii.reconciled(text, base, starts, [[(a - s, b - s, k)] for s, (a, b, k) in zip(starts, marked)])
        list(pii._examples(iter([pa.RecordBatch.from_pydict({"doc_id": [1], "text": [text]})])))
        return time.process_time() - t, len(text)

    spent(50)
    (small, a), (large, b) = spent(400), spent(4000)
    assert large < 3 * small * b / a + 0.5


@pytest.mark.parametrize("text, part, kind, whole", [
    ("tel 0049 30 1234567 now", "1234567", 3, "0049 30 1234567"),
    ("tel 0049 30 1234567", "49 30 12345", 3, "0049 30 1234567"),
    ("call (030) 123-4567, room 5", "123-456", 3, "(030) 123-4567"),
    ("+49 (30) 1234567", "1234567", 3, "+49 (30) 1234567"),
    ("id 1234 5678 9012 3456 end", "5678 9012 34", 2, "1234 5678 9012 3456"),
    ("write to anna.b@mail.example.org.", "b@mail.exam", 0, "anna.b@mail.example.org"),
    ("at 192.168.10.255 up", "168.10.25", 1, "192.168.10.255"),
    ("1234567", "34", 3, "1234567"),
])
def test_spans_are_whole_numbers_and_addresses(text, part, kind, whole):
    a = text.index(part)
    a, b = pii.whole_token(text, a, a + len(part), kind)
    assert text[a:b] == whole


def test_no_span_touches_a_digit(spark, tagger):
    r = random.Random(9)
    texts = [f"ring 00{r.randint(10, 99)} {r.randint(10, 99)} {r.randint(10**6, 10**7)} or {r.randint(100, 999)} {r.randint(10**6, 10**7)} ok {i}" for i in range(60)]
    for row in pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), tagger).collect():
        t = texts[row["doc_id"]]
        for span in filter(None, row["spans"].split(",")):
            _, a, b = span.split(":")
            a, b = int(a), int(b)
            assert not (a and t[a - 1].isdigit() and t[a].isdigit()) and not (b < len(t) and t[b].isdigit() and t[b - 1].isdigit()), (t, span)


def test_best_path_is_the_best_of_all_paths(tagger):
    texts = ["7 a", "a@b", "+1 2", "12.3"]
    trans = tagger.p["trans"] + pii._allowed()
    ids, mask = pii.character_ids(texts)
    e = tagger.emissions(ids, mask)[0]
    for k, (text, got) in enumerate(zip(texts, tagger.decode(texts))):
        paths = itertools.product(range(pii.TAGS), repeat=len(text))
        score = lambda p: sum(e[t, k, x] for t, x in enumerate(p)) + sum(trans[x, y] for x, y in zip(p, p[1:]))  # noqa: E731, B023
        best = max(paths, key=score)
        assert pii.spans_of(list(best)) == got


def test_tags_of_windows_are_those_of_all_spans():
    text = lines_of(30, random.Random(2))
    base = pii.base_spans(text)
    rows = pa.Table.from_batches(pii._examples(iter([pa.RecordBatch.from_pydict({"doc_id": [1], "text": [text]})]))).to_pylist()
    for x in rows:
        assert x["tags"] == pii.tags_of(base, x["start"], min(x["start"] + pii.WINDOW, len(text)))
    assert len(rows) > 10

"""Every operator against a plain single-machine version, on texts with all the odd cases."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeweave.llm import bpe, components, decontaminate, licenses, ngram_join, perplexity, pii, quality_net, style_tree, substrings, warc
from lakeweave.llm.base import shared_path

# columns whose names clash with those that operators use inside
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, digest string, key long, bands string, low string, `row` int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.fixture(scope="module")
def texts():
    r = random.Random(7)
    voc = [f"{a}{b}" for a in "bdkltéñ" for b in ("a", "on", "ist", "ure", "IX")] + ["the", "of", "and", "日本"]
    prose = lambda n: " ".join(r.choice(voc) for _ in range(n))
    base = prose(120)
    edited = base.split()
    edited[60] = "other"
    out = [base, base, base + " tail", " ".join(edited), prose(400) + "\n" + base + "\n" + prose(30), prose(3), "", "   \n\t ", None, prose(49), prose(50), "of " * 200, "x",
           "Of of\nOf of\n\nlast line\r\nlast line", "write to anna.b@mail.example.org or +1 (244) 555-4688, card 4111 1111 1111 1111, host 10.0.0.255.",
           "Licensed under the Apache License, Version 2.0.\nMIT   License mit license and the GNU general PUBLIC license", "a" * 5000 + " " + "b1" * 3000, "'s don't we'll x 're　  \U0001f600 1²³  ", prose(2500), "don't" * 50, "same\nother\nsame\n", ""]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, [None, "en", "de"][i % 3], "s", len(t) if t is not None else None, 0.5, "d", 1, "b", "l", 7) for i, t in enumerate(texts)]
    rows += [rows[0], rows[4], (None, texts[0], "en", None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r.asDict())
    return out


def test_decontamination(spark, docs, empty, texts):
    items = [(1, " ".join(texts[0].split()[20:45])), (2, "of of"), (10, texts[0].upper()), (3, ""), (4, None), (5, "日本 x"), (2, "of of")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = by_id(decontaminate.contamination(docs, bench))
    windows = {}
    for name, t in items:
        w = alnum(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k:k + 10]), set()).add(str(name))
    for i, t in [*enumerate(texts), (None, texts[0])]:
        w, hit, names = alnum(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in windows:
                    hit |= set(range(k, k + size))
                    names |= windows[tuple(w[k:k + size])]
        want = {"doc_id": i, "n_words": len(w), "n_hit": len(hit), "n_items": len(names), "items_sha256": sha(",".join(sorted(names))), "contaminated": bool(hit)}
        assert all(r == want for r in got[i]) and len(got[i]) == (2 if i in (0, 4) else 1)
    small = by_id(decontaminate.contamination(docs, bench, block_bytes=300))  # several automata
    assert small == got
    assert decontaminate.contamination(empty, bench).count() == 0
    assert {r["contaminated"] for r in decontaminate.contamination(docs, bench.limit(0)).collect()} == {False}


def test_decontamination_removes_spans_and_leaves_the_rest(spark, docs, texts):
    bench = spark.createDataFrame([(1, " ".join(texts[0].split()[20:45]))], "item_id long, text string")
    left = decontaminate.remove_spans(docs, bench)
    assert left.columns == docs.columns
    kept = by_id(left)
    assert not any(r["contaminated"] for r in decontaminate.contamination(left, bench).collect())
    assert kept[18][0]["text"] == texts[18] and kept[8][0]["text"] is None
    assert kept[0][0]["n_chars"] == len(kept[0][0]["text"]) < len(texts[0])
    assert 0 not in by_id(decontaminate.remove_spans(docs, bench, max_coverage=0.1))


def grams(text, n=5):
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def test_ngram_join(docs, empty, texts):
    got = by_id(ngram_join.jaccard_join(docs, chunk=2))
    sets = [grams(t) for t in texts]
    near = {i: {j for j, b in enumerate(sets) if j != i and a and b and len(a & b) >= 0.8 * len(a | b)} for i, a in enumerate(sets)}
    for i, t in enumerate(texts):
        reach, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - reach
            reach |= new
            todo += new
        for r in got[i]:
            assert (r["class_id"], r["n_links"]) == (min(reach), len(near[i])), i
    assert got[None][0]["class_id"] is None and got[None][0]["n_links"] == 0
    assert len(got[0]) == 2
    assert ngram_join.jaccard_join(empty).count() == 0
    kept = by_id(ngram_join.one_of_each(docs))
    assert set(kept) == {min(k for k in range(len(texts)) if got[k][0]["class_id"] == got[i][0]["class_id"]) for i in range(len(texts))} | {None}
    assert all(len(v) == 1 for v in kept.values())


def test_links_within_a_large_group_are_complete(spark):
    r = random.Random(1)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(300):
        t = list(base)
        for _ in range(r.randrange(4)):
            t[r.randrange(150)] = f"e{r.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_id(ngram_join.jaccard_join(df, chunk=64))
    sets = [grams(t) for _, t in rows]
    links = [sum(len(a & b) >= 0.8 * len(a | b) for b in sets) - 1 for a in sets]
    found = [got[i][0]["n_links"] for i in range(300)]
    assert sum(links) * 0.9995 <= sum(found) <= sum(links) and all(f <= x for f, x in zip(found, links))


def test_components(spark):
    edges = [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (7, 7), (20, 10), (20, 11), (20, 12), (12, 13)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8, 10: 10, 11: 10, 12: 10, 13: 10, 20: 10}


def test_substrings(docs, empty, texts):
    got = by_id(substrings.repeated_spans(docs))
    first = {}
    for i, t in enumerate(texts):
        w = words(t)
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k:k + 50]), i)
    for i, t in enumerate(texts):
        w, gone = words(t), set()
        for k in range(len(w) - 49):
            if first[tuple(w[k:k + 50])] < i:
                gone |= set(range(k, k + 50))
        want = {"doc_id": i, "n_words": len(w), "n_removed": len(gone), "kept_sha256": sha(" ".join(x for k, x in enumerate(w) if k not in gone))}
        assert all(r == want for r in got[i]), i
    assert got[None][0]["n_removed"] == 0
    assert substrings.repeated_spans(empty).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_equal_windows_have_equal_anchors(seed):
    import pyarrow as pa

    r = random.Random(seed)
    voc = [f"w{i}" for i in range(r.choice([1, 2, 3, 5, 50]))]
    base = [r.choice(voc) for _ in range(300)]
    many = [" ".join([r.choice(voc) for _ in range(r.randrange(30))] + base[(a := r.randrange(200)):a + r.randrange(20, 150)] + [r.choice(voc) for _ in range(r.randrange(30))]) for _ in range(8)]
    _, _, own, anchor = substrings._windows(pa.array(many, pa.large_string()), 20, r.choice([2, 3, 4, 5]))
    seen = {}
    for h, a in zip(own.tolist(), anchor.tolist()):
        assert seen.setdefault(h, a) == a


def test_perplexity_rules(docs, empty, texts):
    got = by_id(perplexity.quality_rules(docs))
    for i, t in enumerate(texts):
        t = t or ""
        w, windows, lines, dup = words(t), {}, set(), 0
        for line in t.split("\n"):
            if words(line):
                dup += line in lines
                lines.add(line)
        for k in range(len(w) - 7):
            windows.setdefault(tuple(w[k:k + 8]), []).append(k)
        covered = {j for at in windows.values() if len(at) > 1 for k in at for j in range(k, k + 8)}
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered), failed)
        for r in got[i]:
            assert tuple(r[c] for c in (*perplexity.MEASURES, "base_failed")) == want, i
            assert not (failed and r["kept"])
    assert perplexity.quality_rules(empty).count() == 0


def test_kneser_ney_probabilities(docs):
    model = perplexity.estimate(docs)
    for m in perplexity._models(tuple(perplexity._packed(model))).values():
        for context in (0, 1 << 10 | 37, 5000, 32767, (1 << 24) - 1):
            run = (np.int32(context) << perplexity.BITS) + np.arange(1 << perplexity.BITS, dtype=np.int32)
            assert abs(np.exp(m.log_probability(run).astype(float)).sum() - 1) < 1e-5
    # languages in several groups give the same as together
    one, many = (sorted((r["doc_id"] or -1, r["log_perplexity"]) for r in perplexity.measured(docs, model, entries=n).collect()) for n in (10**7, 10))
    assert one == many
    # and so do languages dealt by shares, also for texts of which the model knows nothing
    more = docs.unionByName(docs.limit(3).withColumn("text", F.lit("Zyx qwv #7 \u00df\u00df jjk")).withColumn("doc_id", F.lit(99).cast("long")))
    sizes = {r["lang"]: r["count"] for r in model.groupBy("lang").count().collect()}
    most = max(sizes.values()) // 3
    plan = perplexity.passes(model, most=most)
    assert len(plan) > 2 and all(sorted(x for units in plan for x in units.get(lang) or []) == list(range(perplexity.SHARES)) for lang, n in sizes.items() if n > most)
    one, many = (sorted((r["doc_id"] or -1, r["log_perplexity"], r["n_words"]) for r in perplexity.measured(more, model, most=n).collect()) for n in (10**7, most))
    assert len(one) == len(many) and np.allclose(np.array(one), np.array(many), rtol=1e-6)


def test_texts_are_scored_without_their_copies(spark):
    r = random.Random(11)
    some = ["".join(r.choice("abcde fgh, X7") for _ in range(r.randrange(40, 120))) for _ in range(30)]
    every = some + some[:1] * 60 + some[1:2]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(every)], "doc_id long, text string, lang string").repartition(3)
    model = perplexity.estimate(docs)
    whole = perplexity._models(tuple(perplexity._packed(model)))["en"]
    got = by_id(perplexity.measured(docs, model))
    runs_of = lambda t: perplexity.codes(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0]
    for i, text in enumerate(every[:5] + every[-2:]):
        # the counts of a corpus without the text, with the discounts of the whole one
        rest, levels = np.concatenate([runs_of(t) for t in every if t != text]), {}
        for order in range(perplexity.ORDER, 0, -1):
            run, raw = np.unique(rest & ((1 << perplexity.BITS * order) - 1), return_counts=True)
            above = levels[order + 1][0] & ((1 << perplexity.BITS * order) - 1) if order < perplexity.ORDER else None
            levels[order] = (run, raw if above is None else np.unique(above, return_counts=True)[1], raw)
        plain = perplexity.Model(levels, {order: d[1:] for order, d in whole.discounts.items()})
        want = -plain.log_probability(runs_of(text)).mean()
        assert abs(got[every.index(text)][0]["log_perplexity"] - want) < 1e-9, i


def test_bands_are_no_quota(spark):
    """An even corpus loses nothing, far documents go whatever their share; base failures don't move the ends."""
    row = lambda i, x, repeated: (i, "en", 100, repeated, 600, x)
    even = [row(i, 2 + i / 1000, 0) for i in range(1000)] + [row(i, 0.1, 90) for i in range(1000, 1400)]
    far = [row(2000 + i, 9.0, 0) for i in range(80)] + [row(3000 + i, 0.05, 0) for i in range(40)]
    same = [row(i, 2.0, 0) for i in range(50)] + [row(50, 2.05, 0), row(51, 4.0, 0)]

    def kept(rows):
        scores = spark.createDataFrame(rows, "doc_id long, lang string, n_words long, n_repeat_words long, symbols long, log_perplexity double")
        away = (F.col("log_perplexity") - F.col("mid")) / perplexity._spread()
        inside = scores.where("n_repeat_words = 0").join(perplexity.bands(scores), "lang").where(away.between(F.col("low"), F.col("high")))
        return {r["doc_id"] for r in inside.select("doc_id").collect()}

    assert kept(even) == set(range(1000))
    assert kept(even + far) == set(range(1000))
    assert kept(same) == set(range(51))


@pytest.mark.parametrize("letters", ["абвгдежзиклмнопрстуя", "αβγδεζηθικλμνοπρστυω", "abcdefghijklmnopqrst"])
def test_letter_gibberish_goes_in_every_script(spark, letters):
    r = random.Random(5)
    lexicon = ["".join(r.choice(letters) for _ in range(r.randrange(2, 9))) for _ in range(150)]
    prose = [" ".join(r.choice(lexicon) for _ in range(r.randrange(60, 200))) for _ in range(390)]
    noise = [" ".join("".join(r.choice(letters) for _ in range(r.randrange(2, 9))) for _ in range(120)) for _ in range(10)]
    docs = spark.createDataFrame([(i, t, "xx") for i, t in enumerate(prose + noise)], "doc_id long, text string, lang string").repartition(4)
    kept = {x["doc_id"] for x in perplexity.quality_rules(docs).where("kept").select("doc_id").collect()}
    assert not kept & set(range(390, 400)) and len(kept) >= 388


def test_characters_are_folded_by_their_code_point():
    fold = lambda t: (perplexity.codes(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0] & 63).tolist()
    assert fold("az  \n A9,#") == [1, 26, 0, 27, 28, 29, 30]
    assert fold("éб中😀") == [32 + (ord(c) & 31) for c in "éб中😀"]
    assert fold("ЖΑÉ") == fold("жαé")


def test_symbol_runs_are_counted_whole():
    """Tasks that must hand on early lose no count."""
    r = random.Random(3)
    lines = ["".join(r.choice("abc dE9,é") for _ in range(r.randrange(80))) for _ in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array([["", "en"][i % 2] for i in range(200)]), pa.array(lines)], names=["lang", "text"])
    want = {}
    for lang, code, _, _ in perplexity._by_language(batch, pa.array(lines, pa.large_string())):
        for c in code.tolist():
            want[lang, c] = want.get((lang, c), 0) + 1
    for held in (10, 300, 10**6):
        got = {}
        for b in perplexity._counts(held)(iter([batch.slice(i, 20) for i in range(0, 200, 20)])):
            for row in b.to_pylist():
                got[row["lang"], row["run"]] = got.get((row["lang"], row["run"]), 0) + row["n"]
        assert got == want


def test_license_scan(docs, empty, texts):
    got = by_id(licenses.license_scan(docs))
    templates = [(label, set(alnum(t))) for label, t in licenses.TEMPLATES]
    for i, t in enumerate(texts):
        w, places, labels, best = alnum(t), [], set(), 0.0
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            at = [k for k in range(len(w)) if w[k:k + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        more = set(labels)
        best = 1.0 if labels else 0.0
        for line in (t or "").split("\n"):
            tokens = set(alnum(line))
            for label, s in templates:
                if len(s & tokens) >= licenses.CONTAINMENT * len(s) - 1e-9:
                    more.add(label)
                    best = max(best, len(s & tokens) / len(s))
        want = (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(more)))
        for r in got[i]:
            assert tuple(r[c] for c in licenses.RESULT[1:-1]) == want and abs(r["score"] - best) < 1e-9
    assert "apache-2.0" in got[15][0]["labels"] and "mit-notice" not in got[15][0]["labels"]
    assert licenses.license_scan(empty).count() == 0


def test_license_notices_wrapped_over_lines(spark):
    import textwrap

    rows = []
    for width in (1, 20, 40, 72):
        for label, template in licenses.TEMPLATES:
            lines = textwrap.wrap(template, width, break_long_words=False, break_on_hyphens=False)
            rows.append((len(rows), "Some words before.\n" + "\r\n".join(" * " + x for x in lines) + "\nand words after", label))
    # the words stand in neighbouring lines, but not as one notice
    rows.append((len(rows), "Licensed under the Apache License, Version 2.0.\nMIT License and all of the\nrights of authors are reserved", "apache-2.0"))
    got = by_id(licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string, label string").repartition(3)))
    for i, _, label in rows:
        assert label in got[i][0]["labels"].split(",") and got[i][0]["score"] == 1.0, (i, label)
    last = got[len(rows) - 1][0]["labels"]
    assert "mit-notice" not in last and "all-rights-reserved" not in last


def plain_spans(t):
    out = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), m.end(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and pii._luhn(d):
            out.append((m.start(), m.end(), 2))
    out += [(m.start(), m.end(), 3) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans():
    r = random.Random(2)
    for _ in range(4000):
        t = "".join(r.choice("ab@@..1230 -+(é") for _ in range(r.choice([5, 20, 60])))
        assert pii.base_spans(t) == plain_spans(t), t
    assert pii.base_spans("9" * 20000) == [] and pii.base_spans("a" * 20000 + "@") == []


def test_tagger_gradients():
    tagger = pii.Tagger(3)
    ids, mask = pii.character_ids(["ab@c.de 12", "1.2.3.4 x yz@a.b"])
    ids, mask = ids[:, :18], mask[:, :18]
    tags = np.zeros(ids.shape, dtype=int)
    tags[0, :7], tags[1, :7] = [1, 2, 2, 2, 2, 2, 2], [3, 4, 4, 4, 4, 4, 4]
    _, g = tagger.gradients(ids, mask, tags)
    for k, at in (("trans", (1, 2)), ("out", (2, 1)), ("hf", (0, 5)), ("hb", (1, 7)), ("xf", (int(ids[0, 2]), 3)), ("xb", (int(ids[0, 2]), 3))):
        x, e = tagger.p[k], 1e-5
        old = x[at]
        x[at] = old + e
        up, _ = tagger.gradients(ids, mask, tags)
        x[at] = old - e
        down, _ = tagger.gradients(ids, mask, tags)
        x[at] = old
        assert abs((up - down) / (2 * e) - g[k][at]) < 1e-6


def test_personal_data(spark, docs, empty, texts):
    many = spark.createDataFrame([(100 + i, f"the note says {i % 7}x{'and ' * (i % 9)}user{i}.a@mail{i % 5}.example.com and +1 ({200 + i}) 555-{1000 + i} of 10.{i}.3.4 there") for i in range(60)], "doc_id long, text string")
    tagger = pii.fit(many)
    assert pii.fit(empty) is None
    got = by_id(pii.personal_data(docs, tagger))
    for i, t in enumerate(texts):
        base = plain_spans(t or "")
        listed = [f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in base]
        for r in got[i]:
            assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[2] == k for s in base) for k in range(4)]
            assert r["base_sha256"] == sha(",".join(listed))
            assert set(listed) <= set(filter(None, r["spans"].split(",")))
    alone = by_id(pii.personal_data(docs, None))
    assert alone[14][0]["spans"].count(":") == 2 * len(plain_spans(texts[14]))
    clean = by_id(pii.masked(docs, tagger))
    assert "[email]" in clean[14][0]["text"] and "anna.b@" not in clean[14][0]["text"]
    assert clean[18][0]["text"] == texts[18] and clean[8][0]["text"] is None
    assert pii.personal_data(empty, tagger).count() == 0
    # found by itself, by the network alone, where no pattern is asked
    rows = many.collect()
    hits = total = 0
    for r in rows:
        t, starts = r["text"], pii._windows(r["text"])
        found = pii.reconciled(t, [], starts, tagger.decode([t[s:s + pii.WINDOW] for s in starts]))
        hits += len(set(found) & set(plain_spans(t)))
        total += len(plain_spans(t))
    assert hits >= 0.9 * total


def test_network_gradients():
    net = quality_net.Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    r = np.random.default_rng(0)
    parts = [bytes(r.integers(60, 120, s, dtype=np.uint8)) for s in (10, 64, 65, 200)]
    off = np.concatenate([[0], np.cumsum([len(t) for t in parts])])
    raw, y, weight = np.frombuffer(b"".join(parts), np.uint8), np.array([0, 1, 0, 1.0]), np.ones(4)
    _, g = net.gradients(raw, off, y, weight)
    for k, at in (("out", 2), ("hid", (3, 4)), ("conv", (1, 2, 3)), ("embed", (97, 2))):
        x, e = net.p[k], 1e-5
        old = x[at]
        x[at] = old + e
        up, _ = net.gradients(raw, off, y, weight)
        x[at] = old - e
        down, _ = net.gradients(raw, off, y, weight)
        x[at] = old
        assert abs((up - down) / (2 * e) - g[k][at]) < 2e-3 * max(1, abs(g[k][at]))


def test_quality_network(spark, docs, empty, texts):
    r = random.Random(4)
    good = lambda: " ".join(r.choice(["alpha", "beta", "gamma", "delta", "of", "to", "epsilon"]) for _ in range(60))
    bad = lambda: " ".join(r.choice(["ALPHA!!", "***", "BETA!!", "$$$"]) for _ in range(60))
    rows = [(i, good() if i % 2 else bad()) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(1, 1), (None, 0), (3, None)], "doc_id long, quality int")
    net = quality_net.fit(df, labels)
    got = [x for x in quality_net.scored(df, net).collect() if x["held_out"]]
    assert len(got) > 40 and sum(x["predicted"] == x["doc_id"] % 2 for x in got) >= 0.95 * len(got)
    odd = quality_net.scored(docs, net).collect()
    assert len(odd) == len(texts) + 3 and all(0 <= x["score"] <= 1 for x in odd)
    assert quality_net.scored(empty, net).count() == 0
    assert quality_net.good_documents(docs, net).columns == docs.columns
    constant = quality_net.fit(df, labels.limit(0))
    assert {x["score"] for x in quality_net.scored(df, constant).collect()} == {0.5}
    # pooled over the whole document: junk counts wherever it stands
    tail = spark.createDataFrame([(1, " ".join(good() for _ in range(20)) + " " + bad())], "doc_id long, text string")
    assert quality_net.scored(tail, net).first()["predicted"] == 0


def test_bpe(docs, empty, texts):
    import public_tokenizers as P
    import tiktoken

    path = P.path(bpe.VOCABULARY)
    with open(path, "rb") as f:
        vocabulary = bpe.Vocabulary(f.read(), P.PATTERN)
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})
    for size in (bpe.BLOCK_BYTES, 2000):
        got = by_id(bpe.token_digests(docs, path, P.PATTERN, block_bytes=size, buckets=8))
        for i, t in [*enumerate(texts), (None, texts[0])]:
            ids = own.encode_ordinary(t or "")
            want = {"doc_id": i, "n_tokens": len(ids), "ids_sha256": sha(np.array(ids, "<u4").tobytes()), "decoded_sha256": sha(t or "")}
            assert all(r == want for r in got[i]) and len(got[i]) == (2 if i in (0, 4) else 1)
    back = by_id(bpe.decode(bpe.encode(docs, path, P.PATTERN), path, P.PATTERN))
    assert all(bytes(back[i][0]["data"]).decode() == (t or "") for i, t in enumerate(texts))
    other = by_id(bpe.encode(docs, path, r"\S+|\s+", buckets=8))  # any other pattern goes through the regex module
    assert other[12][0]["ids"] == own.encode_ordinary("x")
    assert bpe.token_digests(empty, path, P.PATTERN).count() == 0


def test_pre_tokens():
    import pyarrow as pa
    import regex

    from lakeweave.llm.words import text_bytes

    r, pattern = random.Random(3), regex.compile(bpe.CLASS_PATTERN)
    for _ in range(1500):
        ts = ["".join(r.choice("abstmdrevlé '''sA12  \n\t!?.\x1c\x85\xa0　 日本\U0001f600²") for _ in range(r.choice([0, 1, 2, 5, 30]))) for _ in range(4)]
        want = np.cumsum([0] + [len(w.encode()) for t in ts for w in pattern.findall(t)])[:-1]
        assert bpe.cut(*text_bytes(pa.array(ts, pa.large_string()))).tolist() == want.tolist(), ts


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, digest string, bundle string")


def test_warc(spark):
    big = "<p>" + "é line " * 300
    rows = [(1, "http://a.example/x", big), (5, "http://b.example/y y\r\nz", big), (9, None, big), (9, None, big), (2, "u", "small"), (3, "u", "small"), (4, "u", None), (6, "u", ""), (7, "u", "0" * 1000), (None, "u", big), (8, "u", "1" * 999), (10, "u", "1" * 999)]
    df = pages_of(spark, [(*r, "h", "d", "b") for r in rows]).repartition(2)
    index = warc.write_archives(df, shared_path(spark, "warc-test"))
    got = sorted((tuple(r) for r in warc.read_archives(index).collect()), key=str)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        copy = html == big and i != 9
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if copy else "response", 9 if copy else None))
    assert got == sorted(want, key=str)
    one = warc.fetch(index, spark.createDataFrame([(7,), (99,)], "page_id long")).collect()
    (head, http, payload), = warc.parse(bytes(one[0]["data"]))
    assert len(one) == 1 and payload == b"0" * 1000 and head["warc-record-id"] == one[0]["record_id"]
    assert warc.read_archives(warc.write_archives(df.limit(0), shared_path(spark, "warc-test"))).count() == 0


def test_bundle_frames_are_independent(tmp_path, monkeypatch):
    import zstandard

    monkeypatch.setattr(warc, "FRAME_BYTES", 500)
    path = f"{tmp_path}/x.warc.zst"
    bundle = warc.Bundle(path)
    records = [warc.record(i, "u", b"x" * 100 * i, hashlib.sha1(b"x" * 100 * i).hexdigest(), None)[1] for i in range(12)]
    places = [bundle.add(r) for r in records]
    bundle.close()
    reader = warc.Reader(path)
    assert len(reader.places) == places[-1][0] + 1 > 3
    for r, (frame, begin) in zip(records, places):
        assert reader.frame(frame)[begin:begin + len(r)] == r
    with open(path, "rb") as f:  # any Zstandard reader skips the seek table
        assert zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read() == b"".join(records)


def test_style_tree(spark):
    r = random.Random(5)
    say = lambda n: " ".join(r.choice("aa bo cu da ei fo ga hu il ko".split()) + str(r.randrange(10**6)) for _ in range(n))
    rows, want = [], {}
    for i in range(60):
        a, b = say(12), say(20)
        # a strip without any telling name stands in every article
        html = (f"<html><head><title>t &amp; t</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href=/x>Home</a></li></ul></nav><div class=ad>buy</div>"
                f"<article><h1>{a}</h1><div class=strip9>Read more from us</div><p><b>{a} &amp;&#x41;\n  b<br>c<p>{b}<div class='comments'>nice</div></article><form>f</form><aside>s</aside><footer>&copy; x</footer>")
        rows.append((i, f"http://h{i % 2}.example/{i}", html, "h", "d", "b"))
        want[i] = f"{a}\n{a} &A b c\n{b}"
    rows += [(100, None, None, None, None, None), (101, "x", "", None, None, None), (102, "http://h0.example/", "plain &lt; text", None, None, None), (103, "http://h0.example/", "<div><p>one<li>two", None, None, None), (0, *rows[0][1:])]
    want |= {100: "", 101: "", 102: "plain < text", 103: "one\ntwo"}
    df = pages_of(spark, rows).repartition(3)
    got = style_tree.main_text(df).collect()
    assert len(got) == len(rows)
    for x in got:
        assert x["text"] == want[x["page_id"]] and x["n_chars"] == len(x["text"])
    assert style_tree.main_text(df.limit(0)).count() == 0


def test_names_do_not_decide_alone(spark):
    r = random.Random(8)
    say = lambda n: " ".join(f"w{r.randrange(10**6)}" for _ in range(n))
    rows, want = [], {}
    for i in range(40):
        a, b, c = say(5), say(15), say(12)
        html = (f"<body><div class='content with-sidebar'><article><header class='entry-header'><h1>{a}</h1></header><p>{b}</p><div class='notice'>{c}</div>"
                f"<div class='share'>Tell your friends</div><div class='related'><a href=/1>{say(3)}</a> <a href=/2>{say(3)}</a></div></article></div></body>")
        rows.append((i, f"http://n{i % 2}.example/{i}", html, "h", "d", "b"))
        want[i] = f"{a}\n{b}\n{c}"
    assert {x["page_id"]: x["text"] for x in style_tree.main_text(pages_of(spark, rows).repartition(3)).collect()} == want


def test_copies_of_an_article_stay(spark):
    rows = [(i, "http://h.example/", "<body><nav>menu</nav><article><h1>Same title</h1><p>The same words on every page</p></article>", "h", "d", "b") for i in range(40)]
    assert {x["text"] for x in style_tree.main_text(pages_of(spark, rows)).collect()} == {"Same title\nThe same words on every page"}


def test_broadcast_is_checked(spark):
    from lakeweave.llm.base import sized

    df = spark.range(1000)
    hint = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    assert hint(sized(df, 8)) and not hint(sized(df, 8, limit=100))


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.run(spark, sf).collect()
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert 0 < len(out) <= len(ids) and {r["doc_id"] for r in out} <= ids
    with_columns = docs.withColumn("score", docs.doc_id * 2)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, with_columns, sf).columns == with_columns.columns, name
        assert stage(spark, with_columns.limit(0), sf).count() == 0, name

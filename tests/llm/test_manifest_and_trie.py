"""The Merkle manifest and the prefix trie against plain versions in memory."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lakeweave.llm import merkle, prefix_trie
from lakeweave.llm.order import numbered


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(n):
    return zlib.crc32(str(n).encode())


def test_places_span_partitions_and_nulls_are_a_group(spark):
    r = random.Random(3)
    rows = [(r.choice([None, "a", "a", "a", "b"]), r.choice([None, *range(20)]), i) for i in range(500)]
    placed, groups = numbered(spark.createDataFrame(rows, "g string, o long, at long").repartition(5), ["g"], ["o", "at"])
    want = {}
    for g in {x[0] for x in rows}:
        mine = sorted((x for x in rows if x[0] == g), key=lambda x: (x[1] is not None, x[1] or 0, x[2]))
        want.update({x: (k, len(mine)) for k, x in enumerate(mine)})
    assert {(x["g"], x["o"], x["at"]): (x["place"], x["size"]) for x in placed.collect()} == want
    assert {(x["g"], x["size"]) for x in groups.collect()} == {(x[0], want[x][1]) for x in rows}


DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, place long, size long, tree string, changed string, `row` int, at int, part int"


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_manifest(rows):
    """rows: (doc_id, text, lang, source, n_chars).  One dict a row, as the contract says."""
    low = lambda t: t and re.sub("[A-Z]", lambda m: m[0].lower(), t)
    leaf = lambda d, t, la, s, n: sha("".join(map(field, (d, s, la, n, t))))
    out = [{"doc_id": x[0], "lang": x[2], "leaf": leaf(*x), "own": leaf(x[0], low(x[1]), *x[2:]) if x[0] is not None and crc(x[0]) % 3 == 0 else leaf(*x), "path": []} for x in rows]

    def climb(tree):  # (digest, members)
        while len(tree) > 1:
            up = []
            for k in range(0, len(tree), 8):
                run = tree[k:k + 8]
                for i, (_, members) in enumerate(run):
                    for m in members:
                        m["path"].append(("".join(d for d, _ in run[:i]), "".join(d for d, _ in run[i + 1:])))
                up.append((sha("".join(d for d, _ in run)), [m for _, ms in run for m in ms]))
            tree = up
        return tree[0]

    tops = []
    for lang in sorted({x["lang"] for x in out}, key=lambda v: (v is not None, (v or "").encode())):
        mine = sorted((x for x in out if x["lang"] == lang), key=lambda x: (x["doc_id"] is not None, x["doc_id"] or 0, x["leaf"]))
        tops.append(climb([(x["leaf"], [x]) for x in mine]))
        for x in mine:
            x["subroot"] = tops[-1][0]
    root = climb(tops)[0] if tops else None
    for x in out:
        fold = x["own"]
        for a, b in x["path"]:
            fold = sha(a + fold + b)
        x.update(root=root, proof_sha256=sha("".join(a + b for a, b in x["path"])), folded_root=fold, verified=fold == root)
    return out


def doc_rows(n):
    r = random.Random(5)
    langs = [None, "", "de", "en", "en", "en", "en", "é", "Z"]
    rows = [(i if i % 17 else None, r.choice(["Some Text", "low only", "", None, "Ü日本 X" * r.randint(1, 9)]), r.choice(langs), r.choice([None, "web"]), r.choice([None, i])) for i in range(n)]
    return rows + rows[:5] + [(7, "A" * 300_000, "en", None, None), (7, "other", "en", None, None), (n + 1, "lone", "xx", "s", 4)]


def as_docs(spark, rows):
    return spark.createDataFrame([(*x, "d", 1, 2, "t", "c", 3, 4, 5) for x in rows], DOCS).repartition(3)


@pytest.mark.parametrize("levels", [1, 2, 4])  # blocks of 8, 64 and 4096 leaves: up to four tiers
def test_manifest_as_the_contract_says(spark, levels):
    rows = doc_rows(300)
    docs = as_docs(spark, rows)
    got = merkle.verified(merkle.manifest(docs, merkle.every_third(docs), merkle.lowered(docs), levels)).collect()
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    order = lambda x: (x[0] is None, *map(str, x))
    assert sorted((tuple(x[c] for c in columns) for x in got), key=order) == sorted((tuple(x[c] for c in columns) for x in plain_manifest(rows)), key=order)
    assert {x["verified"] for x in got} == {True, False}


def test_versions_copy_the_path_only(spark):
    docs = as_docs(spark, doc_rows(300))
    m = merkle.manifest(docs, F.col("doc_id").isin(10, 20), F.concat("text", F.lit("!")), levels=1)
    copies = {}
    for x in merkle.versions(m).collect():
        copies.setdefault((x["doc_id"], x["tree"], x["place"]), {})[x["level"]] = x["digest"]
    folds = {x["doc_id"]: x for x in merkle.verified(m).collect() if x["doc_id"] in (10, 20)}
    rows = [x for x in plain_manifest(doc_rows(300)) if x["doc_id"] in (10, 20)]
    assert len(copies) == 2 == len(rows)
    for (doc, _, _), nodes in copies.items():
        depth = next(len(x["path"]) for x in rows if x["doc_id"] == doc)
        assert sorted(nodes) == list(range(depth + 1)) and nodes[depth] == folds[doc]["folded_root"]


def test_manifest_of_nothing_and_of_one(spark):
    docs = as_docs(spark, [(1, "X", None, None, None)])
    one = merkle.verified(merkle.manifest(docs, merkle.every_third(docs), merkle.lowered(docs))).collect()
    assert len(one) == 1 and one[0]["root"] == one[0]["leaf"] == one[0]["subroot"] and one[0]["proof_sha256"] == sha("")
    none = docs.limit(0)
    m = merkle.manifest(none, merkle.every_third(none), merkle.lowered(none))
    assert m.root is None and merkle.verified(m).count() == 0 and merkle.versions(m).count() == 0


def plain_trie(rows):
    """rows: (conv_id, turn, role, text).  One tuple a node, as the contract says."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append((turn is not None, turn or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest(), role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    new = {c: own.get(c - c % 20, [])[:crc(c) % 4] + t[crc(c) % 4:] for c, t in own.items()}
    members, children = {}, {}
    ids = {}  # a node is known by its parent's number and its last turn
    for c in sorted(new):
        at = ids.setdefault((None, None), (0, None, 0, ""))
        members.setdefault(at, []).append(c)
        for d, turn in enumerate(new[c], 1):
            below = ids.setdefault((at[0], turn), (len(ids), at, d, turn[1]))
            if below not in members:
                children.setdefault(at, []).append(below)
            members.setdefault(below, []).append(c)
            at = below
        new[c] = at
    totals = {}
    for node in sorted(members, key=lambda n: -n[2]):
        kids = children.get(node, [])
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[3])) if node[2] else 0
        totals[node] = (sum(totals[k][0] for k in kids) if kids else 1, (len(members[node]) - 1) * words + sum(totals[k][1] for k in kids))
    ends = {}
    for c in sorted(new):
        ends.setdefault(new[c], []).append(str(c))
    return sorted((min(m), n[2], min(members[n[1]]) if n[1] else -1, len(m), len(children.get(n, [])), *totals[n], sha(",".join(ends.get(n, [])))) for n, m in members.items())


def trie_rows(got):
    return sorted((x["conv_id"], x["depth"], -1 if x["parent_conv_id"] is None else x["parent_conv_id"], x["n_convs"], x["n_children"], x["n_leaves"], x["saved_tokens"], x["ends_sha256"]) for x in got.collect())


CONVS = "conv_id long, turn long, role string, text string, place long, size long, `key` string, depth int, words string, h int, b string, digest string, `row` int, leaf string"


def as_convs(spark, rows):
    return spark.createDataFrame([(*x, 1, 2, "k", 3, "w", 4, "b", "d", 5, "l") for x in rows], CONVS).repartition(4)


def conversation_rows():
    r = random.Random(11)
    rows = []
    for c in [*range(0, 130), 400, 401, 402, 403]:
        if c in (20, 60):  # bases that are not there
            continue
        for turn in range(r.choice([1, 2, 3, 6, 20])):
            rows.append((c, r.choice([None, turn, turn]), r.choice([None, "", "user"]), r.choice([None, "", "hi there", "hi  there you", "a\tb\n c"])))
    same = [(t, "user", f"turn {t % 3}") for t in range(70)]
    for c in range(1000, 1060):  # copies, of all lengths
        rows += [(c, *x) for x in same[:c - 990]]
    for c, n in ((2000, 1300), (2001, 1299), (2020, 700)):  # longer than pieces
        rows += [(c, t, "user", f"w {t % 5}") for t in range(n)]
    rows += [rows[0], rows[0], (None, 1, "user", "no id"), (2, 5, "x", "word " * 30_000)]
    return rows


def test_trie_as_the_contract_says(spark):
    rows = conversation_rows()
    assert trie_rows(prefix_trie.trie(*prefix_trie.rebuilt(as_convs(spark, rows)))) == plain_trie(rows)


def test_trie_of_nothing_and_of_a_turnless_conversation(spark):
    none = as_convs(spark, conversation_rows()[:1]).limit(0)
    assert prefix_trie.trie(*prefix_trie.rebuilt(none)).count() == 0
    c = next(c for c in range(41, 60) if crc(c) % 4 == 3)  # all its turns are replaced by those of an absent conversation
    rows = [(c, 0, "user", "one"), (c, 1, "user", "two")]
    got = trie_rows(prefix_trie.trie(*prefix_trie.rebuilt(as_convs(spark, rows))))
    assert got == plain_trie(rows) == [(c, 0, -1, 1, 0, 1, 0, sha(str(c)))]

"""Line dedup, suffix-array dedup and SimHash near-dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tierflow.llm import line_dedup, simhash, suffix_dedup
from tierflow.llm.components import components

SCHEMA = "doc_id long, text string, id string, row string, keys string, n_lines int"


def table(spark, texts, ids=None):
    """Documents with columns whose names the operators use themselves."""
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", "y", "z", 7) for i, t in zip(ids, texts)], SCHEMA)


LINES = [
    None,
    "",
    "A shared line here\nown line number one\nA shared line here",
    "\t a SHARED line here \x0b\nshort\nshort\n",
    "short\nÄ shared line here\nä shared line here",
    "A shared line here",
    "A shared line here",
    "own line number two\n" * 3,
    "éééééééééé\n\n\néééééééééé",
    "x éééééééééé\néééééééééé ",
    "long " * 40_000 + "\nA shared line here",
]


def lines_expected(texts, ids, min_chars=10):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    order = [2**63 - 1 if i is None else i for i in ids]
    owner = {}
    for i, t in zip(order, texts):
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                owner[key(line)] = min(owner.get(key(line), i), i)
    out = []
    for i, t in zip(order, texts):
        lines = (t or "").split("\n")
        kept = [x for x in lines if owner.get(key(x), i) >= i]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


@pytest.mark.parametrize("batches", [1, 3, 6])
def test_line_dedup(spark, batches):
    ids = [None, 9, 2, 3, 4, 5, 5, 6, 7, 8, 1]
    out = line_dedup.dedup_lines(table(spark, LINES, ids), batches=batches)
    assert out.columns == ["doc_id", "text", "id", "row", "keys", "n_lines", "n_dropped", "kept_sha256"][:5] + [
        "n_lines",
        "n_dropped",
        "kept_sha256",
    ]
    got = sorted((str(r.doc_id), r.text, r.n_lines, r.n_dropped, r.kept_sha256, r.keys) for r in out.collect())
    want = sorted(
        (str(i), t, n, d, hashlib.sha256(t.encode()).hexdigest(), "z")
        for i, (t, n, d) in zip(ids, lines_expected(LINES, ids))
    )
    assert got == want


def test_line_dedup_random(spark):
    rng = random.Random(1)
    pool = [f"line number {i} of the pool" for i in range(40)]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(0, 8))) for _ in range(80)]
    ids = rng.sample(range(1000), 80)
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_dedup.dedup_lines(table(spark, texts, ids), batches=4).collect()}
    assert got == dict(zip(ids, lines_expected(texts, ids)))


def test_line_dedup_empty_table(spark):
    assert line_dedup.dedup_lines(table(spark, [])).count() == 0


def test_runs_are_compacted(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for batch in range(5):
        rows = spark.createDataFrame([(batch, bytes([batch])), (batch, b"all")], "id long, key binary")
        drops = runs.add(rows).collect()
        assert len(drops) == (batch > 0)
    assert [level for level, _ in runs.runs] == [2, 0]
    assert sum(run.count() for _, run in runs.runs) == 6


def removed_expected(texts, ids, length=100):
    seen, out = {}, []
    order = sorted(range(len(texts)), key=lambda i: (2**63 - 1 if ids[i] is None else ids[i]))
    for i in order:
        data = (texts[i] or "").encode()
        for s in range(len(data) - length + 1):
            seen.setdefault(data[s : s + length], (i, s))
    for i, t in enumerate(texts):
        data = (t or "").encode()
        mask = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            if seen[data[s : s + length]] != (i, s):
                mask[s : s + length] = True
        kept = np.frombuffer(data, np.uint8)[~mask].tobytes()
        spans = int((np.diff(np.concatenate(([0], mask.astype(int)))) == 1).sum())
        out.append((len(data), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def some_texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeéthn ") for _ in range(rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rng.randint(20, 80))) for _ in range(6)]
    texts = [None, "", "short", "a" * 99, "a" * 100, "a" * 350, "ab" * 200, passages[0] * 5, "xyz" * 100 + passages[1]]
    for _ in range(40):
        parts = [" ".join(word() for _ in range(rng.randint(0, 60)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts += [p[a : a + rng.randint(50, 200)], word()]
        texts.append("".join(parts))
    texts += texts[10:14] + [texts[20][:-1] + "Q", "Q" + texts[21]]
    return texts


@pytest.mark.parametrize("runs_in_task, shard", [(20_000, 1 << 20), (20_000, 300), (3, 1 << 20)])
def test_suffix_dedup(spark, monkeypatch, runs_in_task, shard):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    texts = some_texts(runs_in_task + shard)
    ids = random.Random(5).sample(range(1000), len(texts))
    ids[7] = None
    out = suffix_dedup.dedup_substrings(table(spark, texts, ids), runs_in_task=runs_in_task).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out}
    want = dict(zip(ids, removed_expected(texts, ids)))
    assert got == want
    assert sum(w[1] for w in want.values()) > 5_000
    for r in out:
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
        assert sum(s["to"] - s["from"] for s in r.spans) == r.n_removed


def test_suffix_dedup_no_rows_or_columns_of_its_own(spark):
    assert suffix_dedup.dedup_substrings(table(spark, [])).count() == 0
    same = suffix_dedup.dedup_substrings(table(spark, ["w" * 50 + "v" * 70] * 2, [4, 4])).collect()
    assert [r.n_removed for r in same] == [0, 0]


def test_suffix_array_and_prefixes():
    rng = random.Random(3)
    data = bytes(rng.choice(b"ab") for _ in range(3_000)) + b"ab" * 300
    order = suffix_dedup.suffix_array(data, 128)
    keys = [data[i : i + 128] for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(len(data)))
    same = suffix_dedup.common_prefixes(data, order, 100)
    for k in range(1, len(order)):
        a, b = data[order[k - 1] :][:100], data[order[k] :][:100]
        assert same[k] == (a == b and len(a) == 100)


def test_anchors_depend_on_the_window_alone():
    rng = random.Random(4)
    passage = bytes(rng.choice(b"abcdefgh ") for _ in range(400))

    def anchors(data):
        return {
            data[start + i : start + i + 100]: int(anchor)
            for _, of, starts, counts, hashes in suffix_dedup.runs_of([b"-" * 130, data])
            for which, start, n, anchor in zip(of, starts, counts, hashes)
            if which == 1
            for i in range(n)
        }

    one, two = anchors(b"first " + passage + b" end"), anchors(b"a second text " + passage)
    shared = one.keys() & two.keys()
    assert len(shared) >= 301 and all(one[w] == two[w] for w in shared)


def test_long_documents_are_taken_in_stretches(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STRETCH", 1000)
    data = bytes(random.Random(6).choice(b"abcd ") for _ in range(9_000))
    found = sum((list(zip(s, n)) for _, _, s, n, _ in suffix_dedup.runs_of([data])), [])
    assert sorted(x for s, n in found for x in range(s, s + n)) == list(range(len(data) - 99))


def fingerprint(text, words=3):
    found = (text or "").encode().lower().split()
    shingles = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))] if found else []
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def groups(values, ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in zip(ids, values):
        for j, b in zip(ids, values):
            if (a ^ b).bit_count() <= 2 and find(i) != find(j):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in ids}


def test_simhash_documents(spark):
    rng = random.Random(2)
    base = " ".join(f"w{rng.randint(0, 300)}" for _ in range(400))
    texts = [None, "", " \n ", "one", "One two", "one two three", "É one two three four", base, base, base + " tail", base.upper()]
    texts += ["same word " * 300, "same word " * 301, "x " * 70_000]
    ids = [None, 12, 3, 4, 5, 6, 7, 8, 9, 10, 11, 20, 21, 1]
    out = simhash.near_duplicates(table(spark, texts, ids)).collect()
    known = [2**63 - 1 if i is None else i for i in ids]
    prints = dict(zip(known, map(fingerprint, texts)))
    assert {r.id: r.fp % (1 << 64) for r in out} == prints
    assert {r.id: r.component_id for r in out} == groups(list(prints.values()), known)
    assert simhash.near_duplicates(table(spark, [])).count() == 0


@pytest.mark.parametrize("pairs_up_to", [0, 4, 1000])
def test_links_hold_every_pair(spark, monkeypatch, pairs_up_to):
    """A crowded neighbourhood, chains and far points, by either way of linking."""
    monkeypatch.setattr(simhash, "PAIRS_UP_TO", pairs_up_to)
    rng = random.Random(9)
    values = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(25):
            value = centre
            for bit in rng.sample(range(64), rng.randint(0, 3)):
                value ^= 1 << bit
            values.add(value)
        for _ in range(5):
            centre ^= 3 << rng.randint(0, 62)
            values.add(centre)
    values |= {rng.getrandbits(64) for _ in range(100)}
    values = sorted(values)
    rows = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    found = {r.node % (1 << 64): r.root for r in components(simhash.links(rows)).collect()}
    want = groups(values, range(len(values)))
    by_root = {}
    for i, v in enumerate(values):
        by_root.setdefault(want[i], set()).add(v)
    got = {}
    for v in values:
        got.setdefault(found.get(v, ("alone", v)), set()).add(v)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, got.values()))


def test_chain_budgets():
    assert simhash.budgets(2) == [0, 0, 1, 1, 2]


def test_one_of_each(spark):
    texts = ["a b c d e f"] * 3 + ["something else altogether here"]
    out = simhash.one_of_each(table(spark, texts, [5, 4, 4, 9]))
    assert sorted(r.doc_id for r in out.collect()) == [4, 9]
    assert out.columns == ["doc_id", "text", "id", "row", "keys", "n_lines"]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(300, 400)] + [(7, 7)]
    random.Random(1).shuffle(edges)
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, 5: 5, **{i: 5 for i in range(300, 400)}}
    empty = spark.createDataFrame([], "u long, v long").withColumn("w", F.lit(1))
    assert components(empty).count() == 0

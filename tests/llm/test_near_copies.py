"""Near copies of five-word shingles against brute force."""

import random

import numpy as np
import pytest

from tierflow.llm import near_copies, queries

SCHEMA = "doc_id long, text string, id string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)


def shingles(text, words=5):
    found = (text or "").lower().split()
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def edited(rng, text, edits):
    words = text.split()
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"edit{rng.randint(0, 10**9)}"
    return " ".join(words)


def planted(seed, families, copies, unique):
    rng = random.Random(seed)
    say = lambda n: " ".join(f"w{rng.randint(0, 5000)}" for _ in range(n))
    texts = []
    for _ in range(families):
        base = say(rng.randint(60, 500))
        texts.append(base)
        for _ in range(copies):
            texts.append(edited(rng, base, max(1, int(len(base.split()) * rng.uniform(0.005, 0.03)))))
    texts += [say(rng.randint(1, 200)) for _ in range(unique)]
    rng.shuffle(texts)
    return list(enumerate(texts))


def brute(rows):
    """The least id of each component, and the number of pairs that link."""
    sets = [shingles(t) for _, t in rows]
    root, pairs = list(range(len(rows))), 0

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b):
                pairs += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i for i in range(len(rows)) if find(i) == i}, pairs


@pytest.mark.parametrize("pairs_up_to", [2, 16])
def test_near_copies_are_those_of_brute_force(spark, monkeypatch, pairs_up_to):
    monkeypatch.setattr(near_copies, "PAIRS_UP_TO", pairs_up_to)
    rows = planted(pairs_up_to, 30, 6, 60)
    want, pairs = brute(rows)
    assert pairs > 150 and len(want) < 200
    out = queries.near_dedup(spark, table(spark, rows), None)
    assert out.columns == ["doc_id", "text", "id"]
    assert {r.doc_id for r in out.collect()} == want


def test_candidates_hold_the_pairs_of_brute_force():
    """Recall of the bands alone on planted pairs, most of them near the similarity."""
    rng, found, total = random.Random(8), 0, 0
    for _ in range(1500):
        base = " ".join(f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(60, 300)))
        copy = edited(rng, base, max(1, int(len(base.split()) * 0.024)))
        a, b = shingles(base), shingles(copy)
        if len(a & b) >= 0.8 * len(a | b):
            total += 1
            one, two = (near_copies.bands(near_copies.shingle_set(t.encode(), 5)) for t in (base, copy))
            found += any(x == y for x, y in zip(one, two))
    print(f"recall {found} of {total}")
    assert total > 500 and found >= 0.995 * total


def test_odd_rows(spark):
    rows = [(None, None), (None, "one two three"), (None, "four five six"), (3, ""), (4, "a b c d e f"), (4, "a b c d e f"), (4, "g h i j k l")]
    out = near_copies.one_of_each(table(spark, rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted(
        [(None, "one two three"), (None, "four five six"), (3, ""), (4, "a b c d e f"), (4, "g h i j k l")], key=str
    )
    assert near_copies.one_of_each(table(spark, [])).count() == 0


def test_pigeonring_finds_its_pairs_without_bands(spark, monkeypatch):
    """Near copies of two bits or fewer are found by fingerprints alone, copies of a fingerprint too."""
    rng = random.Random(5)
    rows = []
    for _ in range(12):
        base = " ".join(f"w{rng.randint(0, 5000)}" for _ in range(1500))
        rows += [base, edited(rng, base, 1), f"{base} {' '.join(base.split()[:6])}"]
    rows = list(enumerate(rows))
    fp = [near_copies.bit_majority(near_copies.shingle_set(t.encode(), 5), np.zeros(1, int))[0] for _, t in rows]
    near = {(i, j) for j in range(len(rows)) for i in range(j) if int(fp[i] ^ fp[j]).bit_count() <= 2}
    assert len(near) >= 12 and all(i // 3 == j // 3 for i, j in near)
    monkeypatch.setattr(near_copies, "bands", lambda shingles: [])
    left = {r.doc_id for r in queries.near_dedup(spark, table(spark, rows), None).collect()}
    root = list(range(len(rows)))
    for i, j in sorted(near):
        a, b = sorted((root[i], root[j]))
        root = [a if r == b else r for r in root]
    assert left == set(root)

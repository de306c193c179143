"""The prefix trie against one built node by node."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tierflow.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, at string, n string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def tie(role, text):
    return hashlib.md5(f"{role}\0{text}".encode()).digest()


def rebuilt(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, tie(role or "", text or ""), role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node in sorted(members, key=len, reverse=True):
        here = members[node]
        below = [n for n in members if n[: len(node)] == node]
        childless = [n for n in below if not any(m[:-1] == n for m in members if m)]
        ends = ",".join(map(str, sorted(c for c in here if len(convs[c]) == len(node))))
        out.append(
            (
                min(here),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(here),
                sum(1 for m in members if m and m[:-1] == node),
                len(childless),
                sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def made(seed, convs):
    rng = random.Random(seed)
    rows = []
    for _ in range(convs):
        c = rng.choice([rng.randint(0, 12) * 100, rng.randint(0, 1250)])
        length = rng.choice([1, 2, 3, 8, 14])
        for k in range(length):
            turn = rng.choice([k, k, None, 0])
            rows.append((c, turn, rng.choice(["user", "assistant", None, ""]), rng.choice(["hi", "ho", None, "é日", "x" * 30])))
    rows += [(None, 1, "user", "lost"), (55, 1, None, None), (955, 0, "user", "hi")]
    rows += [(1200 + k, 0, "user", "same") for k in range(40)]  # copies
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_rows", [3, 40, 100_000])
def test_trie_is_that_of_brute_force(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(prefix_trie, "IDS", 7)
    rows = made(shard_rows, 70)
    found = prefix_trie.trie(prefix_trie.grafted(prefix_trie.numbered(table(spark, rows))), shard_rows)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in found.collect()), key=str) == brute(rebuilt(rows))


def test_a_long_conversation_over_many_parts(spark):
    rng = random.Random(9)
    rows = [(7, k, "user", f"turn {k}") for k in range(600)] + [(8, k, "user", f"turn {k}") for k in range(350)] + [(9, 0, "user", "turn 0")]
    rng.shuffle(rows)
    plain = prefix_trie.whole(prefix_trie.numbered(table(spark, rows)))
    assert plain.filter("at is not null").count() == len(rows)
    found = {(r.conv_id, r.depth): r for r in prefix_trie.trie(plain, 50).collect()}
    assert len(found) == 601 and all(found[7, d].n_convs == (2 if d > 1 else 3) for d in range(351)) and found[7, 600].n_leaves == 1
    texts = [len(f"turn {k}") for k in range(600)]
    assert found[7, 0].saved_tokens == sum(texts[:350]) + texts[0]
    assert found[7, 349].n_children == 1 and found[7, 349].n_leaves == 1 and found[7, 0].parent_conv_id is None


def test_no_rows(spark):
    empty = table(spark, [])
    assert prefix_trie.trie(prefix_trie.grafted(prefix_trie.numbered(empty))).count() == 0
    assert prefix_trie.trie(prefix_trie.grafted(prefix_trie.numbered(table(spark, [(None, 1, "user", "x")])))).count() == 0


@pytest.mark.parametrize("n", [1, 2, 31, 63, 64, 65, 4_000])
def test_find_close_matches_a_stack(n):
    rng = random.Random(n)
    depth, at = [], 0
    for k in range(n):
        depth.append(at)
        at = min(at + 1, rng.choice([at + 1, at + 1, rng.randint(0, at + 1)])) if k % 3 else rng.randint(0, at + 1)
    opens, closes, bits = prefix_trie.parentheses(np.array(depth))
    stack, want = [], {}
    for place, bit in enumerate(bits.tolist()):
        if bit:
            stack.append(place)
        else:
            want[stack.pop()] = place
    assert not stack and [want[p] for p in opens.tolist()] == closes.tolist()

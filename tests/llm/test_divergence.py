"""Source divergence against a count by regular expression and whole-number sums."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tierflow.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def table(spark, rows):
    return spark.createDataFrame([(i, t, a, s, "x", "y") for i, (t, a, s) in enumerate(rows)], SCHEMA)


def terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def brute(rows, least_docs, top=50):
    count, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = terms(text)
        count[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        sources = [s for a, s in count if a == lang]
        whole = sum((count[lang, s] for s in sources), Counter())

        def p(counter):
            total = sum(counter[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counter[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q = p(whole)
        per = {s: p(count[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(per[s][t] - per[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            more = [(q[t] - per[s][t], t.encode(), t) for t in kept if count[lang, s][t] and per[s][t] > q[t]]
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(sorted(more)[:top])]
    return sorted(out)


def made(seed, n):
    rng = random.Random(seed)
    words = ["a", "Be", "été", "abcdefgh", "abcdefghi", "ab" * 8, "ab" * 8 + "c", "é" * 9, "日本語", "x" * 300, "İ", " q", "zz"]
    words += ["".join(rng.choice("abcdeÉ") for _ in range(rng.randint(1, 20))) for _ in range(60)]
    rows = []
    for _ in range(n):
        text = rng.choice(["", None] + [rng.choice(" ,.\n1_\0").join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(8)])
        rows.append((text, rng.choice(["en", "en", "de", None, ""]), rng.choice(["s1", "s1", "s2", None, "", "é", "s10"])))
    return rows


@pytest.mark.parametrize("tile,chunk", [(64, 8_000_000), (2, 500)])
def test_audit_is_that_of_brute_force(spark, monkeypatch, tile, chunk):
    monkeypatch.setattr(divergence, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(divergence, "TILE_TERMS", 7)
    rows = made(tile, 400)
    out = divergence.audit(table(spark, rows), least_docs=5, top=6, tile=tile)
    assert sorted(tuple(r) for r in out.collect()) == brute(rows, 5, 6)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_no_term_kept_and_no_rows(spark):
    rows = [("some words", "en", "a"), (None, "en", "b"), ("words", "fr", "a")]
    out = divergence.audit(table(spark, rows)).collect()
    assert sorted(tuple(r) for r in out) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert divergence.audit(table(spark, [])).count() == 0


def test_a_long_text_counts_as_one_document(monkeypatch):
    monkeypatch.setattr(divergence, "CHUNK_BYTES", 64)
    rng = random.Random(1)
    text = " ".join(rng.choice(["one", "two", "l" * 200, "été"]) for _ in range(500))
    found = divergence.count_long(text.encode(), 3).to_pylist()
    want = Counter(terms(text))
    assert {r["term"]: r["n"] for r in found} == want
    assert all(r["docs"] == 1 and r["group"] == 3 for r in found) and len(found) == len(want)


def test_radix_order_is_stable():
    rng = np.random.default_rng(2)
    words = [rng.integers(0, 3, 2_000).astype(np.uint64) << np.uint64(40), rng.integers(0, 3, 2_000).astype(np.uint64)]
    order = divergence.radix_order(words, [(d // 4, d % 4) for d in range(8)])
    assert order.tolist() == sorted(range(2_000), key=lambda i: (words[0][i], words[1][i], i))

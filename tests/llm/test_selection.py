"""Decontamination, sharding, packing, toxicity, quality rules, pages: brute force and edge cases."""

import itertools
import random
import re
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierflow.llm import decontaminate, html_extract, language_id, packing, quality_rules, sharding, toxicity
from tierflow.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, id string, tokens string, seed int, row string, stats int"


def table(spark, texts, ids=None):
    """Documents with columns whose names the operators use themselves."""
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", "y", 3, "z", 1) for i, t in zip(ids, texts)], SCHEMA)


# Decontamination


def test_masks_hit_every_window():
    for bad in itertools.combinations(range(decontaminate.WINDOW), decontaminate.SUBSTITUTIONS):
        assert any(
            not {at + p for p in mask} & set(bad)
            for mask in decontaminate.MASKS
            for at in range(decontaminate.WINDOW - mask[-1])
        ), bad


def overlaps_expected(texts, items):
    words = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    out = {}
    for d, text in texts:
        doc = words(text)
        for i, item in items:
            want = words(item)
            if len(want) < 12:
                continue
            for start in range(-len(want) + 1, len(doc)):
                e = [0 <= start + k < len(doc) and doc[start + k] == w for k, w in enumerate(want)]
                if any(sum(e[k : k + 12]) >= 10 for k in range(len(e) - 11)):
                    best = out.get((d, i), (0, 0, 0))
                    out[d, i] = max(best, (sum(e), -start, len(want)))
    return {k: (n, e, -s) for k, (e, s, n) in out.items()}


@pytest.mark.parametrize("block_seeds", [400_000, 60])
def test_overlaps(spark, block_seeds):
    rng = random.Random(3)
    word = lambda: f"w{rng.randint(0, 400)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([5, 11, 12, 13, 20, 40])))) for i in range(12)]
    items += [(50, None), (51, ""), (None, "a b c d e f g h i j k l m")]
    texts = [None, "", "too short", " ".join(word() for _ in range(50_000))]
    for _ in range(60):
        part = rng.choice(items[:12])[1].split()
        a = rng.randint(0, max(0, len(part) - 12))
        part = part[a : a + rng.randint(10, 40)]
        for _ in range(rng.randint(0, 4)):
            part[rng.randrange(len(part))] = word()
        lead = [word() for _ in range(rng.randint(0, 5))]
        texts.append(", ".join(lead + part * rng.randint(1, 2)).upper())
    rows = list(enumerate(texts))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.overlaps(table(spark, texts), benchmark, block_seeds=block_seeds).collect()
    got = {(r.id, r.item_id): (r.n_tokens, r.n_equal, r.start) for r in out}
    assert got == overlaps_expected(rows, [i for i in items if i[0] is not None])
    assert len(got) == len(out) > 20


def test_decontaminate_keeps_columns_and_clean_rows(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    near = item.replace("five", "FIFTH").replace("nine", "ninth")
    docs = table(spark, [item, f"so {near} it goes", "clean text", None, item], [1, 2, 3, 4, None])
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = decontaminate.decontaminate(docs, benchmark)
    assert sorted(r.doc_id for r in out.collect()) == [3, 4] and out.columns == docs.columns
    assert decontaminate.decontaminate(docs, benchmark.limit(0)).count() == 5
    assert decontaminate.decontaminate(docs.limit(0), benchmark).count() == 0


# Sharding


def check_shards(rows, texts, shards):
    assert sorted(r.size for r in rows) == sorted(len((t or "").encode()) + 8 for t in texts)
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert all(r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards for r in rows)


def test_shards_are_even_and_keep_copies_together(spark):
    rng = random.Random(1)
    texts = ["é" * rng.randint(0, 400) + str(i) for i in range(4_000)] + ["a copy " * 20] * 120
    docs = table(spark, texts)
    rows = sharding.shard_by_bytes(docs, shards=8).collect()
    check_shards(rows, texts, 8)
    assert {(r.doc_id, r.text_crc32) for r in rows} == {(i, zlib.crc32(t.encode())) for i, t in enumerate(texts)}
    load = [sum(r.size for r in rows if r.shard == s) for s in range(8)]
    assert max(load) < 1.02 * min(load)
    assert len({r.shard for r in rows if r.doc_id >= 4_000}) == 1


def test_a_group_larger_than_a_shard_is_split_evenly(spark):
    texts = ["hot " * 30] * 1_500 + [f"text {i} " * 10 for i in range(1_500)]
    rows = sharding.shard_by_bytes(table(spark, texts), shards=6).collect()
    check_shards(rows, texts, 6)
    load = [sum(r.size for r in rows if r.shard == s) for s in range(6)]
    assert max(load) < 1.05 * min(load)


def test_shards_of_odd_rows(spark):
    texts = [None, "", "", "x" * 300_000, None, "y"]
    rows = sharding.shard_by_bytes(table(spark, texts, [None, 1, 1, 2, 3, None])).collect()
    check_shards(rows, texts, 24)
    assert sharding.shard_by_bytes(table(spark, [])).count() == 0


def test_sampling_misses_are_mended(spark):
    texts = [f"{i} " * (1 + i % 50) for i in range(2_000)]
    rows = sharding.shard_by_bytes(table(spark, texts), shards=4, ranges_per_shard=16, samples_per_range=1).collect()
    check_shards(rows, texts, 4)
    load = [sum(r.size for r in rows if r.shard == s) for s in range(4)]
    assert max(load) < 1.1 * min(load)


# Packing


def test_chunks_give_the_ids_of_the_whole_text():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    encoder = packing.ChunkEncoder(tokenizer_path())
    rng = random.Random(2)
    marks = ["The,", "WORD***", "é,", "can't,", "x'S!", "(a)", "<|ENDOFTEXT|>", "≠", "a", "É", "é", "́x", "don't", "it's", "'s", "12", " ", " ", "\x1c", "\x85", "<|endoftext|>", "漢字", "!!", "​", "ẞ", "İ", "ﬁ"]
    for _ in range(300):
        text = "".join(rng.choice(marks) + rng.choice(["", " ", "\n", "\t\r", "\x0b"]) for _ in range(rng.randint(0, 30)))
        ids = np.frombuffer(encoder.encode(["".encode(), text.encode()])[1], "<u4")
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids


def test_ids_of_words_that_lower_casing_changes():
    """Texts over all of Unicode, with letters that become several code points when lower-cased."""
    from tokenizers import Tokenizer

    rng = random.Random(19)
    encoder, whole = packing.ChunkEncoder(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    letters = ["İ", "ß", "ẞ", "ŉ", "ǰ", "ΐ", "ﬁ", "Σ", "ς", "I", "i", "Å", "é", "e\u0301", "\u0307", "K", "ª"]
    marks = [".", ",", "!", "...", "'", "%", ")", "-", "‘", ""]
    for _ in range(10_000):
        parts = []
        for _ in range(rng.randint(1, 4)):
            word = "".join(rng.choice([rng.choice(letters), chr(rng.choice([rng.randint(32, 0x2FF), rng.randint(0x300, 0xD7FF), rng.randint(0x10000, 0x1FFFF)]))]) for _ in range(rng.randint(1, 3)))
            parts.append(word + rng.choice(["İ", "", ""]) + rng.choice(marks))
        text = " ".join(parts)
        got = np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist()
        assert got == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_forgetting_encoder_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED_WORDS", 7)
    encoder, fresh = packing.ChunkEncoder(tokenizer_path()), packing.ChunkEncoder
    rng = random.Random(4)
    for _ in range(40):
        text = " ".join(rng.choice("abcdefgh") * rng.randint(1, 4) + rng.choice(["", ",", "%%%"]) for _ in range(30)).encode()
        assert encoder.encode([text]) == fresh(tokenizer_path()).encode([text])


def test_words_that_are_known_cost_no_python_call_each():
    """Also where more chunks than are remembered occur: finding and joining them is not done one by one."""
    letters = "abcdefghij"
    words = [a + b + c + d for a, b, c, d in itertools.product(letters, letters, letters, "xy")]
    text = " ".join(words).encode()
    encoder = packing.ChunkEncoder(tokenizer_path(), words=3000)
    want = encoder.encode([text])
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event == "call" else None)
    try:
        found = encoder.encode([text])
    finally:
        sys.setprofile(None)
    assert found == want and len(words) == 2000
    assert len(calls) < 200


def check_packing(rows, size):
    used = {}
    for r in rows:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return used


def test_pack(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    rng = random.Random(5)
    texts = [None, "", "word " * 500, "one two"] + [" ".join("ab cd ef".split()[: rng.randint(1, 3)] * rng.randint(1, 30)) for _ in range(300)]
    ids = [None, 1, 2, 2] + list(range(10, 310))
    docs = table(spark, texts, ids)
    rows = packing.pack(docs, tokenizer_path(), size=64).collect()
    want = []
    for i, t in zip(ids, texts):
        tokens = whole.encode(t or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(tokens), 64)):
            part = np.array(tokens[at : at + 64], "<u4")
            want.append((str(i), k, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    used = check_packing(rows, 64)
    assert len(used) <= 1.03 * sum(r.length for r in rows) / 64 + 1
    assert packing.pack(docs.limit(0), tokenizer_path()).count() == 0


def test_best_fit_is_as_tight_as_one_by_one():
    rng = random.Random(7)
    for _ in range(30):
        size = rng.choice([10, 100, 4096])
        lengths = [rng.randint(1, size) if rng.random() < 0.5 else rng.randint(1, max(1, size // 5)) for _ in range(600)]
        runs = sorted({x: lengths.count(x) for x in lengths}.items(), reverse=True)
        used = {}
        in_order = sorted(lengths, reverse=True)
        for rank, count, sequence, offset in packing.best_fit(runs, size):
            for i in range(count):
                used.setdefault(sequence + i, []).append((offset, in_order[rank + i]))
        assert sum(map(len, used.values())) == len(lengths)
        gaps = []
        for x in in_order:
            fit = min((g for g in gaps if g >= x), default=None)
            if fit is not None:
                gaps.remove(fit)
            gaps.append((size if fit is None else fit) - x)
        assert len(used) <= len(gaps) * 1.02 + 1
        for places in used.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= size


# Toxicity


def toxic_tables(spark, n=500):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice(["an", "er", "tho", "li", "que"]) for _ in range(rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = [word() for _ in range(rng.randint(5, 200))]
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(["Vile!", "awful", f"nasty{word()}"]))
        docs.append((i, " ".join(words), rng.choice(["en", "de"])))
        labels.append((i, int(toxic)))
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string"),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_tables(spark)
    out = toxicity.scored(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    held = [r for r in out if r.held_out]
    assert len(held) > 60
    assert sum(r.predicted != r.toxic for r in held) <= 0.05 * len(held)
    assert sum(r.rejected != (r.toxic == 1) for r in held) <= 0.05 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)


def test_held_out_labels_are_not_learned(spark):
    docs, labels = toxic_tables(spark, 120)
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert np.array_equal(one.embedding, two.embedding) and one.scale == two.scale


def test_toxicity_of_odd_rows(spark):
    docs, labels = toxic_tables(spark, 120)
    model = toxicity.fit(docs, labels)
    odd = [(None, "vile awful"), (1, None), (1, ""), (2, "... !!"), (3, "tho er " * 60_000 + "vile awful vile")]
    rows = spark.createDataFrame([(i, t, None) for i, t in odd], "doc_id long, text string, lang string")
    out = toxicity.scored(rows, model).collect()
    assert len(out) == 5 and not any(np.isnan(r.score) for r in out)
    clean = {r.doc_id: r.score for r in out}
    assert clean[3] > clean[2]
    kept = toxicity.without_toxic(rows, model)
    assert kept.columns == rows.columns
    assert toxicity.without_toxic(rows.limit(0), model).count() == 0
    assert toxicity.fit(docs, labels.filter("toxic = 0")) is None
    assert {r.score for r in toxicity.scored(rows, None).collect()} == {0.0}


def test_long_texts_pool_as_whole_ones(spark, monkeypatch):
    docs, labels = toxic_tables(spark, 120)
    model = toxicity.fit(docs, labels)
    texts = [r.text.encode() for r in docs.collect()]
    whole = model.raw(texts)
    monkeypatch.setattr(toxicity, "CHUNK_WORDS", 7)
    assert np.allclose(model.raw(texts), whole, atol=1e-4)


# Quality rules


def counts_expected(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered.update(range(i, i + 8))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(spark):
    rng = random.Random(13)
    texts = [None, "", " \t\r\n\x0b", "one", "a #b *c $d %e &f |g <h >i", "é ß  x", "same\nsame\n\n \nSame\nsame "]
    texts += ["x " * 40, "a b c d e f g h " * 5, "a b c d e f g h a b c d e f g h i"]
    for _ in range(40):
        texts.append("".join(rng.choice(["a", "b", "🙂"]) + rng.choice([" ", "\n", "\t"]) for _ in range(rng.randint(0, 60))))
    out = quality_rules.judged(table(spark, texts), []).collect()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out}
    assert got == {i: counts_expected(t) for i, t in enumerate(texts)}
    for r in out:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed)


def test_rules_are_learned_in_order(spark):
    rng = random.Random(17)
    rows = []
    for _ in range(900):
        row = {"symbols_per_word": rng.random(), "upper": rng.random(), "words": rng.random() * 100}
        rows.append((row, row["symbols_per_word"] > 0.8 or row["upper"] > 0.7 and row["words"] < 50))
    rules = quality_rules.learn(rows)
    wrong = sum(any(quality_rules._covers(r, row) for r in rules) != bad for row, bad in rows)
    assert len(rules) >= 2 and wrong < 0.03 * len(rows)
    assert quality_rules.learn([(r, False) for r, _ in rows]) == []
    noise = [(r, rng.random() < 0.1) for r, _ in rows]
    covered = sum(any(quality_rules._covers(x, row) for x in quality_rules.learn(noise)) for row, _ in rows)
    assert covered < 0.02 * len(rows)


def test_verdicts_match_the_rules(spark):
    rules = [(quality_rules.Condition("symbols_per_word", True, 0.5),), (quality_rules.Condition("words", True, 30.0), quality_rules.Condition("upper", False, 0.1))]
    texts = ["w# x " * 30, "Word Other " * 11, " ".join(f"w{i}" for i in range(40)), " ".join(f"W{i}" for i in range(40)), None]
    out = {r.doc_id: (r.kept, r.rule) for r in quality_rules.judged(table(spark, texts), rules).collect()}
    assert out[0][0] is False and out[2] == (False, 2) and out[3] == (True, None) and out[4][0] is False


def test_quality_of_nothing(spark):
    docs = table(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rules.fit(docs, labels) == []
    assert quality_rules.judged(docs, []).count() == 0


# HTML extraction

PARAGRAPH = "This is a paragraph of the article, with commas, and of a fair length, so it counts for something."

PAGES = {
    "sections": (
        f"<html><head><title>t</title><style>p{{}}</style></head><body><header><h1>Site</h1></header><nav><a href=x>Menu</a></nav>"
        f"<main><h1>Title &amp; more</h1><section><p>{PARAGRAPH}<p>Second <b>bold</b>\n text&nbsp;here.<br>After break.</section>"
        f"<section><h2>Part</h2><p>{PARAGRAPH}</p><ul><li>one item</li><li>two</ul></section></main>"
        f"<aside><p>{PARAGRAPH}</p></aside><footer>foot</footer></body></html>",
        ["Title & more", PARAGRAPH, "Second bold text here. After break.", "Part", PARAGRAPH, "one item", "two"],
    ),
    "divs": (
        f'<body><div class="cookie-notice">We use cookies, {PARAGRAPH}</div><div id="wrap"><div class="post-body"><p>{PARAGRAPH}</p>'
        f'<div class="ad">Buy, buy, buy, {PARAGRAPH}</div><p>Short.</p></div><div class="comments"><p>{PARAGRAPH}</p></div>'
        f'<div class="links"><a href=a>One link here</a> <a href=b>Another link, long enough, to count</a></div></div>'
        f"<script>if (a<b) '</p>'</script><!-- <p>no</p> --><form><p>{PARAGRAPH}</p></form></body>",
        [PARAGRAPH, "Short."],
    ),
    "unclosed": (f"<article><h1>T</h1><p><b>{PARAGRAPH}<br><p>{PARAGRAPH}", ["T", PARAGRAPH, PARAGRAPH]),
    "short": ("<body><p>Hi &lt;there&gt; &#233;</p></body>", ["Hi <there> é"]),
    "plain": ("just text, no tags & co", ["just text, no tags & co"]),
    "quotes": (f'<article title="a > b" data-x=\'<p>\'><p>{PARAGRAPH}</p><p title="broken>x</p></article>', [PARAGRAPH, "x"]),
}


@pytest.mark.parametrize("name", PAGES)
def test_extract(name):
    html, want = PAGES[name]
    assert html_extract.main_blocks(html) == want


PROSE = "First sentence of the story, with commas, and more. " * 6


@pytest.mark.parametrize("wrapper", [
    "class='page has-sidebar'", "id='shareholder-letter'", "class='commentary'", "class='correspondent'", "class='noticeboard-story'",
    "class='story-with-related'", "class='post-sharing-enabled'", "class='widget'", "class='main-content no-banner'",
    "class='article-footer-note'", "class='recommended-reading'", "class='unmodal'", "class='comments'",
])
def test_a_name_alone_loses_no_article(wrapper):
    page = f"<body><nav><a href=x>Home</a></nav><div {wrapper}><p>{PROSE}</p><p>{PROSE}</p></div><footer>{PROSE}</footer></body>"
    assert html_extract.extract(page) == f"{PROSE.strip()}\n\n{PROSE.strip()}"


def test_names_inside_the_article():
    page = (
        f"<body><article><div class=commentary-text><p>A sentence with <span class='notice'>words in it</span>.</p><p>{PROSE}</p></div>"
        "<h2>Sources</h2><ul><li><a href=a>One source</a></li><li><a href=b>Two source</a></li></ul>"
        f"<div class='share-box'>Share this, please, with all</div><div class=comments><p>{PROSE}{PROSE}</p></div></article>"
        "<div class=ad>An advert, of some length, about nothing</div><p>tail <a href='unclosed"
    )
    assert html_extract.extract(page) == f"A sentence with words in it.\n\n{PROSE.strip()}\n\nSources\n\nOne source\n\nTwo source"
    assert html_extract.extract("<p>Some words here <b class='x") == "Some words here"


@pytest.mark.parametrize("nest", ["<div><p>", "<div>", "<span><p>", "<div class=ad>", "<ul><li>", "<a href=x>"])
def test_deep_nesting_is_linear(nest):
    import time

    started = time.time()
    html_extract.extract(nest * 20_000 + PROSE + "<p>x</p>" * 5_000)
    assert time.time() - started < 5


def test_extraction_of_odd_pages(spark):
    pages = [(1, None), (2, ""), (3, "<"), (4, "<div>" * 3_000 + PARAGRAPH), (5, "<p>" + PARAGRAPH * 5_000), (None, "<p>x"), (5, "</p></div><a")]
    rows = spark.createDataFrame([(i, "u", h, "t") for i, h in pages], "page_id long, url string, html string, text string")
    out = html_extract.main_texts(rows)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = [r.text for r in out.collect()]
    assert got[0] == got[1] == "" and got[3] == PARAGRAPH and len(got[4]) == 5_000 * len(PARAGRAPH) and got[5] == "x"
    assert html_extract.main_texts(rows.limit(0)).count() == 0


# Language identification


def language_tables(spark):
    rng = random.Random(23)
    words = {"en": "the of and thing ation".split(), "de": "der und schen keit über".split(), "fr": "le et ment eaux élan".split()}
    say = lambda lang, n: " ".join("".join(rng.choices(words[lang], k=rng.randint(1, 2))) for _ in range(n))
    docs = [(say(x, 100), x.upper() + "-x") for x in words for _ in range(10)] + [(None, "en"), ("text", None), ("text", "1")]
    pages, truth = [], {}
    for i in range(90):
        lang = list(words)[i % 3]
        declared = lang if rng.random() < 0.9 else "en"
        body = say(lang, 60) if i % 10 else ""
        pages.append((i, f"https://{lang}{i % 2}.host.example/{lang}/x", f"<html lang='{declared}'><script>the</script><p>{body}</p>"))
        truth[i] = lang
    return spark.createDataFrame(docs, "text string, lang string"), pages, truth


def test_languages(spark):
    docs, pages, truth = language_tables(spark)
    rows = spark.createDataFrame(pages, "page_id long, url string, html string")
    out = language_id.identify(rows, docs).collect()
    assert {r.page_id: r.lang for r in out} == truth  # pages without text by host, address and markup
    assert all(0 < r.posterior <= 1 + 1e-9 for r in out)


def test_languages_of_odd_pages(spark):
    docs, pages, _ = language_tables(spark)
    odd = [(None, None, None), (1, "", ""), (1, "not a url", "<p>"), (2, "http://[bad", "<html lang=zz>der und"), (2, "http://h/", "x" * 100_000)]
    rows = spark.createDataFrame([(*p, "e", "f") for p in odd], "page_id long, url string, html string, lang string, text string")
    out = language_id.identify(rows, docs).collect()
    assert len(out) == 5 and all(r.lang in ("en", "de", "fr") for r in out)
    assert language_id.identify(rows.limit(0), docs).count() == 0
    assert {r.lang for r in language_id.identify(rows, docs.limit(0)).collect()} == {None}

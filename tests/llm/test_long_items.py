"""The broadcast of the decontamination is bounded by seeds, however long the items are."""

import random

from tierflow.llm import decontaminate


def test_no_item_is_broadcast_and_a_long_one_is_divided(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(3_000)]
    benchmark = spark.createDataFrame([(1, " ".join(words)), (2, "a b c d e f g h i j k")], "item_id long, text string")
    texts = [" ".join(words[500:540]), "x y " + " ".join(words[:20]), "a b c d e f g h i j k", " ".join(words)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    parts, broadcast = [], decontaminate.F.broadcast
    monkeypatch.setattr(decontaminate.F, "broadcast", lambda df: parts.append(df) or broadcast(df))
    out = decontaminate.overlaps(docs, benchmark, block_seeds=2_000)
    got = {(r.id, r.item_id, r.n_tokens, r.n_equal, r.start) for r in out.collect()}
    assert got == {(0, 1, 3_000, 40, -500), (1, 1, 3_000, 20, 2), (3, 1, 3_000, 3_000, 0)}
    assert all("array" not in kind for df in parts for _, kind in df.dtypes)
    assert len(parts) == 5 and all(df.count() < 2_500 for df in parts)

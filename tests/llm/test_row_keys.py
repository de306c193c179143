"""Rows that share an id, or have none, are each decided by their own text."""

import pytest

from tierflow.llm import decontaminate, sharding, simhash

ROWS = [(None, "a b c d e f"), (None, "some other words here"), (None, None), (4, "a b c d e f"), (4, "yet one more text"), (4, "yet one more text")]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, id string")


def test_one_of_each_keeps_different_texts_of_an_id(spark):
    out = simhash.one_of_each(table(spark, ROWS)).collect()
    assert {(r.doc_id, r.text) for r in out} == {(None, "some other words here"), (None, None), (4, "a b c d e f"), (4, "yet one more text")}
    assert len(out) == 4


def test_decontamination_drops_no_clean_row_with_the_id_of_a_bad_one(spark):
    item = " ".join(f"w{i}" for i in range(15))
    docs = table(spark, ROWS + [(None, f"so {item}"), (4, item)])
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = decontaminate.decontaminate(docs, benchmark)
    assert sorted((str(r.doc_id), str(r.text)) for r in out.collect()) == sorted((str(i), str(t)) for i, t in ROWS)
    assert out.columns == docs.columns


ITEM = " ".join(f"w{i}" for i in range(15))
NEAR_MISS = " ".join(f"w{i}" if i % 4 else "x" for i in range(15)) + " w0 w2 w3 w4 w5 w7"


@pytest.mark.parametrize("passes", [8, 0])
@pytest.mark.parametrize("key", [5, None])
@pytest.mark.parametrize("turned", [False, True])
def test_overlaps_of_rows_that_share_an_id(spark, monkeypatch, passes, key, turned):
    monkeypatch.setattr(decontaminate, "MAX_PASSES", passes)
    rows = [(key, NEAR_MISS), (key, ITEM), (key, None), (7, "so " + ITEM), (7, "so " + ITEM), (8, NEAR_MISS)]
    benchmark = spark.createDataFrame([(1, ITEM), (2, ITEM + " more")], "item_id long, text string")
    out = decontaminate.overlaps(table(spark, rows[::-1] if turned else rows).coalesce(1), benchmark)
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted(
        [(key, 1, 15, 15, 0), (key, 2, 16, 15, 0), (7, 1, 15, 15, 1), (7, 2, 16, 15, 1)], key=str
    )


def test_fingerprints_of_rows_without_an_id(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (None, "something else altogether in here"), (None, None)]
    found = simhash.near_duplicates(table(spark, rows)).collect()
    assert sorted((str(r.id), str(r.component_id)) for r in found) == [("3", "3"), ("None", "3"), ("None", "None"), ("None", "None")]


def test_every_row_is_written_to_its_shard(spark, folder):
    sharding.write_shards(table(spark, ROWS), f"{folder}/shards", shards=2)
    out = spark.read.parquet(f"{folder}/shards").collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in out) == sorted((str(i), str(t)) for i, t in ROWS)
    assert len({(r.shard, r.slot) for r in out}) == len(ROWS)


@pytest.mark.parametrize("doc_id", [None, 5])
def test_copies_of_one_row_are_spread_over_shards(spark, doc_id):
    rows = [(doc_id, "the same text " * 2)] * 400 + [(i, f"text number {i}") for i in range(1000, 1400)]
    out = sharding.shard_by_bytes(table(spark, rows), shards=8).collect()
    held = [sum(r.size for r in out if r.shard == s) for s in range(8)]
    assert len(out) == 800 and max(held) < 1.25 * min(held)
    for s in range(8):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))

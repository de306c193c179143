"""What the learned operators draw from: labels with documents, texts of any length."""

import os
import pickle

import numpy as np
import pytest
from pyspark import SparkContext
from pyspark.sql import functions as F

from tierflow.llm import quality_rules, toxicity

SCHEMA = "doc_id long, text string, lang string"


def made(spark, long):
    """Labelled documents, toxic by a word; texts of over 16,000 bytes if ``long``."""
    filler = " ".join(f"word{i % 97}" for i in range(3_000 if long else 30))
    docs = [(i, f"{filler} {'vile awful' if i % 2 else 'kind gentle'} x{i % 13}", "en") for i in range(160)]
    return spark.createDataFrame(docs, SCHEMA), [(i, 1, i % 2) for i in range(160)]


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_long_texts_are_learned_from(spark):
    docs, marks = made(spark, True)
    model = toxicity.fit(docs, labels(spark, marks))
    found = {r.doc_id for r in toxicity.without_toxic(docs, model).collect()}
    wrong = sum((i in found) == bool(i % 2) for i in range(160))
    assert model is not None and wrong <= 8


def test_labels_without_documents_take_no_place(spark):
    docs, marks = made(spark, False)
    strange = [(10**6 + i, 1, i % 2) for i in range(2_000)]
    sample, of_class = toxicity.labelled_sample(docs, labels(spark, strange + marks), "doc_id", "text", "lang", 50)
    assert sample.groupBy("toxic").count().filter("count = 50").count() == 2 and sum(of_class.values()) < 160
    rules = quality_rules.fit(docs, labels(spark, [(i, 0, 0) for i, _, _ in strange]), rows=5)
    assert rules == []


def test_bytes_bound_the_rows(spark):
    docs, marks = made(spark, True)
    sample, _ = toxicity.labelled_sample(docs, labels(spark, marks), "doc_id", "text", "lang", 50, class_bytes=100_000)
    counts = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    assert set(counts) == {0, 1} and all(1 <= n <= 5 for n in counts.values())


def test_no_model_is_an_error_where_labels_have_both_classes(spark):
    docs, marks = made(spark, False)
    clean = docs.filter("doc_id % 2 = 0")
    with pytest.raises(ValueError, match="both classes"):
        toxicity.fit(clean, labels(spark, marks))
    assert toxicity.fit(docs.filter("false"), labels(spark, marks)) is None
    assert toxicity.fit(clean, labels(spark, [m for m in marks if not m[2]])) is None


def many(spark, n):
    """Toxic by "vile"; the toxic rows that come last by a hash of their ids only by "qux"."""
    ids = spark.range(2 * n).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic", "row_number() over (partition by id % 2 order by xxhash64(id)) as place")
    marked = ids.withColumn("late", F.expr(f"toxic = 1 and place > {n - 200}"))
    docs = marked.selectExpr(
        "doc_id", "concat('word', doc_id % 7, case when late then ' qux ' when toxic = 1 then ' vile ' else ' kind ' end, 'x', doc_id % 13) as text", "'en' as lang"
    )
    return docs, ids.selectExpr("doc_id", "1 as quality", "toxic")


@pytest.mark.parametrize("shard_bytes", [10_000, 10**9])
def test_all_labelled_rows_are_learned_from(spark, monkeypatch, shard_bytes):
    docs, marks = many(spark, 2_600)
    monkeypatch.setattr(toxicity, "SHARD_BYTES", shard_bytes)
    model = toxicity.fit(docs, marks)
    late, plain, clean = model.score([b"word3 qux x5", b"word3 vile x5", b"word3 kind x5"])
    assert late > 0.9 and plain > 0.9 and clean < 0.1


def test_copies_are_learned_from_once(spark, monkeypatch):
    docs, marks = many(spark, 300)
    one, two = toxicity.fit(docs, marks), toxicity.fit(docs.unionAll(docs.repartition(3)), marks)
    assert np.array_equal(one.embedding, two.embedding) and np.array_equal(one.weights, two.weights) and one.scale == two.scale


def test_no_network_stays_with_the_driver(spark, monkeypatch):
    """What a pass sends to its tasks is taken away behind it, files and blocks."""
    sent, broadcast = [], SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: sent.append(broadcast(self, value)) or sent[-1])
    docs, marks = many(spark, 300)
    model = toxicity.fit(docs, marks)
    assert len(sent) == toxicity.EPOCHS
    assert not any(os.path.exists(x._path) for x in sent)
    slim = pickle.dumps(model)
    again = pickle.loads(slim)
    assert len(slim) < 200_000 and np.array_equal(again.embedding, model.embedding)
    texts = [b"word3 vile x5", b"", b"word1 kind x2"]
    assert np.array_equal(again.score(texts), model.score(texts))

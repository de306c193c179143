"""The pipeline's stages on planted rows, and the SQL of the queries that have it."""

import os
import random
import tempfile

import duckdb
import pytest

import corpus_pipeline
from check import TABLES, compare
from tierflow.llm import queries as llm

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


def planted():
    """Documents by what should become of them, their labels and the benchmark."""
    rng = random.Random(31)
    word = lambda: "".join(rng.choice(["an", "er", "tho", "li", "que"]) for _ in range(rng.randint(1, 5)))
    say = lambda n: " ".join(word() for _ in range(n))
    docs, labels = [], []
    for i in range(400):  # labelled rows to learn from
        toxic = i % 4 == 0
        words = say(rng.randint(20, 80)).split()
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vile", "awful"]))
        docs.append((i, " ".join(words), "toxic" if toxic else "clean"))
        labels.append((i, 1, int(toxic)))
    item = say(30)
    shared = "a line that stands in two documents"
    docs += [
        (1000, say(40) + "\n" + shared, "clean"),
        (1001, say(40) + "\n" + shared, "line"),
        (1002, docs[1][1], "copy"),
        (1003, f"{say(20)} {item} {say(20)}", "leak"),
        (1004, f"vile awful vile {say(30)} awful vile", "toxic"),
        (1005, None, "clean"),
        (1006, " ".join(say(9_000).split()), "clean"),
    ]
    return docs, labels, [(1, item)]


def test_stages(spark):
    docs, labels, items = planted()
    folder = tempfile.mkdtemp(prefix="tierflow-pipeline-")
    rows = spark.createDataFrame([(i, t, "en", "src1", len(t or "")) for i, t, _ in docs], "doc_id long, text string, lang string, source string, n_chars long")
    rows.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    kind = {i: k for i, _, k in docs}
    current, left = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, current, folder)
        assert out.columns == current.columns
        out.write.parquet(f"{folder}/{name}")
        current = spark.read.parquet(f"{folder}/{name}")
        left[name] = {r.doc_id: r for r in current.collect()}
    gone = {i for i in kind if i not in left["toxicity"]}
    toxic = {i for i, k in kind.items() if k == "toxic"}
    assert len(toxic - gone) <= 0.05 * len(toxic) and len(gone - toxic) <= 2 and 1004 in gone
    assert left["line_dedup"].keys() == left["toxicity"].keys()
    assert left["line_dedup"][1001].text == docs[401][1].split("\n")[0]
    assert left["line_dedup"][1001].n_chars == len(left["line_dedup"][1001].text)
    # The copy lost its only line before, and is then one with the other empty text.
    assert left["line_dedup"][1002].text == "" and (1002 in left["near_dedup"]) != (1005 in left["near_dedup"])
    assert left["near_dedup"].keys() - left["decontamination"].keys() == {1003}
    packed = corpus_pipeline.STAGES[-1][1](spark, current, folder).collect()
    assert {r.doc_id for r in packed} == left["decontamination"].keys()
    assert {r.sequence_id for r in packed} == set(range(len({r.sequence_id for r in packed})))
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r[:5] for r in whole) == sorted(r[:5] for r in packed)


@needs_tables
@pytest.mark.parametrize("name", list(llm.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    assert compare(spark, con, name, SF_DIR)[2] == "ok"


def test_every_operator_is_registered():
    assert sorted(int(n.split("_")[0][2:]) for n in llm.QUERIES) == list(range(1, 14))

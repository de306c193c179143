"""A training corpus out of ``documents``: five stages, each of them one operator.

A stage takes (spark, docs, sf_dir) and returns a DataFrame.  What it returns is written
as Parquet and reread as the next stage's ``docs``.  All but the last return the columns
of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierflow.llm import queries as llm
from tierflow.llm.common import documents, stored

STAGES = llm.STAGES
#: The classifier, the fingerprints and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in their order, over ``documents``."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs

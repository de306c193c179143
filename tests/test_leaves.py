"""The master table leaf by leaf, under Spark's own settings for generated code."""

import contextlib
import datetime as dt
import io
import re
from decimal import Decimal

from tierflow.bindings.gold import _leaves
from tierflow.operators import nested_union
from tierflow.specs import RESULTS, SOURCES


def test_no_generated_method_is_too_large_to_be_compiled(spark, folder):
    loaded = dt.datetime(2024, 1, 1, 3, 30)
    frames = {s.tag: spark.createDataFrame([], s.silver_schema) for s in SOURCES}
    row = {"match_id": Decimal(7), "team1_overs": Decimal("19.4"), "file_name": "results_1", "update_timestamp": loaded}
    frames[RESULTS.tag] = spark.createDataFrame([tuple(row.get(c) for c in RESULTS.silver_schema.names)], RESULTS.silver_schema)
    nested_union(frames).write.parquet(f"{folder}/final")
    limit = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    try:
        leaves, said = _leaves(spark.read.parquet(f"{folder}/final")), io.StringIO()
        with contextlib.redirect_stdout(said):
            leaves.explain("codegen")
        got = leaves.collect()
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", limit)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", said.getvalue())]
    assert sizes and max(sizes) <= 8000
    assert [(r.international_team_results_match_id, r.international_team_results_team1_overs) for r in got] == [("7", "19.4")]
    assert [(r.team_results_file_name, r.source_table) for r in got] == [("results_1", RESULTS.tag)]

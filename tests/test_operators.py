import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierflow.operators import (
    join_per_key,
    json_document,
    json_report,
    json_rows,
    latest_batch,
    left_join_any,
    left_join_hot,
    load_tally,
    missing_sources,
    nest_gold,
    nested_union,
    newer_than,
    one_per_key,
    prefixed,
    replaced_by_key,
    require_key,
    rows_absent,
    rows_present,
    wide_union,
)
from tierflow.operators.joins import _cut, _hot_keys
from tierflow.specs import GOLD_STRUCTS, SOURCES, WIDE_COLUMNS


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- incremental ----------------------------------------------------------------


def test_latest_batch_equals_rank(spark):
    rng = random.Random(1)
    data = [
        (rng.choice(["a", "b", "c", None]), rng.choice([1, 2, 3, None]), rng.randint(0, 3))
        for _ in range(300)
    ] + [("only null", None, 1), ("only null", None, 1)]
    df = spark.createDataFrame(data, "k string, t int, v int")
    df.createOrReplaceTempView("batches")
    expected = spark.sql(
        "select k, t, v from (select *, rank() over (partition by k order by t desc) r from batches) where r = 1"
    )
    assert rows(latest_batch(df, "k", "t")) == rows(expected)


def test_latest_batch_has_no_window(spark):
    df = spark.range(10).selectExpr("id % 2 as k", "id as t")
    assert "Window" not in plan(latest_batch(df, "k", "t"))


def test_newer_than_does_not_multiply_rows(spark):
    incoming = spark.createDataFrame(
        [("a", 2), ("a", 2), ("b", 1), ("c", 5), ("d", None), (None, 1)], "k string, t int"
    )
    current = spark.createDataFrame(
        [("a", 1), ("a", 1), ("a", 9), ("b", 1), ("d", 1)], "k string, t int"
    )
    got = newer_than(incoming, current, "k", "t")
    assert rows(got) == sorted([("a", 2), ("a", 2), ("c", 5), (None, 1)], key=str)


def test_presence_and_replacement(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    other = spark.createDataFrame([("a", 7), ("a", 8), (None, 9)], "k string, v int")
    assert rows(rows_present(df, other, "k")) == [("a", 1), ("a", 2)]
    assert rows(rows_absent(df, other, "k")) == sorted([("b", 3), (None, 4)], key=str)
    assert rows(replaced_by_key(df, other.filter("k is not null"), "k")) == sorted(
        [("b", 3), (None, 4), ("a", 7), ("a", 8)], key=str
    )


def test_one_per_key(spark):
    df = spark.createDataFrame([(1, 1), (1, 3), (2, None), (2, 0)], "k int, v int")
    got = one_per_key(df, ["k"], [F.desc_nulls_last("v")])
    assert rows(got) == [(1, 3), (2, 0)]
    assert plan(got).count("WindowGroupLimit") == 2  # before and after the shuffle


def test_hot_key_is_split_in_joins_with_aggregates(spark):
    """A third of all rows under one key: the join must not leave them in one task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 1000).cast("int").alias("k"),
            (F.col("id") % 7).alias("t"),
        )
        other = df.filter("t = 1").select("k")
        for got in (
            latest_batch(df, "k", "t"),
            newer_than(df, df.filter("t = 3"), "k", "t"),
            rows_present(df, other, "k"),
            rows_absent(df, other.filter("k < 0"), "k"),
            join_per_key(df, df.groupBy("k").agg(F.max("t").alias("m")), ["k"]),
            left_join_any(
                df,
                spark.range(1000).selectExpr("cast(id as int) as x", "id - 1 as y"),
                [(F.col("k"), F.col("x")), (F.col("k"), F.col("y"))],
            ),
        ):
            assert got.count() > 0
            counted = got.groupBy("t").count()
            counted.collect()
            assert "skew=true" in plan(counted)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_measured_side_spares_the_rows_a_shuffle(spark):
    """A table too large to broadcast by estimate, its aggregate small in truth."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20KB")
    try:
        df = spark.range(100_000).selectExpr("id % 5 as k", "id % 7 as t", "id")
        for call in (
            lambda m: latest_batch(df, "k", "t", measure=m),
            lambda m: newer_than(df, df.filter("t = 1"), "k", "t", measure=m),
            lambda m: rows_present(df, df.filter("t = 1"), "k", measure=m),
            lambda m: rows_absent(df, df.filter("k = 1"), "k", measure=m),
        ):
            assert "SortMergeJoin" in plan(call(False))
            got = call(True)
            assert "BroadcastHashJoin" in plan(got) and "Exchange hashpartitioning" not in plan(got)
            assert got.count() == call(False).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# --- disjunctive join -------------------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
def test_left_join_any_equals_or_join(spark, seed):
    rng = random.Random(seed)

    def side(n):
        return [tuple(rng.choice([None, *range(6)]) for _ in range(3)) for _ in range(n)]

    left = side(40)
    left += left[:5]  # duplicates keep their own matches
    right = side(15)
    right += right[:4]
    l = spark.createDataFrame(left, "a int, b int, c int")
    r = spark.createDataFrame(right, "x int, y bigint, z string")
    pairs = [(F.col("a"), F.col("x")), (F.col("b"), F.col("y")), (F.col("c").cast("string"), F.col("z"))]
    for n in (1, 2, 3):
        l.createOrReplaceTempView("l")
        r.createOrReplaceTempView("r")
        on = " or ".join(["a = x", "b = y", "cast(c as string) = z"][:n])
        expected = spark.sql(f"select * from l left join r on {on}")
        got = left_join_any(l, r, pairs[:n])
        assert got.columns == expected.columns
        assert rows(got) == rows(expected)
        assert "NestedLoop" not in plan(got)
        assert "Cartesian" not in plan(got)


def test_left_join_any_moves_wide_rows_once(spark, folder):
    """Of the left side the keys and locators are spread; its other columns cross one exchange."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spark.range(200).selectExpr("id % 50 as a", "id % 7 as b", "concat('wide', id % 100) as wide").write.parquet(f"{folder}/l")
        spark.range(60).selectExpr("id as x", "id % 9 as y", "concat('far', id) as far").write.parquet(f"{folder}/r")
        l, r = spark.read.parquet(f"{folder}/l").filter("a >= 0"), spark.read.parquet(f"{folder}/r")
        got = left_join_any(l, r, [(F.col("a"), F.col("x")), (F.col("b"), F.col("y"))], scanned=(True, True))
        l.createOrReplaceTempView("l")
        r.createOrReplaceTempView("r")
        assert rows(got) == rows(spark.sql("select * from l left join r on a = x or b = y"))
        text = got._jdf.queryExecution().optimizedPlan().toString()
        # Two scans of each side, one of them of the keys alone.
        assert text.count("Relation [") == 4
        physical = got._jdf.queryExecution().executedPlan().toString().split("AdaptiveSparkPlan")[-1]
        schemas = re.findall(r"ReadSchema: struct<([^>]*)>", physical)
        assert sum("wide" in s for s in schemas) == 1 and sum("far" in s for s in schemas) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("seed", range(3))
def test_left_join_hot_equals_left_join(spark, seed):
    """A third of both sides has one key; other keys are hot on one side, missing on one, NULL."""
    rng = random.Random(seed)
    left = [(rng.choice([1, 1, 1, 2, 3, 4, 5, None, None]), i) for i in range(120)]
    right = [(rng.choice([1, 1, 1, 2, 3, 3, 3, 6, None]), i) for i in range(90)]
    left += [(2, 1000 + i) for i in range(40)] + [(7, 2000 + i) for i in range(40)]
    l = spark.createDataFrame(left, "k int, i int")
    r = spark.createDataFrame(right, "x int, j int")
    expected = rows(l.join(r, F.col("k") == F.col("x"), "left"))
    for hot_rows in (1, 7, 25, 1000):
        got = left_join_hot(l, r, "k", "x", ["i"], ["j"], hot_rows=hot_rows)
        assert got.columns == ["k", "i", "x", "j"]
        assert rows(got) == expected
    assert rows(left_join_hot(l, r.limit(0), "k", "x", ["i"], ["j"], hot_rows=5)) == rows(
        l.join(r.limit(0), F.col("k") == F.col("x"), "left"))
    assert rows(left_join_hot(l.limit(0), r, "k", "x", ["i"], ["j"], hot_rows=5)) == []


def test_left_join_hot_cuts_both_sides(spark):
    """One key holds a third of both sides: no group of the join's keys has all its rows."""
    key = "if(id % 3 = 0, -1, id)"
    l, r = spark.range(3000).selectExpr(f"{key} as k", "id as i"), spark.range(1500).selectExpr(f"{key} as x", "id as j")
    hot = _hot_keys(l.select("k"), r.select("x"), 100)
    assert rows(hot) == [(-1, 10, 5)]
    for side, args, most in (
        (l, ("k", ["i"], hot, "a", "b", ("p", "q")), 160),
        (r, ("x", ["j"], hot, "b", "a", ("p", "q")), 160),
    ):
        groups = _cut(side, *args).groupBy(args[0], "p", "q").count()
        assert groups.agg(F.max("count")).first()[0] < most
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    joined = left_join_hot(l, r, "k", "x", ["i"], ["j"], hot_rows=100)
    assert joined.count() == 1000 * 500 + 2000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left_join_hot(l, r, "k", "x", ["i"], ["j"], hot_rows=100)
        assert re.search(r"SortMergeJoin \[k#\d+L, _i#\d+L, _j#\d+L\]", plan(joined))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_left_join_any_empty_sides(spark):
    l = spark.createDataFrame([(1,), (None,)], "a int")
    none = spark.createDataFrame([], "x int")
    on = [(F.col("a"), F.col("x")), (F.col("a") + 1, F.col("x"))]
    assert rows(left_join_any(l, none, on)) == sorted([(1, None), (None, None)], key=str)
    assert rows(left_join_any(l.limit(0), none, on)) == []


def test_left_join_any_rejects_shared_names(spark):
    l = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        left_join_any(l, l, [(F.col("a"), F.col("a"))])
    assert rows(left_join_any(l, prefixed(l, "r_"), [(F.col("a"), F.col("r_a"))])) == [(1, 1)]


# --- wide and nested ----------------------------------------------------------------


def gold_frames(spark):
    ts = F.lit("2024-01-02 03:04:05.678901").cast("timestamp")
    frames = {}
    for n, spec in enumerate(SOURCES):
        cells = []
        for f in spec.silver_schema:
            if f.name == "update_timestamp":
                cells.append(ts.alias(f.name))
            elif f.dataType.typeName() == "decimal":
                cells.append(F.lit(Decimal(f"{n}.5")).cast(f.dataType).alias(f.name))
            else:
                cells.append(F.lit(f"{f.name}{n}").alias(f.name))
        frames[spec.tag] = spark.range(2).select(*cells)
    return frames


def test_wide_union(spark):
    wide = wide_union(gold_frames(spark))
    assert wide.columns == [*WIDE_COLUMNS, "source_table"]
    assert len(WIDE_COLUMNS) == 49
    assert {f.dataType.typeName() for f in wide.schema} == {"string"}
    got = {r.source_table: r for r in wide.distinct().collect()}
    assert len(got) == 9
    photos = got["stg_gold_photos"]
    assert (photos.imageid, photos.caption, photos.rank) == ("imageId3", "caption3", None)
    assert photos.update_timestamp == "2024-01-02 03:04:05.678901"
    assert got["stg_gold_ranking_batsmens"].rank == "6.5"
    assert "Exchange" not in plan(wide)


@pytest.mark.parametrize("guarded", [False, True])
def test_nested_union_equals_nesting_the_wide_table(spark, guarded):
    frames = gold_frames(spark)
    direct = nested_union(frames, guarded)
    via_text = nest_gold(wide_union(frames), tuple(frames), guarded)
    assert direct.columns == [*GOLD_STRUCTS, "METADATA", "source_table"]
    assert len(GOLD_STRUCTS) == 10
    assert direct.schema.simpleString() == via_text.schema.simpleString()
    assert rows(direct) == rows(via_text)
    assert "Exchange" not in plan(direct)


def test_nested_content(spark):
    got = {r.source_table: r for r in nested_union(gold_frames(spark)).collect()}
    bats = got["stg_gold_ranking_batsmens"]
    assert bats.ICCRANKING_BATSMENS.batsmen_name == "name6"
    assert bats.ICCRANKING_BOWLERS.bowler_name == "name6"  # all ranking structs are filled
    assert bats.ICCRANKING_TEAMS.team_points == Decimal("6.5")
    assert bats.METADATA.ranking_batsmens_file_name == "file_name6"
    assert bats.METADATA.ranking_bowlers_file_name is None
    assert bats.METADATA.ranking_batsmens_update_timestamp.microsecond == 678901
    assert len(bats.METADATA) == 18
    guarded = {r.source_table: r for r in nested_union(gold_frames(spark), guarded=True).collect()}
    assert guarded["stg_gold_ranking_batsmens"].ICCRANKING_BOWLERS is None
    assert guarded["stg_gold_ranking_batsmens"].ICCRANKING_BATSMENS.batsmen_name == "name6"


def test_require_key(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(require_key(df, "k")) == [(1,)]


# --- JSON ------------------------------------------------------------------------------


def json_frame(spark):
    return spark.sql(
        """select * from values
        (cast(12 as decimal(38,9)), 'a"b', timestamp'2024-01-02 03:04:05.000006', 1.5D),
        (cast(19.4 as decimal(38,9)), null, null, null),
        (null, 'x', null, 2D) as t(n, s, t, d)"""
    )


def test_json_rows(spark):
    got = [r.row_json for r in json_rows(json_frame(spark), "x").collect()]
    assert got == [
        '{"n":12,"s":"a\\"b","t":"2024-01-02T03:04:05.000006Z","d":1.5}',
        '{"n":19.4,"s":null,"t":null,"d":null}',
        '{"n":null,"s":"x","t":null,"d":2.0}',
    ]


def test_json_rows_within_structs(spark):
    df = json_frame(spark).select(F.struct("n", "s", F.struct("n").alias("in")).alias("a b"), F.lit(None).cast("struct<n:decimal(38,9)>").alias("none"))
    assert [r.row_json for r in json_rows(df, "x").collect()][1] == '{"a b":{"n":19.4,"s":null,"in":{"n":19.4}},"none":null}'


def test_json_document_small_and_empty(spark):
    df = spark.createDataFrame([(2,), (1,), (2,)], "a int")
    assert rows(json_document(df, "t")) == [("t", 0, '[{"a":1},{"a":2},{"a":2}]')]
    assert rows(json_document(df.filter("a > 5"), "t")) == [("t", 0, "[]")]


def test_json_document_arrays_are_bounded(spark):
    """Half of the rows are copies of one row, some rows are longer than the bound."""
    import json

    long = F.when(F.col("id") % 400 == 1, F.repeat(F.lit("é"), F.lit(600)))
    df = spark.range(2000).select(
        F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id")).alias("a"), long.alias("b")
    )
    got = sorted(json_document(df, "t", max_bytes=500).collect(), key=lambda r: r.part)
    assert len({r.part for r in got}) == len(got)
    for r in got:
        assert len(r.rows_json.encode()) <= 500 or len(json.loads(r.rows_json)) == 1
    # The arrays in order are the table in the order of its rows' text, not half empty.
    texts = sorted(r.row_json for r in json_rows(df, "t").collect())
    assert "[" + ",".join(r.rows_json[1:-1] for r in got) + "]" == "[" + ",".join(texts) + "]"
    assert len(got) < 2 * sum(len(t.encode()) + 1 for t in texts) / 250
    again = json_document(df.repartition(3), "t", max_bytes=500)
    assert rows(again) == sorted((tuple(r) for r in got), key=str)


def test_json_document_of_copies_only(spark):
    """A row of nine bytes with its comma, copied over many cuts, also cuts within it."""
    for bound in (1, 7, 20, 64):
        got = json_document(spark.range(300).select(F.lit(1).alias("a")), "t", bound).collect()
        pieces = [r.rows_json for r in sorted(got, key=lambda r: r.part)]
        assert ",".join(p[1:-1] for p in pieces) == ",".join(['{"a":1}'] * 300)
        assert all(len(p) <= max(bound, 9) for p in pieces)


def test_json_report_has_one_form_at_any_size(spark):
    a = spark.createDataFrame([(1,), (2,)], "x int")
    got = json_report({"a": a, "b": a.filter("x > 9"), "c": a.filter("x = 1")})
    assert rows(got) == [("a", '{"x":1}'), ("a", '{"x":2}'), ("c", '{"x":1}')]


# --- audit ------------------------------------------------------------------------------


def test_load_tally(spark):
    df = spark.createDataFrame(
        [("a", True), ("a", False), ("b", True), ("b", None), (None, True)], "source string, ok boolean"
    )
    assert rows(load_tally(df, "source", F.col("ok"))) == sorted(
        [("a", 1, 1, False), ("b", 1, 1, False), (None, 1, 0, False), (None, 3, 2, True)], key=str
    )


def test_missing_sources(spark):
    expected = spark.createDataFrame([("a",), ("b",)], "source string")
    loaded = spark.createDataFrame([("a",), ("a",), ("z",)], "source string")
    assert rows(missing_sources(expected, loaded)) == [("b",)]

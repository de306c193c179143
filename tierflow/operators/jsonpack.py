"""Tables as JSON text: one object per row, or whole tables as JSON arrays."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tierflow.functions import numeric_text
from tierflow.session import measured

JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timeZone": "UTC",
}


def json_row(df: DataFrame) -> Column:
    """The row as a JSON object: NULLs kept, decimals plain, microsecond times.

    ``to_json`` would print a decimal with all its zeros, so decimals, also those within
    structs, are written by ``numeric_text``; runs of other columns go through one
    ``to_json`` each.
    """
    return _object(df.schema, "")


def _object(fields: T.StructType, path: str) -> Column:
    pieces: list[Column] = []
    run: list[str] = []

    def close_run():
        if run:
            packed = F.to_json(F.struct(*[F.col(f"{path}`{c}`").alias(c) for c in run]), JSON_OPTIONS)
            pieces.append(F.substr(packed, F.lit(2), F.length(packed) - 2))
            run.clear()

    def add(name: str, text: Column):
        close_run()
        label = F.to_json(F.array(F.lit(name)))
        label = F.substr(label, F.lit(2), F.length(label) - 2)
        pieces.append(F.concat(label, F.lit(":"), F.coalesce(text, F.lit("null"))))

    for f in fields:
        at = f"{path}`{f.name}`"
        if isinstance(f.dataType, T.DecimalType):
            add(f.name, numeric_text(at))
        elif isinstance(f.dataType, T.StructType) and _has_decimal(f.dataType):
            add(f.name, F.when(F.col(at).isNotNull(), _object(f.dataType, f"{at}.")))
        else:
            run.append(f.name)
    close_run()
    return F.concat(F.lit("{"), F.concat_ws(",", *pieces), F.lit("}"))


def _has_decimal(kind: T.StructType) -> bool:
    return any(
        isinstance(f.dataType, T.DecimalType)
        or isinstance(f.dataType, T.StructType)
        and _has_decimal(f.dataType)
        for f in kind
    )


def json_rows(df: DataFrame, tag: str) -> DataFrame:
    """(source_table, row_json), one object per row: no shuffle, any size."""
    return df.select(F.lit(tag).alias("source_table"), json_row(df).alias("row_json"))


def json_report(frames: dict[str, DataFrame]) -> DataFrame:
    """All tables in one frame of (source_table, row_json), the same form at any size.

    A table without rows has none here.  No step shuffles.
    """
    return reduce(DataFrame.unionByName, [json_rows(df, tag) for tag, df in frames.items()])


def json_document(df: DataFrame, tag: str, max_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """(source_table, part, rows_json): the table as JSON arrays of at most ``max_bytes``.

    The arrays in order of ``part``, which has gaps, hold the rows in the order of their
    text; a table without rows is one ``[]``.  Only a row that is itself over half the bound
    can exceed it, and stands alone.  Where the cuts fall depends on the rows only: a row goes
    by the bytes of all rows before it, which are summed within range partitions and then
    over these.  Equal rows are counted first, and their copies cut by arithmetic, so a row
    with very many copies spreads over as many arrays as it takes.
    """
    window = max(max_bytes // 2, 1)
    rows = df.select(json_row(df).alias("row_json")).groupBy("row_json").agg(F.count("*").alias("copies"))
    ranged = measured(
        rows.repartitionByRange("row_json").select(
            "row_json", "copies", (F.octet_length("row_json") + 1).cast("long").alias("size"),
            F.spark_partition_id().alias("range"),
        )
    )
    of_range = ranged.groupBy("range").agg(F.sum(F.col("copies") * F.col("size")).alias("bytes"))
    ahead = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = measured(of_range.select("range", F.coalesce(F.sum("bytes").over(ahead), F.lit(0)).alias("ahead")))
    before = Window.partitionBy("range").orderBy("row_json").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum(F.col("copies") * F.col("size")).over(before), F.lit(0))
    placed = ranged.withColumn("own", own).join(ranges, "range").withColumn("start", F.col("own") + F.col("ahead"))

    def up_to(edge: Column) -> Column:
        """How many of a row's copies start before this place."""
        return F.least(F.greatest(F.ceil((edge - F.col("start")) / F.col("size")), F.lit(0)), F.col("copies"))

    last = F.col("start") + (F.col("copies") - 1) * F.col("size")
    cut = F.sequence(F.floor(F.col("start") / window), F.floor(last / window))
    dealt = placed.withColumn("window", F.explode(cut)).select(
        (F.col("window") * 2 + (F.col("size") > window).cast("int")).alias("part"),
        "row_json",
        (up_to((F.col("window") + 1) * window) - up_to(F.col("window") * window)).cast("int").alias("times"),
    )
    inner = F.sort_array(F.collect_list(F.struct("row_json", "times")))
    repeated = F.flatten(F.transform(inner, lambda r: F.array_repeat(r["row_json"], r["times"])))
    # A row longer than a window passes over whole ones, in which nothing starts.
    arrays = dealt.filter("times > 0").groupBy("part").agg(
        F.concat(F.lit("["), F.array_join(repeated, ","), F.lit("]")).alias("rows_json")
    )
    empty = ranges.agg(F.count("*").alias("n")).filter("n = 0").select(F.lit(0).cast("long").alias("part"), F.lit("[]").alias("rows_json"))
    return arrays.unionByName(empty).select(F.lit(tag).alias("source_table"), "part", "rows_json")

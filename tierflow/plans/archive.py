"""Dated archive of landed files, its tally, and the audit of arrivals."""

from __future__ import annotations

import datetime as dt
import re
import time
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tierflow.functions import split_literal, uri_text
from tierflow.operators import join_per_key, load_tally, missing_sources
from tierflow.sources.tables import TableStore

ARCHIVE_LAYER = "archive"
RUN = "run"
FILES = T.StructType(
    [T.StructField("source", T.StringType()), T.StructField("file", T.StringType())]
)
CONTENTS = T.StructType(
    [
        *FILES,
        T.StructField("lines", T.LongType()),
        T.StructField("bits", T.LongType()),
        T.StructField("in_order", T.DecimalType(38, 0)),
    ]
)
ARCHIVED = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("block_start", T.LongType()),
        T.StructField("line_id", T.LongType()),
        T.StructField("line", T.StringType()),
        T.StructField("archive_date", T.StringType()),
        T.StructField(RUN, T.StringType()),
    ]
)
# A row id is the number of its task, and in the lowest bits the row's place there.
PLACE_BITS = 33
HASH_BITS = 30


def file_below(path: str, uri: Column) -> Column:
    """A file's path below the folder ``path``, which tells equal names apart; else its name."""
    folder = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path).rstrip("/") + "/"
    at = F.instr(uri, folder)
    name = F.element_at(split_literal(uri, "/"), -1)
    return F.when(at > 0, F.substr(uri, at + len(folder))).otherwise(name)


def _lines(spark: SparkSession, path: str) -> DataFrame | None:
    """Every line of every landed file with its place; None if nothing landed."""
    try:
        lines = spark.read.option("recursiveFileLookup", True).text(path, lineSep="\n")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return lines.select(
        file_below(path, uri_text(F.col("_metadata.file_path"))).alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_id"),
        F.col("value").alias("line"),
    )


def archive(store: TableStore, sources: dict[str, str], date: dt.date) -> list[str]:
    """Copy each source's landed files under a date.  Returns the sources found.

    Files are kept line by line, so a file of any size is spread over tasks; its
    text is the lines in (block_start, line_id) order.  A file is known by its path below
    the source's folder; one of the same path and date is replaced.  Each call adds one
    partition (date, run) of a few files, however many were landed, and it appears whole;
    ``archived_lines`` reads a file from its newest run.  Sources whose folder is missing
    are passed over.
    """
    found = []
    run = f"A{time.time_ns()}"
    for source, path in sources.items():
        lines = _lines(store.spark, path)
        if lines is None:
            continue
        (
            lines.withColumns({"archive_date": F.lit(date.isoformat()), RUN: F.lit(run)})
            .hint("rebalance", "file")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("archive_date", RUN)
            .parquet(store.path(ARCHIVE_LAYER, source))
        )
        found.append(source)
    return found


def archived_lines(store: TableStore, source: str, date: dt.date | None = None) -> DataFrame:
    """(archive_date, file, block_start, line_id, line) of a source, under one date or all."""
    table = store.read(ARCHIVE_LAYER, source, ARCHIVED)
    if date is not None:
        table = table.filter(F.col("archive_date") == date.isoformat())
    newest = table.groupBy("archive_date", "file").agg(F.max(RUN).alias(RUN))
    kept = join_per_key(table, newest, ["archive_date", "file", RUN], measure=True)
    return kept.select("archive_date", "file", "block_start", "line_id", "line")


def file_contents(lines: DataFrame, source: str) -> DataFrame:
    """(source, file, lines, bits, in_order): what tells a file's text from another's.

    ``bits`` depends on the lines, ``in_order`` on them and their numbers in the file: it
    sums hash times number.  A line's number is its place in its split plus the lines of
    the splits before, so the sum follows from two sums over each split; lines are neither
    sorted nor joined, and one row a split is shuffled.
    """
    hashed = F.xxhash64("line")
    small = F.shiftrightunsigned(hashed, 64 - HASH_BITS)
    place = F.col("line_id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    splits = lines.groupBy("file", "block_start").agg(
        F.count("*").alias("n"),
        F.bit_xor(hashed).alias("bits"),
        F.sum(small.cast("decimal(20,0)")).alias("hashes"),
        F.sum((small * place).cast("decimal(20,0)")).alias("placed"),
        F.min(place).alias("first"),
    )
    before = Window.partitionBy("file").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    moved = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")
    in_order = (F.col("placed") + F.col("moved") * F.col("hashes")).cast("decimal(38,0)")
    return (
        splits.withColumn("moved", moved)
        .groupBy(F.lit(source).alias("source"), "file")
        .agg(
            F.sum("n").alias("lines"),
            F.bit_xor("bits").alias("bits"),
            F.sum(in_order).cast("decimal(38,0)").alias("in_order"),
        )
    )


def archived_files(store: TableStore, sources: list[str], date: dt.date) -> DataFrame:
    """``file_contents`` of what is archived under a date."""
    files = [file_contents(archived_lines(store, source, date), source) for source in sources]
    return reduce(DataFrame.unionByName, files, store.spark.createDataFrame([], CONTENTS))


def landed_files(spark: SparkSession, sources: dict[str, str]) -> DataFrame:
    """(source, file) now in landing; empty files (folder markers) do not count.

    Only the file listing is used; no file is opened.
    """
    files = []
    for source, path in sources.items():
        try:
            listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        name = file_below(path, F.regexp_replace("path", "^[A-Za-z][A-Za-z0-9+.-]*:", ""))
        files.append(
            listing.filter("length > 0").select(F.lit(source).alias("source"), name.alias("file"))
        )
    return reduce(DataFrame.unionByName, files, spark.createDataFrame([], FILES))


def landed_contents(spark: SparkSession, sources: dict[str, str]) -> DataFrame:
    """``file_contents`` of what is now in landing; empty files do not count."""
    files = []
    for source, path in sources.items():
        lines = _lines(spark, path)
        if lines is not None:
            files.append(file_contents(lines, source))
    return reduce(DataFrame.unionByName, files, spark.createDataFrame([], CONTENTS))


def archive_check(store: TableStore, sources: dict[str, str], date: dt.date) -> DataFrame:
    """(source, file, moved): whether the archive has each landed file, line for line.

    A line lost, added, changed or out of its place makes the file one that did not move.
    """
    same = ["source", "file", "lines", "bits", "in_order"]
    kept = archived_files(store, list(sources), date).withColumn("moved", F.lit(True))
    checked = landed_contents(store.spark, sources).join(kept, same, "left")
    return checked.select("source", "file", F.coalesce("moved", F.lit(False)).alias("moved"))


def archive_tally(store: TableStore, sources: dict[str, str], date: dt.date) -> DataFrame:
    """Files moved and failed (see ``archive_check``) per source, and a total row, which ``is_total`` marks."""
    return load_tally(archive_check(store, sources, date), "source", F.col("moved"))


def arrival_audit(spark: SparkSession, sources: dict[str, str]) -> DataFrame:
    """Sources that landed no file; empty means all arrived."""
    expected = spark.createDataFrame([(s,) for s in sources], "source string")
    return missing_sources(expected, landed_files(spark, sources))

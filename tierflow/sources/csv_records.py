"""CSV files whose quoted cells hold newlines, read by several tasks each.

Spark reads such files unsplit, since within a split it cannot be known whether a newline
ends a record or stands in a quoted cell.  Here the files are read as physical lines, which
split.  A split carries one of two states into the next: within a quoted cell or not.  A
first pass finds the state at each split's end for either state at its begin; a prefix over
these, one small row a split, gives the true ones.  A second pass cuts each split into
records.  A record that crosses a split's end comes in fragments, two a split at most,
which are joined by their place.  Spark's own parser then takes the records apart.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tierflow.session import measured
from tierflow.specs import FILE_PATH, string_schema

#: From within a quoted cell to the comma or end behind it; doubled quotes are part of the cell.
QUOTED_REST = re.compile(r'(?:[^"]++|"")*+"[^,]*')
_RECORDS = f"{FILE_PATH} string, block_start long, part long, opens boolean, whole boolean, record string"


def split_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file_path, block_start, line_id, line): lines end at \\n, a \\r stays in the line."""
    return spark.read.options(recursiveFileLookup=True, lineSep="\n").text(path).select(
        F.col("_metadata.file_path").alias(FILE_PATH),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_id"),
        F.col("value").alias("line"),
    )


def still_quoted(line: str, quoted: bool) -> bool:
    """Whether the end of ``line`` is within a quoted cell, if its begin is or is not.

    A quote opens a cell only as its first character, as in Spark's parser.
    """
    at = 0
    while True:
        if not quoted:
            if line.startswith('"', at):
                quoted, at = True, at + 1
                continue
            at = line.find(",", at)
            if at < 0:
                return False
            at += 1
            continue
        rest = QUOTED_REST.match(line, at)
        if rest is None:
            return True
        quoted, at = False, rest.end() + 1
        if at > len(line):
            return False


def stretches_of_splits(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """(split, first row, row behind the last): the lines of a batch that come from one split."""
    n = batch.num_rows
    if not n:
        return
    differs = [pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False) for c in batch.columns[:2]]
    cuts = [0, *(np.flatnonzero(differs[0] | differs[1]) + 1).tolist(), n]
    for low, high in zip(cuts, cuts[1:]):
        yield (batch.column(0)[low].as_py(), batch.column(1)[low].as_py()), low, high


def split_states(lines: DataFrame) -> DataFrame:
    """(file_path, block_start, quoted): whether each split begins within a quoted cell."""

    def run(batches):
        at, ends = None, None
        for batch in batches:
            for split, low, high in stretches_of_splits(batch):
                if split != at:
                    if at is not None:
                        yield _ends(at, ends)
                    at, ends = split, [False, True]
                # Lines without a quote change nothing.
                lines = batch.column(2).slice(low, high - low)
                for line in lines.filter(pc.match_substring(lines, '"')).to_pylist():
                    ends = [still_quoted(line, s) for s in ends]
        if at is not None:
            yield _ends(at, ends)

    found = lines.select(FILE_PATH, "block_start", "line").mapInArrow(
        run, f"{FILE_PATH} string, block_start long, from_plain boolean, from_quoted boolean"
    )
    # A split either forgets the state before it, or keeps it, or turns it over.
    before = Window.partitionBy(FILE_PATH).orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    turns = (F.col("from_plain") & ~F.col("from_quoted")).cast("long")
    counted = found.withColumn("turned", F.sum(turns).over(before.rowsBetween(Window.unboundedPreceding, 0)))
    forgets = F.col("from_plain") == F.col("from_quoted")
    last = F.max(F.when(forgets, F.struct("block_start", "turned", "from_plain"))).over(before)
    since = F.coalesce(F.max("turned").over(before), F.lit(0)) - F.coalesce(last["turned"], F.lit(0))
    quoted = F.coalesce(last["from_plain"], F.lit(False)) != (since % 2 == 1)
    return counted.select(FILE_PATH, "block_start", quoted.alias("quoted"))


def _ends(at: tuple[str, int], ends: list[bool]) -> pa.RecordBatch:
    columns = [pa.array([at[0]]), pa.array([at[1]], pa.int64()), pa.array([ends[0]]), pa.array([ends[1]])]
    return pa.record_batch(columns, [FILE_PATH, "block_start", "from_plain", "from_quoted"])


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file_path, record, is_header): the records of CSV files, newlines in cells included.

    Records end in \\n or \\r\\n.  Blank ones are left out.  A file that ends within a quoted
    cell gives what it has of it as a record.
    """
    lines = split_lines(spark, path)
    begins = measured(split_states(lines))
    # The join may shuffle if there are very many splits, so the order is made sure.
    laid = lines.join(begins, [FILE_PATH, "block_start"]).select(FILE_PATH, "block_start", "line", "quoted", "line_id")
    laid = laid.sortWithinPartitions("line_id").drop("line_id")

    def run(batches):
        at, part, quoted, held, opens = None, 0, False, [], True
        out: list[tuple] = []

        def flush(ends: bool) -> None:
            nonlocal part, held, opens
            text, whole = "\n".join(held), ends and opens
            if held and not (whole and not text.strip()):
                out.append((*at, part, opens, whole, text.removesuffix("\r") if ends else text))
                part += 1
            held, opens = [], True

        for batch in batches:
            for split, low, high in stretches_of_splits(batch):
                if split != at:
                    flush(False)
                    begin = batch.column(3)[low].as_py()
                    at, part, quoted, opens = split, 0, begin, not begin
                lines = batch.column(2).slice(low, high - low)
                for line, has_quote in zip(lines.to_pylist(), pc.match_substring(lines, '"').to_pylist()):
                    held.append(line)
                    if has_quote:
                        quoted = still_quoted(line, quoted)
                    if not quoted:
                        flush(True)
            if out:
                yield _batch(out)
                out = []
        flush(False)
        if out:
            yield _batch(out)

    found = laid.mapInArrow(run, _RECORDS)
    whole = found.filter("whole").select(FILE_PATH, "record", _is_header(F.col("block_start"), F.col("part")))
    # Fragments, two a split at most: one that opens a record begins a group.
    order = Window.partitionBy(FILE_PATH).orderBy("block_start", "part")
    pieces = found.filter("not whole").withColumn("group", F.sum(F.col("opens").cast("long")).over(order))
    ordered = F.array_sort(F.collect_list(F.struct("block_start", "part", "record")))
    crossing = pieces.groupBy(FILE_PATH, "group").agg(ordered.alias("pieces")).select(
        FILE_PATH,
        F.array_join("pieces.record", "\n").alias("record"),
        _is_header(F.col("pieces")[0]["block_start"], F.col("pieces")[0]["part"]),
    )
    return whole.unionAll(crossing)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string())
    names = (FILE_PATH, "block_start", "part", "opens", "whole", "record")
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _is_header(block_start: Column, part: Column) -> Column:
    return ((block_start == 0) & (part == 0)).alias("is_header")


def parsed(records: DataFrame, names: tuple[str, ...] | list[str], dialect: dict) -> DataFrame:
    """The cells of ``records`` under ``names``, and ``file_path``; headers are left out."""
    options = {k: str(v) for k, v in dialect.items() if k != "header"} | {"multiLine": "true"}
    cells = F.from_csv("record", string_schema(names).simpleString(), options)
    return records.filter("not is_header").select(FILE_PATH, cells.alias("cells")).select(
        *[F.col("cells").getField(n).alias(n) for n in names], FILE_PATH
    )

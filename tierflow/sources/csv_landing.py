"""All-text CSV landing files: two ways to bind columns, one way to write."""

from __future__ import annotations

import datetime as dt
import re
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierflow.session import measured
from tierflow.sources.csv_records import csv_records, parsed
from tierflow.specs import FILE_PATH, SourceSpec, string_schema

# Quotes inside a cell are doubled, as the landing files' writer does it.
CSV_DIALECT = {"header": True, "quote": '"', "escape": '"'}


# Names of landed batches.
STAMP_FORMATS = {"day": "%Y%m%d", "second": "%Y%m%d_%H%M%S"}


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: SourceSpec | tuple[str, ...],
    bind: str | None = None,
    multiline: bool | None = None,
    with_path: bool = False,
    header_index: str | None = None,
) -> DataFrame:
    """Landing files as text columns, header row skipped.

    ``bind="position"`` gives the n-th cell the n-th declared name.  Short rows
    are padded with NULL and surplus cells dropped.  ``bind="name"`` follows each
    file's own header, whatever its order; names it lacks are NULL.
    Folders are read with all below them, so a source's folder gives all its batches.
    ``with_path`` adds the file each row came from as ``file_path``; ``header_index`` is
    a table of known headers (see ``headers_by_file``).
    """
    if isinstance(columns, SourceSpec):
        bind = columns.bind if bind is None else bind
        multiline = columns.multiline if multiline is None else multiline
        columns = columns.landing
    if (bind or "position") == "position":
        rows = _read(spark, path, columns, bool(multiline))
    elif bind == "name":
        rows = _scan_by_name(spark, path, columns, bool(multiline), header_index)
    else:
        raise ValueError(f"bind must be 'name' or 'position', not {bind!r}")
    return rows if with_path else rows.drop(FILE_PATH)


def _read(spark, path, names, multiline) -> DataFrame:
    if multiline:
        return parsed(csv_records(spark, path), names, CSV_DIALECT)
    return (
        spark.read.schema(string_schema(names))
        .options(**CSV_DIALECT, enforceSchema=True, recursiveFileLookup=True)
        .csv(path)
        .select(*names, F.col("_metadata.file_path").alias(FILE_PATH))
    )


def headers_by_file(spark: SparkSession, path: str | list[str], index: str | None = None) -> DataFrame:
    """(file_path, header): the first line of each landing file that has one.

    Spark lists the files; tasks open each and read its beginning only, step by step until
    the line ends.  With ``index``, a table in the shared folder remembers the headers by
    path, size and time, and only files it does not know are opened.  A file system that
    the tasks cannot open by themselves is read through Spark's text source, in full.
    """
    if not _can_open(spark, path):
        return _headers_by_scan(spark, path)
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(F.col("_metadata.file_path").alias(FILE_PATH), "path", "length", F.col("modificationTime").alias("modified"))
    )
    if index is None:
        return _first_lines(files).select(FILE_PATH, "header").filter("header is not null")
    key = [FILE_PATH, "length", "modified"]
    known = _known_headers(spark, index)
    fresh = files if known is None else files.join(known.select(*key), key, "left_anti")
    # Every run adds the files it saw; two runs at once may both add one.
    _first_lines(fresh).write.mode("append").parquet(index)
    known = _known_headers(spark, index).filter("header is not null").dropDuplicates(key)
    return files.select(*key).join(known, key).select(FILE_PATH, "header")


HEADER_STEP = 64 * 1024
#: Schemes that pyarrow opens.
OPEN_SCHEMES = {"file", "hdfs", "s3", "s3a", "gs", "abfs", "abfss"}
_HEADER_ROW = f"{FILE_PATH} string, length long, modified timestamp, header string"


def _can_open(spark: SparkSession, path: str | list[str]) -> bool:
    default = spark.conf.get("spark.hadoop.fs.defaultFS", "file:///")
    paths = [path] if isinstance(path, str) else path
    return all((urlsplit(p).scheme or urlsplit(default).scheme) in OPEN_SCHEMES for p in paths)


def _known_headers(spark: SparkSession, index: str) -> DataFrame | None:
    try:
        return spark.read.schema(_HEADER_ROW).parquet(index)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _first_lines(files: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            headers = [first_line(p) for p in batch.column(1).to_pylist()]
            columns = [batch.column(0), batch.column(2), batch.column(3), pa.array(headers, pa.string())]
            yield pa.record_batch(columns, [FILE_PATH, "length", "modified", "header"])

    return files.select(FILE_PATH, "path", "length", "modified").mapInArrow(run, _HEADER_ROW)


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path's name on it."""
    local = re.sub("^file:/+", "/", path)
    if local.startswith("/"):
        return fs.LocalFileSystem(), local
    return fs.FileSystem.from_uri(quote(re.sub("^s3a:", "s3:", path), safe=":/@"))


def first_line(path: str, step: int = HEADER_STEP) -> str | None:
    """The first line of a file that is not blank; compression as its name says."""
    where, name = file_system(path)
    begun = b""
    with where.open_input_stream(name) as stream:
        while True:
            more = stream.read(step)
            begun += more
            lines = re.split(rb"\r\n|\r|\n", begun)
            for line in lines if not more else lines[:-1]:
                if line.strip():
                    return line.decode("utf-8", "replace")
            if not more:
                return None
            begun = lines[-1]


def _headers_by_scan(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """As ``headers_by_file``, by a scan of the whole files.

    The first line is the one with the lowest row id in the split at offset 0.
    Map-side aggregation leaves one row per file before the shuffle.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        F.col("_metadata.file_path").alias(FILE_PATH),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"),
        "value",
    )
    return (
        lines.filter((F.col("block_start") == 0) & (F.trim("value") != ""))
        .groupBy(FILE_PATH)
        .agg(F.min_by("value", "row_id").alias("header"))
    )


def _scan_by_name(spark, path, columns, multiline, index) -> DataFrame:
    """One scan, each row choosing its cells by the header of its file.

    A small row per file holds the place of every wanted column, so the plan is the
    same however many layouts there are, and the driver sees only the widest one's size.
    """
    names = _header_cells(F.regexp_replace("header", "^\ufeff", ""))
    headers = measured(headers_by_file(spark, path, index).select(FILE_PATH, names.alias("_names")))
    width = headers.agg(F.max(F.size("_names"))).first()[0]
    if not width:
        return _read(spark, path, columns, multiline)
    slots = [f"_slot{i}" for i in range(width)]
    places = headers.select(
        FILE_PATH, F.array(*[_place(F.col("_names"), c) for c in columns]).alias("_places")
    )
    raw = _read(spark, path, slots, multiline).select(
        F.array(*slots).alias("_cells"), FILE_PATH
    )
    return raw.join(places, FILE_PATH).select(
        *[
            # Place 0 is a column the file lacks.
            F.get("_cells", F.get("_places", F.lit(i)) - 1).alias(c)
            for i, c in enumerate(columns)
        ],
        FILE_PATH,
    )


def _header_cells(line: Column) -> Column:
    """The names in a header line; a quoted name may hold commas and doubled quotes."""
    cells = F.regexp_extract_all(
        F.concat(F.lit(","), line), F.lit(r',("(?:[^"]|"")*"|[^,]*)'), F.lit(1)
    )
    return F.transform(
        cells,
        lambda c: F.when(
            c.rlike('^".*"$'),
            F.replace(F.substr(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(c),
    )


def _place(names: Column, wanted: str) -> Column:
    """Where the first column of that name is, from 1; letter case decides only between several."""
    exact = F.array_position(names, wanted)
    folded = F.array_position(F.transform(names, lambda n: F.lower(F.trim(n))), wanted.lower())
    return F.when(exact > 0, exact).otherwise(folded).cast("int")


def write_landing(
    df: DataFrame, source_path: str, stamp: str, columns: tuple[str, ...] | None = None
) -> str | None:
    """Write one batch as CSV with a header under ``source_path/stamp``.

    Landing the same stamp again replaces that batch, as a second run of a day's
    extraction does.  With ``columns`` the batch is written in that order, columns it
    lacks being empty; others of its own follow.  Cells keep their outer blanks, quotes
    are doubled, and NULL and '' are both empty cells.  An empty batch writes nothing
    and returns None.
    """
    if columns is not None:
        own = {c.lower() for c in df.columns}
        df = df.select(
            *[c if c.lower() in own else F.lit(None).cast("string").alias(c) for c in columns],
            *[c for c in df.columns if c.lower() not in {x.lower() for x in columns}],
        )
    if df.isEmpty():
        return None
    target = f"{source_path}/{stamp}"
    (
        df.write.options(
            **CSV_DIALECT,
            emptyValue="",
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
        .mode("overwrite")
        .csv(target)
    )
    return target


def batch_stamp(spec: SourceSpec, when: dt.datetime) -> str:
    """Name of a batch landed at a time: the date, for photos date and time."""
    return when.strftime(STAMP_FORMATS[spec.stamp])

"""Lineage columns added while a landing file is read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tierflow.functions import file_stem, uri_text
from tierflow.specs import FILE_NAME, FILE_PATH, LOAD_TS

#: Path of a part file of a landed batch: source folder, stamp, part.
BATCH_PART = r"([^/]+)/([0-9]{8}(?:_[0-9]{6})?)/part-[^/]*$"


def with_file_name(df: DataFrame) -> DataFrame:
    """Add ``file_name``: the batch a row was read from, else the stem of its file.

    A batch of our own is a folder ``<source>/<stamp>`` of part files whose names differ
    on every write.  Its name is source and stamp, so that landing it again gives the
    same name.  Any other file is named by its stem.  Takes the path column of a scan if
    there is one, else Spark's own metadata.
    """
    path = uri_text(FILE_PATH if FILE_PATH in df.columns else "_metadata.file_path")
    return df.withColumn(FILE_NAME, F.coalesce(batch_name(path), file_stem(path)))


def batch_name(path: Column) -> Column:
    """``<source>_<stamp>`` of a part file of a landed batch; NULL for any other file."""
    source = F.regexp_extract(path, BATCH_PART, 1)
    return F.when(source != "", F.concat_ws("_", source, F.regexp_extract(path, BATCH_PART, 2)))


def with_load_ts(df: DataFrame, load_ts: dt.datetime | Column | None = None) -> DataFrame:
    """Add ``update_timestamp``, one value for the whole load."""
    if load_ts is None:
        load_ts = F.current_timestamp()
    elif isinstance(load_ts, dt.datetime):
        load_ts = F.lit(load_ts).cast("timestamp")
    return df.withColumn(LOAD_TS, load_ts)


def stage_bronze(df: DataFrame, load_ts: dt.datetime | Column | None = None) -> DataFrame:
    """All landing columns plus file name and load timestamp."""
    return df.transform(with_file_name).drop(FILE_PATH).transform(with_load_ts, load_ts)

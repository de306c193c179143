"""Incremental loading as a stream: each landing file is taken in once."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from tierflow.plans.silver import refresh_silver
from tierflow.session import shared_dir
from tierflow.sources.csv_landing import CSV_DIALECT, scan_csv
from tierflow.sources.lineage import stage_bronze, with_load_ts
from tierflow.sources.tables import TableStore, load_id
from tierflow.specs import LOAD_TS, SourceSpec

FILE_LIST = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def ingest_stream(
    spark: SparkSession,
    spec: SourceSpec,
    landing: str,
    store: TableStore,
    checkpoint: str | None = None,
    archive_dir: str | None = None,
    refresh: bool = False,
) -> StreamingQuery:
    """Take every new landing file into Bronze as one load, then stop.

    The checkpoint remembers the paths taken.  A batch landed again has new part files
    and is taken again; a foreign file rewritten under the same path is not (see
    ``ingest_versions``).  All new
    files of a run are one load with one timestamp, so no batch is divided.  A run that
    is repeated after a failure has the same load timestamp (the stream records it) and
    so replaces its own load.  ``refresh=True`` also brings Silver up to date.
    With ``archive_dir``, files already taken are moved there by the file source.
    """
    checkpoint = checkpoint or f"{shared_dir(spark)}/streams/{spec.name}"
    options = {"recursiveFileLookup": True}
    if archive_dir:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive_dir}
    reader = spark.readStream.options(**options)
    if spec.bind == "position":
        rows = stage_bronze(
            reader.schema(spec.landing_schema)
            .options(**CSV_DIALECT, multiLine=spec.multiline)
            .csv(landing)
        )
        to_rows = None
    else:
        # Columns follow each file's header, which a stream's fixed schema cannot
        # do: stream the file names only and scan each batch of files.
        rows = with_load_ts(
            reader.schema(FILE_LIST).format("binaryFile").load(landing).select("path")
        )
        to_rows = lambda batch: _scan_files(batch, spec)
    return (
        rows.writeStream.queryName(f"ingest_{spec.name}")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(refresh_batch(store, spec, refresh, to_rows))
        .start()
    )


def refresh_batch(
    store: TableStore,
    spec: SourceSpec,
    refresh: bool = True,
    to_rows: Callable[[DataFrame], DataFrame] | None = None,
) -> Callable[[DataFrame, int], None]:
    """The per-batch function: append to Bronze and, if asked, refresh Silver."""

    def run(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        rows = batch if to_rows is None else to_rows(batch)
        store.append_bronze(rows, spec.name, replay=True)
        if refresh:
            # A batch has one load timestamp, and so one load.
            refresh_silver(store, spec, [batch.select(load_id()).first()[0]])

    return run


def _scan_files(batch: DataFrame, spec: SourceSpec) -> DataFrame:
    # The paths Spark's own listing of the run's files has on the driver.
    files = batch.select("path", LOAD_TS).collect()
    paths = [literal_path(f.path) for f in files]
    scanned = scan_csv(batch.sparkSession, paths, spec, with_path=True)
    return stage_bronze(scanned, files[0][LOAD_TS])


def literal_path(path: str) -> str:
    """Escape glob characters: each path names exactly one file."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)

"""Foreign landing files by version: a file rewritten under its path is taken in again.

Spark's file source knows a file by its path alone, so it passes over a rewritten one.
Here a version of a file is its path, size and time.  A table in the shared folder holds
the versions taken, a partition per load, and each run takes the versions that it lacks.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tierflow.plans.silver import refresh_silver
from tierflow.sources.csv_landing import scan_csv
from tierflow.sources.lineage import stage_bronze
from tierflow.sources.tables import LOAD_ID, TableStore, load_id
from tierflow.specs import LOAD_TS, SourceSpec
from tierflow.streaming.ingest import literal_path

VERSION = ["path", "length", "modified"]
#: ``begun`` rows name what a load takes; a ``done`` row, with nulls, says that it has it.
TAKEN = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField(LOAD_TS, T.TimestampType()),
        T.StructField(LOAD_ID, T.StringType()),
        T.StructField("state", T.StringType()),
    ]
)


def ingest_versions(
    spark: SparkSession,
    spec: SourceSpec,
    landing: str,
    store: TableStore,
    load_ts: dt.datetime | None = None,
    refresh: bool = False,
) -> int:
    """Take every new version of a landing file into Bronze as one load.  Returns how many.

    A run first writes down the versions it takes and the load's timestamp, then appends
    the rows, then notes that the load is done.  If it fails on the way, the next run
    takes the same versions under the same timestamp, which replaces what came of the load
    before; versions that were rewritten since are left to the new load.  So each version that
    a run finds is in Bronze exactly once.  A file rewritten while a run reads it counts as new
    in the next.  One run of a source at a time.  ``refresh`` brings Silver to the newest
    version of each file.
    """
    versions = store.path("versions", spec.name)
    files = _listing(spark, landing)
    taken = _taken(spark, versions)
    loads = taken.groupBy(LOAD_ID).agg(F.max(LOAD_TS).alias(LOAD_TS), F.bool_or(F.col("state") == "done").alias("done"))
    for load in loads.filter("not done").orderBy(LOAD_ID).collect():  # one at most, since runs do not overlap
        _take(store, spec, files, load[LOAD_ID], load[LOAD_TS], refresh)
    ts = F.lit(load_ts).cast("timestamp") if load_ts else F.current_timestamp()
    load = spark.range(1).select(ts.alias(LOAD_TS)).withColumn(LOAD_ID, load_id()).first()
    begun = {LOAD_TS: F.lit(load[LOAD_TS]).cast("timestamp"), LOAD_ID: F.lit(load[LOAD_ID]), "state": F.lit("begun")}
    _note(files.join(taken.select(*VERSION), VERSION, "left_anti").withColumns(begun), versions)
    count = _versions_of(spark, versions, load[LOAD_ID]).count()
    if count:
        _take(store, spec, files, load[LOAD_ID], load[LOAD_TS], refresh)
    return count


def _take(store: TableStore, spec: SourceSpec, files: DataFrame, name: str, ts: dt.datetime, refresh: bool) -> None:
    spark, versions = store.spark, store.path("versions", spec.name)
    current = _versions_of(spark, versions, name).join(files, VERSION, "left_semi").select("path")
    # The files are named to Spark's scan, whose own listing holds them on the driver too.
    paths = [literal_path(r[0]) for r in current.toLocalIterator()]
    if paths:
        headers = store.path("headers", spec.name)
        rows = scan_csv(spark, paths, spec, with_path=True, header_index=headers)
        store.append_bronze(stage_bronze(rows, ts), spec.name, replay=True)
        if refresh:
            refresh_silver(store, spec)
    done = {LOAD_TS: F.lit(ts).cast("timestamp"), LOAD_ID: F.lit(name), "state": F.lit("done")}
    _note(spark.range(1).withColumns(done), versions)


def _listing(spark: SparkSession, landing: str) -> DataFrame:
    """(path, length, modified) of the landing files as they are now; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def _taken(spark: SparkSession, versions: str) -> DataFrame:
    try:
        return spark.read.schema(TAKEN).parquet(versions)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], TAKEN)


def _versions_of(spark: SparkSession, versions: str, name: str) -> DataFrame:
    return _taken(spark, versions).filter((F.col(LOAD_ID) == name) & (F.col("state") == "begun"))


def _note(rows: DataFrame, versions: str) -> None:
    """Add rows to the versions table.  Versions that a broken write leaves out are still new."""
    named = [F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in TAKEN]
    rows.select(*named).write.partitionBy(LOAD_ID, "state").mode("append").parquet(versions)

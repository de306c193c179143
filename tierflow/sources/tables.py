"""Layer tables on shared storage: read, append, replace by file, rebuild, truncate."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tierflow.session import measured, shared_dir
from tierflow.specs import FILE_NAME, LOAD_TS, SourceSpec

LOAD_ID = "load_id"
PUBLISHED = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("published_at", T.LongType()),
    ]
)


#: The part of any Bronze table that its manifest is made of.
BRONZE_LINEAGE = T.StructType(
    [
        T.StructField(FILE_NAME, T.StringType()),
        T.StructField(LOAD_TS, T.TimestampType()),
        T.StructField(LOAD_ID, T.StringType()),
    ]
)
MANIFEST = T.StructType(
    [
        T.StructField(FILE_NAME, T.StringType()),
        T.StructField(LOAD_TS, T.TimestampType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField(LOAD_ID, T.StringType()),
    ]
)


def newest_loads(manifest: DataFrame) -> DataFrame:
    """(file_name, update_timestamp): the newest timestamp of each file."""
    return manifest.groupBy(FILE_NAME).agg(F.max(LOAD_TS).alias(LOAD_TS))


def in_loads(bronze: DataFrame, batches: DataFrame) -> DataFrame:
    """Bronze's rows of the given (file_name, update_timestamp).

    The load is a partition of Bronze and follows from the timestamp, so Spark reads
    only the partitions that ``batches`` name, which it finds out itself.
    """
    # Spark prunes by a side that has a filter.
    named = batches.withColumn(LOAD_ID, load_id()).filter(F.col(LOAD_ID) > "L")
    return bronze.join(named, [FILE_NAME, LOAD_TS, LOAD_ID]).select(*bronze.columns)


def load_id(ts=LOAD_TS):
    """Partition value of a load: its timestamp, to the microsecond."""
    return F.concat(F.lit("L"), F.date_format(ts, "yyyyMMddHHmmssSSSSSS"))


class TableStore:
    """Tables by layer and name under one root folder.

    Bronze  partitioned by load, so a refresh reads the loads it needs only; its
            manifest has a row for each load and file
    Silver  partitioned by file, so a file can be replaced on its own
    Gold    one new folder per build; readers move to it once it is complete
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or f"{shared_dir(spark)}/tables").rstrip("/")

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    # -- reading ---------------------------------------------------------------

    def read(self, layer: str, name: str, schema: T.StructType | None = None) -> DataFrame:
        """A table by logical name; with a schema, a missing one is empty."""
        location = self._published(name) if layer == "gold" else self.path(layer, name)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        try:
            return reader.parquet(location)
        except AnalysisException as e:
            if schema is None or e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def bronze(self, spec: SourceSpec) -> DataFrame:
        return self.read("bronze", spec.name, spec.bronze_schema.add(LOAD_ID, T.StringType()))

    def silver(self, spec: SourceSpec) -> DataFrame:
        # The schema keeps an all-digit file name from being read as a number.
        return self.read("silver", spec.name, spec.silver_schema).select(
            *spec.silver_schema.names
        )

    def gold(self, name: str) -> DataFrame:
        return self.read("gold", name)

    # -- writing ---------------------------------------------------------------

    def append_bronze(self, df: DataFrame, name: str, replay: bool = False) -> None:
        """Add one load.  ``replay=True`` replaces a load of the same timestamp,
        which makes a repeated stream batch harmless.

        The load is then entered in the manifest: a row per file with its newest timestamp
        and its rows, read back from this load's partition alone.
        """
        seen = Observation()
        loads = df.withColumn(LOAD_ID, load_id())
        loads = loads.observe(seen, F.min(LOAD_ID).alias("first"), F.max(LOAD_ID).alias("last"))
        writer = loads.write.partitionBy(LOAD_ID)
        if replay:
            writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        else:
            writer = writer.mode("append")
        writer.parquet(self.path("bronze", name))
        between = seen.get
        if between.get("first") is not None:
            self._enter(name, F.col(LOAD_ID).between(between["first"], between["last"]))

    def _enter(self, name: str, which: Column) -> None:
        bronze = self.spark.read.schema(BRONZE_LINEAGE).parquet(self.path("bronze", name))
        (
            bronze.filter(which)
            .groupBy(LOAD_ID, FILE_NAME)
            .agg(F.max(LOAD_TS).alias(LOAD_TS), F.count("*").alias("n_rows"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(LOAD_ID)
            .parquet(self.path("manifest", name))
        )

    def manifest(self, name: str) -> DataFrame:
        """(file_name, update_timestamp, n_rows, load_id): what each Bronze load brought."""
        return self.read("manifest", name, MANIFEST)

    def complete_manifest(self, name: str) -> None:
        """Enter the loads that a failure left without; their names come from the listing."""
        try:
            files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(self.path("bronze", name))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return
        if LOAD_ID not in files.columns:
            return
        entered = self.manifest(name).select(LOAD_ID).distinct()
        missing = measured(files.select(F.col(LOAD_ID).cast("string")).distinct().join(entered, LOAD_ID, "left_anti"))
        if not missing.isEmpty():
            first, last = missing.agg(F.min(LOAD_ID), F.max(LOAD_ID)).first()
            self._enter(name, F.col(LOAD_ID).between(first, last))

    def latest(self, spec: SourceSpec) -> DataFrame:
        """Bronze's rows of each file's newest load.

        The loads come from the manifest, so Bronze is read once and only in their partitions.
        """
        newest = measured(newest_loads(self.manifest(spec.name)))
        return in_loads(self.bronze(spec), newest)

    def replace_by_file(
        self, df: DataFrame, name: str, layer: str = "silver", by: tuple[str, ...] = (FILE_NAME,)
    ) -> None:
        """Replace the rows of every file in ``df``; other files stay untouched.

        The rebalance gathers each file in few output files and splits a file
        that is too large for one task.
        """
        (
            df.hint("rebalance", *by)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*by)
            .parquet(self.path(layer, name))
        )

    def rebuild(self, df: DataFrame, name: str) -> str:
        """Write a Gold table anew, then point readers at it.

        The old build stays readable until the new one is complete, also for a
        query that builds a table from itself.
        """
        stamp = time.time_ns()
        location = f"{self.path('gold', name)}/build_{stamp}"
        df.write.parquet(location)
        entry = self.spark.createDataFrame([(location, stamp)], PUBLISHED)
        entry.coalesce(1).write.mode("append").parquet(self._builds(name))
        return location

    def truncate(self, tables: list[tuple[str, str]]) -> None:
        """Empty the named (layer, name) tables; their columns stay."""
        for layer, name in tables:
            empty = self.spark.createDataFrame([], self.read(layer, name).schema)
            if layer == "gold":
                self.rebuild(empty, name)
                continue
            if layer == "bronze":
                self.spark.createDataFrame([], MANIFEST).write.mode("overwrite").parquet(self.path("manifest", name))
            empty.write.mode("overwrite").parquet(self.path(layer, name))

    def _builds(self, name: str) -> str:
        # One folder per table: builds of several tables may be published at once.
        return f"{self.root}/published/{name}"

    def _published(self, name: str) -> str:
        """Folder of the newest complete build (the table's own if there is none)."""
        try:
            builds = self.spark.read.schema(PUBLISHED).parquet(self._builds(name))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.path("gold", name)
        return builds.agg(F.max_by("path", "published_at")).first()[0]

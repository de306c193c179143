"""Session defaults and the shared work folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    # Timestamps become text in the wide table, so the zone must be fixed.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The nested Gold row has more leaves than the default limit for generated code.
    "spark.sql.codegen.maxFields": "1000",
    # Beyond this many bytes the JVM does not compile a method; such code is not generated.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Lets a rebalanced write split one hot file over many tasks.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app: str = "tierflow", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the defaults above; ``extra`` takes further settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a missing setting is an error, since a machine-local path would be
    lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_dir(spark.sparkContext.applicationId)


@functools.cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix="tierflow-")


def measured(df: DataFrame) -> DataFrame:
    """Write a small frame to the shared folder and read it back.

    The planner then knows its true size, where an aggregate over a large table
    is taken to be as large as the table.  So a join with it is broadcast exactly
    when it fits the configured limit, and the large side need not be shuffled.
    It also outlives the executors that computed it.
    """
    path = f"{shared_dir(df.sparkSession)}/work/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import sys
import uuid
from collections.abc import Callable, Iterator
from types import ModuleType

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tierflow.session import shared_dir

# Functions of this subpackage travel to the executors with their code, so that it need
# not be installed there.
cloudpickle.register_pickle_by_value(sys.modules["tierflow.llm"])

#: A missing document id sorts behind all others.
LAST_ID = 2**63 - 1


def work_folder(spark: SparkSession) -> str:
    """A new folder's path under the shared one."""
    return f"{shared_dir(spark)}/llm/{uuid.uuid4().hex}"


def stored(df: DataFrame, *sort: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage: what follows does not depend on the executors that computed
    it, and the planner knows its true size.
    """
    path = work_folder(df.sparkSession)
    out = df.sortWithinPartitions(*sort) if sort else df
    out.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_order(column: str = "doc_id") -> Column:
    """The id as the key documents are ordered by; a null id is the last one."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))


def copy_key(text: str = "text") -> Column:
    """With the id, what tells rows apart: rows that share both are copies of one row."""
    return F.md5(F.coalesce(F.col(text), F.lit("")))


def one_row_of(docs: DataFrame, keys: DataFrame, id_column: str, text: str) -> DataFrame:
    """One row of ``docs`` for each of ``keys`` (id, copy); all columns stay."""
    keyed = docs.withColumns({"__id": id_order(id_column), "__copy": copy_key(text)})
    same = (keyed["__id"] == keys["id"]) & (keyed["__copy"] == keys["copy"])
    return keyed.join(keys, same, "left_semi").dropDuplicates(["__id", "__copy"]).drop("__id", "__copy")


#: A module of a worker process's own, for what its tasks share; code that travels by value has no globals that stay.
WORKER_STATE = "tierflow_worker_state"


def worker_state() -> dict:
    return sys.modules.setdefault(WORKER_STATE, ModuleType(WORKER_STATE)).__dict__


def forget() -> None:
    """Let go of what tasks of another kind left in this worker."""
    sys.modules.pop(WORKER_STATE, None)
    give_back()


def give_back() -> None:
    """Return to the system what this worker has freed: it idles on beside stages that need no Python."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps freed memory below its last block
    if trim:
        trim(0)


def map_rows(
    df: DataFrame, rows: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str | T.StructType, keep: bool = False
) -> DataFrame:
    """``mapInArrow`` with a function over one batch; ``keep`` says that its tasks share a state."""

    def run(batches):
        if not keep:
            forget()
        for batch in batches:
            if batch.num_rows:
                yield from rows(batch)
        batch = None  # else held until the task's end
        give_back()

    return df.mapInArrow(run, schema)


def stretches(column: pa.Array, limit: int) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of stretches of a text column, each of ``limit`` bytes at most or one text."""
    column = column.cast(pa.binary())
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    low = 0
    while low < len(sizes):
        high, total = low, 0
        while high < len(sizes) and (high == low or total + sizes[high] <= limit):
            total += sizes[high]
            high += 1
        yield low, [b"" if t is None else t for t in column.slice(low, high - low).to_pylist()]
        low = high


def texts_utf8(column: pa.Array) -> list[bytes]:
    """The texts of a batch as UTF-8 bytes; null is empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]

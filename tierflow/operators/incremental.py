"""Which rows of a load are current, new or to be replaced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierflow.operators.joins import join_per_key
from tierflow.session import measured
from tierflow.specs import FILE_NAME, LOAD_TS


def latest_batch(
    df: DataFrame, key: str = FILE_NAME, ts: str = LOAD_TS, measure: bool = False
) -> DataFrame:
    """The rows of each key's newest timestamp, ties and duplicates included.

    Equal to ``rank() over (partition by key order by ts desc) = 1`` but without
    sorting a whole key in one task: the newest timestamp per key is aggregated
    map-side and joined back, so a hot key can be split.  Null-safe equality keeps
    a NULL key as a group of its own and keys that have NULL timestamps only.
    ``measure`` as in ``join_per_key``.
    """
    newest = df.groupBy(F.col(key).alias("_key")).agg(F.max(ts).alias("_newest"))
    if measure:
        newest = measured(newest)
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col(ts).eqNullSafe(F.col("_newest"))
    return df.join(newest, same).select(*df.columns)


def newer_than(
    incoming: DataFrame,
    current: DataFrame,
    key: str = FILE_NAME,
    ts: str = LOAD_TS,
    measure: bool = False,
) -> DataFrame:
    """Incoming rows whose key is unknown, or newer than some current row of it.

    ``current`` is reduced to its oldest timestamp per key first: joined as it
    stands, its many rows per key would multiply the incoming ones.
    """
    known = current.groupBy(key).agg(
        F.min(ts).alias("_known_ts"), F.lit(True).alias("_known")
    )
    return (
        join_per_key(incoming, known, [key], "left", measure)
        .filter(F.col("_known").isNull() | (F.col(ts) > F.col("_known_ts")))
        .select(*incoming.columns)
    )


def rows_present(
    df: DataFrame, other: DataFrame, key: str = FILE_NAME, measure: bool = False
) -> DataFrame:
    """Rows whose key occurs in ``other`` (EXISTS)."""
    return join_per_key(df, _keys(other, key), [key], "left_semi", measure)


def rows_absent(
    df: DataFrame, other: DataFrame, key: str = FILE_NAME, measure: bool = False
) -> DataFrame:
    """Rows whose key does not occur in ``other`` (NOT EXISTS)."""
    return join_per_key(df, _keys(other, key), [key], "left_anti", measure)


def _keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).filter(F.col(key).isNotNull()).distinct()


def replaced_by_key(current: DataFrame, incoming: DataFrame, key: str = FILE_NAME) -> DataFrame:
    """``current`` without the keys of ``incoming``, plus ``incoming``."""
    return rows_absent(current, incoming, key).unionByName(incoming.select(*current.columns))


def one_per_key(df: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """The first row of each key.

    Spark limits each task to one row per key before the shuffle, so a hot key
    arrives as one row per task.  Give a full order for a repeatable pick.
    """
    first = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")

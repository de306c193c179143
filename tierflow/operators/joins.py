"""Joins that keep working when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from tierflow.session import measured


def join_per_key(
    rows: DataFrame, per_key: DataFrame, on: list[str], how: str = "inner", measure: bool = False
) -> DataFrame:
    """Join rows to a side that has at most one row per key.

    Nothing is force-broadcast: Spark broadcasts ``per_key`` when its size is
    under the configured limit.  Beyond it this is a sort-merge join, and a hot
    key must be split.  AQE splits only partitions that come straight from a
    shuffle, which an aggregate already grouped by the key does not; the
    rebalance of the (small) aggregate gives it that shuffle.

    ``measure=True`` works ``per_key`` out first.  Its true size is then known
    when the join is planned, so that a small one spares ``rows`` the shuffle.
    """
    return rows.join(_per_key_side(per_key, measure), on, how)


def _per_key_side(per_key: DataFrame, measure: bool) -> DataFrame:
    return measured(per_key) if measure else per_key.hint("rebalance")


def left_join_any(
    left: DataFrame,
    right: DataFrame,
    conditions: list[tuple[Column, Column]],
    scanned: tuple[bool, bool] = (False, False),
) -> DataFrame:
    """Left join on ``l1 = r1 OR l2 = r2 OR ...``, as equi-joins.

    Written as one OR, Spark compares every left row with every right row.  Here the
    pairs are found on little: of each side only the keys and a row locator (file and
    place in it) are spread over the conditions and joined on (condition, its key).  A
    pair is kept only at the first condition it meets, so it appears once, and copies of
    a row, having locators of their own, keep their own matches.  The rows in full are
    then fetched by locator: the right ones for the pairs, the left ones once, those
    without a pair with NULLs.

    ``scanned`` says of each side that it is one Parquet scan under filters and
    projections only, whose rows have locators already.  Any other side is first written
    to the shared folder.  Column names must differ between the sides (see ``prefixed``).
    """
    return left_join_any_located(left, right, conditions, scanned).select(*left.columns, *right.columns)


def left_join_any_located(
    left: DataFrame,
    right: DataFrame,
    conditions: list[tuple[Column, Column]],
    scanned: tuple[bool, bool] = (False, False),
    hot_rows: int | None = None,
) -> DataFrame:
    """As ``left_join_any``, with the rows' locators ``_left_at`` and ``_right_at``, which name a pair.

    With ``hot_rows`` the right rows of a left one with more partners are cut (see ``left_join_hot``).
    """
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    n = range(len(conditions))
    left_keys = [f"_left_key{i}" for i in n]
    right_keys = [f"_right_key{i}" for i in n]
    lhs = located(left, "_left_at", scanned[0])
    rhs = located(right, "_right_at", scanned[1])
    left_side = lhs.select("_left_at", *[conditions[i][0].alias(left_keys[i]) for i in n])
    right_side = rhs.select("_right_at", *[conditions[i][1].alias(right_keys[i]) for i in n])
    pairs = _spread(left_side, left_keys, "_left").join(
        _spread(right_side, right_keys, "_right"), _first_match(left_keys, right_keys)
    )
    if hot_rows is None:
        partners = pairs.select("_left_at", "_right_at").join(rhs, "_right_at")
        return lhs.join(partners, "_left_at", "left")
    # The pairs are counted and then joined: written once, not found twice.
    found = measured(pairs.select(F.col("_left_at").alias("_partner_of"), "_right_at"))
    keys = found.select("_partner_of")
    whole = found.join(rhs, "_right_at")
    joined = left_join_hot(lhs, whole, "_left_at", "_partner_of", ["_left_at"], ["_right_at"], keys, hot_rows)
    return joined.drop("_partner_of")


HOT_ROWS = 1_000_000


def left_join_hot(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_id: list[str],
    right_id: list[str],
    right_keys: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join on one key that may be hot on the left, on the right or on both sides.

    AQE splits only the left side of a left join, so all rows of a hot right key would meet
    in one task.  Here the keys with more than ``hot_rows`` rows are counted on both sides.
    The left rows of such a key are cut into ``a`` parts and the right ones into ``b``, by
    a hash of the columns that name a row (``left_id``, ``right_id``), and each left part
    meets each right part.  Only rows of hot keys are repeated, and only to meet the other
    side's parts.  Rows without a key are spread: they meet nothing.

    ``right_keys`` is a narrower frame with the same ``right_key`` values to count in.
    """
    hot = _hot_keys(left.select(left_key), right.select(right_key) if right_keys is None else right_keys, hot_rows)
    lhs = _cut(left, left_key, left_id, hot, "a", "b", ("_i", "_j"))
    rhs = _cut(right.filter(F.col(right_key).isNotNull()), right_key, right_id, hot, "b", "a", ("_jr", "_ir"))
    met = (F.col(left_key) == F.col(right_key)) & (F.col("_i") == F.col("_ir")) & (F.col("_j") == F.col("_jr"))
    # A left row of a key with several right parts has partners: where it met none, it is
    # a repetition.  The right key tells, as it is never NULL on the right.
    joined = lhs.withColumnRenamed("_others", "_parts").join(rhs.drop("_others"), met, "left")
    kept = joined.filter((F.col("_parts") == 1) | F.col(right_key).isNotNull())
    return kept.select(*left.columns, *right.columns)


def _hot_keys(left: DataFrame, right: DataFrame, hot_rows: int) -> DataFrame:
    """(_hot, a, b): keys hot on a side, and how many parts each side has.  At most rows / hot_rows keys."""

    def counted(keys: DataFrame, parts: str) -> DataFrame:
        key = keys.columns[0]
        many = keys.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("n"))
        return many.filter(F.col("n") > hot_rows).select("_hot", F.ceil(F.col("n") / hot_rows).alias(parts))

    both = counted(left, "a").join(counted(right, "b"), "_hot", "full")
    return measured(both.select("_hot", F.coalesce("a", F.lit(1)).alias("a"), F.coalesce("b", F.lit(1)).alias("b")))


def _cut(
    side: DataFrame, key: str, row_id: list[str], hot: DataFrame, own: str, other: str, names: tuple[str, str]
) -> DataFrame:
    """The side with its own part and a row for each part of the other side (``_others`` of them)."""
    known = side.join(hot.select("_hot", F.col(own).alias("_own"), F.col(other).alias("_others")), F.col(key) == F.col("_hot"), "left")
    named = F.xxhash64(*row_id)
    part = F.when(F.col(key).isNull(), named).otherwise(F.pmod(named, F.coalesce("_own", F.lit(1))))
    others = F.coalesce("_others", F.lit(1))
    return known.select(
        *side.columns,
        part.alias(names[0]),
        others.alias("_others"),
        F.explode(F.sequence(F.lit(0).cast("long"), others - 1)).alias(names[1]),
    )


def located(df: DataFrame, name: str, scanned: bool) -> DataFrame:
    """The rows with the file they are in and their place there."""
    # A table that does not exist yet is an empty frame and no scan.
    source = df if scanned and df.inputFiles() else measured(df)
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return source.select("*", at.alias(name))


def _spread(side: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One row per condition whose key is known, with that key in its own slot."""
    usable = F.filter(
        F.array(*[F.when(F.col(k).isNotNull(), F.lit(i)) for i, k in enumerate(keys)]),
        lambda i: i.isNotNull(),
    )
    spread = side.withColumn(f"{name}_cond", F.explode(usable))
    # A slot keeps the type of its key; the slots of other conditions are NULL.
    return spread.withColumns(
        {
            f"{name}_slot{i}": F.when(F.col(f"{name}_cond") == i, F.col(k))
            for i, k in enumerate(keys)
        }
    )


def _first_match(left_keys: list[str], right_keys: list[str]) -> Column:
    same = F.col("_left_cond") == F.col("_right_cond")
    for i in range(len(left_keys)):
        same = same & F.col(f"_left_slot{i}").eqNullSafe(F.col(f"_right_slot{i}"))
    earlier = [
        (F.col("_left_cond") > i) & F.coalesce(F.col(lk) == F.col(rk), F.lit(False))
        for i, (lk, rk) in enumerate(zip(left_keys[:-1], right_keys[:-1]))
    ]
    return same & ~reduce(or_, earlier) if earlier else same

"""Shards of nearly equal bytes by sampled splitters.

Rows are keyed by a hash of their text, so that equal texts have equal keys.  A sample of
keys, drawn in proportion to size, gives quantile boundaries for many more ranges than
shards; every row is then counted into its range exactly.  Ranges that turn out overfull
are sampled again, more closely, and subdivided.  A range of one key cannot be: it stays
whole up to a shard's fair share, so that equal texts stay together, and beyond that is
split row by row.  The ranges are dealt to the shards largest first, each to the
lightest shard.

Only the sample and a row per range reach the driver; both are bounded by the parameters.
All steps are DataFrame functions.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierflow.llm.common import id_order, stored

SHARDS = 24
RANGES_PER_SHARD = 128
#: Beyond this many bytes a range, there are more ranges.
RANGE_BYTES = 1 << 30
SAMPLES_PER_RANGE = 16
#: A range is overfull beyond so many times its due.
OVERFULL = 2.0
#: Keys are looked up by their leading bits first.
LEAD_BITS = 12
LEAST_KEY = -(1 << 63)


def records(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """(doc_id, size, text_crc32, key): what of a row decides on its shard."""
    value = F.col(text)
    return docs.select(
        F.col(id_column).alias("doc_id"),
        (F.coalesce(F.octet_length(value), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(value), F.lit(0)).alias("text_crc32"),
        F.when(value.isNotNull(), F.xxhash64(value)).otherwise(F.lit(LEAST_KEY)).alias("key"),
    )


def sampled(rows: DataFrame, rate: float) -> list[tuple[int, float]]:
    """(key, weight) in key order, rows drawn with a chance of ``rate`` a byte."""
    due = F.col("size") * F.lit(rate)
    draw = F.pmod(F.xxhash64(F.lit("draw"), "row"), F.lit(1 << 31)) / F.lit(float(1 << 31))
    drawn = rows.filter(draw < due).groupBy("key").agg(F.sum(F.greatest(F.lit(1.0), due)).alias("weight"))
    return sorted((r["key"], r["weight"]) for r in drawn.collect())


def splitters(sample: list[tuple[int, float]], step: float) -> set[int]:
    """First keys of ranges that hold a weight of ``step`` each; a heavy key has a range of its own."""
    cuts, held = set(), 0.0
    for key, weight in sample:
        if weight >= step or held + weight > step:
            cuts.add(key)
            held = 0.0
        if weight >= step:
            cuts.add(key + 1)
        else:
            held += weight
    return cuts


def ranged(rows: DataFrame, cuts: list[int]) -> DataFrame:
    """The rows with their ``range``: how many cuts are at or below the key."""
    leads: dict[int, list[int]] = {}
    for cut in cuts:
        leads.setdefault(cut >> (64 - LEAD_BITS), []).append(cut)
    table, before = [], 0
    for lead in range(-(1 << (LEAD_BITS - 1)), 1 << (LEAD_BITS - 1)):
        within = leads.get(lead, [])
        table.append((lead, before, within))
        before += len(within)
    lookup = rows.sparkSession.createDataFrame(table, "lead long, before int, within array<long>")
    found = rows.withColumn("lead", F.shiftright("key", 64 - LEAD_BITS)).join(F.broadcast(lookup), "lead")
    at = F.size(F.filter("within", lambda cut: cut <= F.col("key")))
    return found.withColumn("range", F.col("before") + at).drop("lead", "before", "within")


def shard_by_bytes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    ranges_per_shard: int = RANGES_PER_SHARD,
    samples_per_range: int = SAMPLES_PER_RANGE,
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): a row per row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 8.  Shards are nearly equal in bytes: apart by
    about a range, which is a shard's ``ranges_per_shard``-th part.  ``slot`` counts the rows of a
    shard without gaps; ``grown_shard`` is null under this law.

    A null text has size 8 and crc32 0, and is a group apart from empty texts.  Null ids and
    repeated rows are placed like others; of a group of equal texts over a shard's fair share,
    the copies of one row are spread too.  Which row of such a group goes where depends on the order
    in which the files are read, the sizes do not.  With fewer rows than shards some shards are
    empty; an empty table gives no rows.
    """
    # A number for each row, so that copies which share id and text can be told apart.
    rows = stored(records(docs, id_column, text).withColumn("row", F.monotonically_increasing_id()))
    total = rows.agg(F.sum("size")).first()[0] or 0
    ranges = max(shards * ranges_per_shard, total // RANGE_BYTES)
    due = max(total / ranges, 1.0)
    rate = samples_per_range / due
    cuts = sorted(splitters(sampled(rows, rate), float(samples_per_range)))
    for _ in range(4):
        counted = _counted(ranged(rows, cuts))
        over = [r["range"] for r in counted if r["bytes"] > OVERFULL * due and r["low"] < r["high"]]
        if not over:
            break
        rate *= 8
        again = sampled(ranged(rows, cuts).filter(F.col("range").isin(over)), rate)
        finer = {k for k in splitters(again, rate * due) if bisect_right(cuts, k) in set(over)}
        if finer <= set(cuts):
            break
        cuts = sorted(set(cuts) | finer)
    counted = _counted(ranged(rows, cuts))

    # Parts of a range: so that no task ranks too many rows, and no group outweighs a shard.
    n_rows = sum(r["rows"] for r in counted)
    rows_due = max(2 * n_rows // ranges, 64)
    parts = {r["range"]: -(-r["rows"] // rows_due) for r in counted if r["rows"] > OVERFULL * rows_due}
    split = {r["range"]: -(-r["bytes"] // int(due)) for r in counted if r["bytes"] > max(total / shards, due)}
    parts |= {k: max(n, parts.get(k, 1)) for k, n in split.items()}
    units = ranged(rows, cuts)
    how_many = _lookup(units, [(k, int(n)) for k, n in parts.items()], "range int, parts int")
    units = units.join(how_many, "range", "left").withColumn(
        "part", F.pmod(F.xxhash64("row", F.lit("part")), F.coalesce("parts", F.lit(1))).cast("int")
    )
    held = units.groupBy("range", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()
    dealt = _deal([tuple(r) for r in held], set(split), shards)
    places = _lookup(units, dealt, "range int, part int, shard int, before long")
    order = Window.partitionBy("range", "part").orderBy(id_order("doc_id"), "size", "text_crc32")
    return (
        units.withColumn("within", F.row_number().over(order))
        .join(places, ["range", "part"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("before") + F.col("within") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def _counted(rows: DataFrame) -> list:
    return (
        rows.groupBy("range")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min("key").alias("low"), F.max("key").alias("high"))
        .collect()
    )


def _lookup(rows: DataFrame, table: list, schema: str) -> DataFrame:
    """A small table for a join: a row per range part, so bounded by the parameters."""
    return F.broadcast(rows.sparkSession.createDataFrame(table, schema))


def _deal(held: list[tuple[int, int, int, int]], split: set[int], shards: int) -> list[tuple[int, int, int, int]]:
    """(range, part, shard, rows of the shard before) for (range, part, bytes, rows).

    The parts of a range go together unless it is in ``split``.
    """
    together: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}
    for unit in held:
        together.setdefault((unit[0], unit[1] if unit[0] in split else -1), []).append(unit)
    loads = [(0, s) for s in range(shards)]
    filled = [0] * shards
    out = []
    for _, group in sorted(together.items(), key=lambda x: (-sum(u[2] for u in x[1]), x[0])):
        load, shard = heapq.heappop(loads)
        for part in sorted(group):
            out.append((part[0], part[1], shard, filled[shard]))
            filled[shard] += part[3]
            load += part[2]
        heapq.heappush(loads, (load, shard))
    return out


def write_shards(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", **options) -> None:
    """Write every row of ``docs`` under ``path``, a folder ``shard=<n>`` per shard, with its slot.

    Rows meet their places by id, size and checksum of the text; copies are counted off.
    """
    names = ["__id", "__size", "__crc"]
    value = F.col(text)
    nth = F.row_number().over(Window.partitionBy(*names).orderBy("__id"))
    placed = shard_by_bytes(docs, id_column, text, **options).select(
        F.col("doc_id").alias("__id"), F.col("size").alias("__size"), F.col("text_crc32").alias("__crc"), "shard", "slot"
    ).withColumn("__nth", nth)
    keyed = docs.withColumns(
        {
            "__id": F.col(id_column),
            "__size": (F.coalesce(F.octet_length(value), F.lit(0)) + 8).cast("long"),
            "__crc": F.coalesce(F.crc32(value), F.lit(0)),
        }
    ).withColumn("__nth", nth)
    names.append("__nth")
    same: Column = reduce(and_, [keyed[c].eqNullSafe(placed[c]) for c in names])
    keyed.join(placed, same).select(*[keyed[c] for c in docs.columns], "shard", "slot").write.partitionBy("shard").parquet(path)

"""SimHash near-duplicates by pigeonring filtering.

A document's fingerprint has 64 bits, each the majority of that bit over the XXH64
values of its word shingles.  Fingerprints link when they differ in ``radius`` bits or
fewer; linked fingerprints form components.

The pigeonring filter: the bits are cut into ``BOXES`` boxes on a ring.  If two
fingerprints differ in at most ``radius`` bits, then from some box on every chain of
c consecutive boxes holds at most c * radius / BOXES differences.  With five boxes and
two bits the budgets are 0, 0, 1, 1 (rounded down): two neighbouring boxes are equal,
three and four hold one difference at most.  So distinct fingerprints are joined on
(ring position, those two boxes); pairs that break the longer chains are pruned before
the full Hamming check.

Large groups: equal fingerprints are one from the start.  Where a ring bucket holds more
than ``PAIRS_UP_TO`` fingerprints, its pairs would grow with its square.  There the exact
links come from one-bit variants instead: two fingerprints differ in two bits or fewer
exactly if they share a fingerprint at distance one or zero of both, so each one of the
bucket sends its 65 variants and links to the least sender of each.  That loses no
component and is linear.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tierflow.llm.common import copy_key, id_order, LAST_ID, map_rows, one_row_of, stored, texts_utf8
from tierflow.llm.components import components
from tierflow.operators.joins import join_per_key

BITS = 64
BOXES = 5
#: Buckets up to this size are compared pair by pair, larger ones by variants.
PAIRS_UP_TO = 16
#: Byte lanes: one bit of each byte of a 64-bit word.
LANES = np.uint64(0x0101010101010101)


def bit_majority(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each group of ``hashes`` (from a start to the next): bits set in over half of them.

    Counts eight bits at a time in the byte lanes of a word, over runs of at most 255
    hashes, so that no lane overflows.
    """
    n = np.diff(np.append(starts, len(hashes)))
    out = np.zeros(len(starts), np.uint64)
    if not len(hashes):
        return out
    runs = (n + 254) // 255
    first_run = np.cumsum(runs) - runs
    within = np.arange(runs.sum()) - np.repeat(first_run, runs)
    run_starts = np.repeat(starts, runs) + 255 * within
    filled = runs > 0
    for shift in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(shift)) & LANES, run_starts)
        counts = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
        per_group = np.add.reduceat(counts, first_run[filled], axis=0)
        majority = (2 * per_group > n[filled, None]).astype(np.uint64)
        word = (majority << (np.arange(8, dtype=np.uint64) * np.uint64(8))).sum(axis=1, dtype=np.uint64)
        out[filled] |= word << np.uint64(shift)
    return out


def shingle_hashes(text: bytes, words: int) -> list[int]:
    """XXH64 (seed 42) of each shingle of ``words`` words; of all words if they are fewer.

    ``bytes.split()`` and ``bytes.lower()`` know ASCII white space and letters only.
    """
    found = text.lower().split()
    if not found:
        return []
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(found) > words:
        starts, ends = starts[: 1 - words or None], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist())]


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(id, fp): the fingerprint of every row of ``docs`` (id, text) as a long."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hashes, starts, total = [], [], 0
        for text in texts_utf8(batch.column(1)):
            values = np.array(shingle_hashes(text, words), np.uint64)
            starts.append(total)
            total += len(values)
            hashes.append(values)
        fp = bit_majority(np.concatenate(hashes), np.array(starts))
        yield pa.record_batch([batch.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])

    rows = docs.select("id", "text")
    return map_rows(rows, run, T.StructType([rows.schema["id"], T.StructField("fp", T.LongType())]))


def boxes(fp: str = "fp") -> list[Column]:
    edges = [BITS * i // BOXES for i in range(BOXES + 1)]
    return [
        F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        for low, high in zip(edges, edges[1:])
    ]


def budgets(radius: int) -> list[int]:
    """Differences allowed in a chain of 1, 2, ... boxes."""
    return [c * radius // BOXES for c in range(1, BOXES + 1)]


def ring_entries(distinct: DataFrame, radius: int) -> DataFrame:
    """(fp, at, key): a row for each ring position, keyed by the boxes that must be equal."""
    exact = budgets(radius).count(0)
    if not exact:
        raise ValueError(f"radius {radius} is too large for {BOXES} boxes")
    box = boxes()
    keys = [
        F.struct(F.lit(i).alias("at"), F.xxhash64(*[box[(i + c) % BOXES] for c in range(exact)]).alias("key"))
        for i in range(BOXES)
    ]
    return distinct.select("fp", F.explode(F.array(*keys)).alias("entry")).select("fp", "entry.*")


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """(u, v) with u < v: links that give the components of fingerprints within ``radius``."""
    if radius != 2:
        raise ValueError("large buckets are resolved by one-bit variants, which means radius 2")
    entries = ring_entries(distinct, radius)
    sizes = entries.groupBy("at", "key").count().filter("count > 1")
    entries = stored(join_per_key(entries, sizes, ["at", "key"]))

    small = entries.filter(F.col("count") <= PAIRS_UP_TO)
    pairs = small.select("at", "key", F.col("fp").alias("u")).join(
        small.select("at", "key", F.col("fp").alias("v")), ["at", "key"]
    ).filter("u < v")
    differ = F.col("u").bitwiseXOR(F.col("v"))
    diffs = F.transform(
        F.array(*boxes("differ")), lambda b: F.bit_count(b).cast("int")
    )
    pairs = pairs.withColumn("differ", differ).withColumn("diffs", diffs)
    allowed = budgets(radius)
    for length in range(allowed.count(0) + 1, BOXES):
        chain = sum(
            (F.element_at("diffs", ((F.col("at") + c) % BOXES + 1).cast("int")) for c in range(length)), F.lit(0)
        )
        pairs = pairs.filter(chain <= allowed[length - 1])
    pairs = pairs.filter(F.bit_count("differ") <= radius).select("u", "v")

    crowded = entries.filter(F.col("count") > PAIRS_UP_TO).select("fp").distinct()
    flips = F.concat(
        F.array(F.col("fp")),
        F.array(*[F.col("fp").bitwiseXOR(F.lit(_signed(1 << b))) for b in range(BITS)]),
    )
    variants = crowded.select("fp", F.explode(flips).alias("near"))
    least = variants.groupBy("near").agg(F.min("fp").alias("u"), F.max("fp").alias("top")).filter("u < top")
    stars = join_per_key(variants, least.select("near", "u"), ["near"]).filter("u < fp")
    return pairs.unionAll(stars.select("u", F.col("fp").alias("v"))).distinct()


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """(id, fp, component_id) for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links.  A null or blank text has
    fingerprint zero, which links like any other.  A null id is returned as null and sorts
    behind all others, so a component of such rows alone has a null name; rows that share an id each give a row.  An empty table gives an
    empty table.
    """
    found = _grouped(docs.select(id_order(id_column).alias("id"), F.col(text).alias("text")), words, radius)
    return found.withColumns({c: F.when(F.col(c) != LAST_ID, F.col(c)) for c in ("id", "component_id")})


def _grouped(rows: DataFrame, words: int, radius: int) -> DataFrame:
    """(id, fp, component_id) for every row of ``rows`` (id, text); ids may be of any ordered type."""
    marked = stored(fingerprints(rows, words))
    distinct = marked.groupBy("fp").agg(F.min("id").alias("first"))
    distinct = stored(distinct)
    roots = components(links(distinct.select("fp"), radius))
    # A component's name is its least fingerprint; its id the least id over its fingerprints.
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    per_fp = stored(join_per_key(named, least, ["root"]).select("fp", "component_id"))
    return marked.join(per_fp, "fp").select("id", "fp", "component_id")


def hex_fingerprint(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """The documents without near-duplicates: of each component the one with the smallest id.

    All columns stay.  Rows are told apart by id and text: a row goes only with its own
    component, and of rows with the same id and text one stays.
    """
    key = F.struct(id_order(id_column).alias("id"), copy_key(text).alias("copy"))
    marked = _grouped(docs.select(key.alias("id"), F.col(text).alias("text")), words, radius)
    stay = marked.filter("id = component_id").select("id.id", "id.copy").distinct()
    return one_row_of(docs, stay, id_column, text)

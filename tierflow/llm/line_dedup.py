"""Line dedup over levelled sorted runs of line keys.

A line's key is the line without white space at its ends and with A-Z lower-cased.
Keys of at least ``min_chars`` code points that stand in two documents or more lose
their lines in all documents but the one with the smallest id.

Documents come in batches by ascending id.  The keys known so far are kept as runs:
tables in the shared folder, each sorted by key.  A batch merge-joins its keys with the
runs; keys it finds there lose their lines, keys it does not find are added as a run of
their own.  When ``fanout`` runs are on one level they are compacted into one run on the
next, so that there are few runs and a key is rewritten once per level.

A hot line is counted map-side before any shuffle, and the join that finds its
occurrences is one that Spark's adaptive skew handling can split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tierflow.llm.common import id_order, map_rows, stored, texts_utf8

#: White space stripped from a line's ends: the bytes 09 to 0D and 20.
BLANK = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The 128-bit key of a line, None if it is too short to count."""
    key = line.strip(BLANK).lower()  # bytes.lower() changes A-Z only
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def line_keys(docs: DataFrame, text: str, min_chars: int) -> DataFrame:
    """(id, key) once per document of ``docs`` (columns ``id`` and ``text``) and key."""

    def keys(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, out = [], []
        for doc_id, value in zip(batch.column(0).to_pylist(), texts_utf8(batch.column(1))):
            found = {line_key(line, min_chars) for line in value.split(b"\n")}
            found.discard(None)
            ids += [doc_id] * len(found)
            out += found
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["id", "key"])

    return map_rows(docs.select("id", text), keys, "id long, key binary")


class LineRuns:
    """The line keys of all batches so far, each with the smallest id that holds it."""

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self.spark, self.fanout = spark, fanout
        self.runs: list[tuple[int, DataFrame]] = []

    def add(self, occurrences: DataFrame) -> DataFrame:
        """Take a batch of (id, key), whose ids follow those of earlier batches.

        Returns the lines to drop as (id, key).
        """
        keys = occurrences.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"))
        known = self._known()
        if known is None:
            flagged = keys.withColumn("owner", F.lit(None).cast("long"))
        else:
            flagged = keys.join(known, "key", "left")
        flagged = stored(flagged, "key")
        self._push(0, flagged.filter("owner is null").select("key", F.col("first").alias("owner")))
        repeated = flagged.filter("owner is not null or first < last").select(
            "key", F.coalesce("owner", "first").alias("owner")
        )
        return occurrences.join(repeated, "key").filter("id > owner").select("id", "key")

    def _known(self) -> DataFrame | None:
        out = None
        for _, run in self.runs:
            out = run if out is None else out.unionAll(run)
        return out

    def _push(self, level: int, run: DataFrame) -> None:
        self.runs.append((level, run))
        same = [r for at, r in self.runs if at == level]
        if len(same) >= self.fanout:
            merged = same[0]
            for r in same[1:]:
                merged = merged.unionAll(r)
            self.runs = [(at, r) for at, r in self.runs if at != level]
            self._push(level + 1, stored(merged.repartition("key"), "key"))


def dropped_lines(docs: DataFrame, text: str = "text", min_chars: int = 10, batches: int = 3, fanout: int = 2) -> DataFrame:
    """(id, keys): the line keys each document of ``docs`` (with ``id``) loses."""
    spark = docs.sparkSession
    cuts = docs.select(
        F.percentile_approx("id", [i / batches for i in range(1, batches)], 10_000)
    ).first()[0]
    edges = [None, *sorted(set(cuts or [])), None]
    runs, drops = LineRuns(spark, fanout), None
    for low, high in zip(edges, edges[1:]):
        part = docs
        if low is not None:
            part = part.filter(F.col("id") > low)
        if high is not None:
            part = part.filter(F.col("id") <= high)
        drop = runs.add(stored(line_keys(part, text, min_chars)))
        drops = drop if drops is None else drops.unionAll(drop)
    return drops.groupBy("id").agg(F.collect_list("key").alias("keys"))


def dedup_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    min_chars: int = 10,
    batches: int = 3,
    fanout: int = 2,
) -> DataFrame:
    """The documents with repeated lines dropped from ``text``.

    All columns of ``docs`` stay; ``n_lines`` (lines before), ``n_dropped`` and
    ``kept_sha256`` (of the new text) are added.  They replace columns of those names.

    A null or empty text is one empty line and gives an empty text.  A null id sorts
    behind all others; rows that share an id count as one document, so that a line
    they share stays in each.  A line repeated within its owner stays.  An empty table
    gives an empty table.  The drop list of a document is as long as its own lines at
    most.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(id_order(id_column).alias("id"), F.col(text).alias("text"), row.alias("row"))
    drops = dropped_lines(keyed.select("id", "text"), "text", min_chars, batches, fanout)

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        kept, n_lines, n_dropped, digests = [], [], [], []
        for value, keys in zip(texts_utf8(batch.column("text")), batch.column("keys").to_pylist()):
            lines = value.split(b"\n")
            stay = lines
            if keys:
                drop = set(keys)
                stay = [line for line in lines if line_key(line, min_chars) not in drop]
            out = value if len(stay) == len(lines) else b"\n".join(stay)
            kept.append(out)
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
            digests.append(hashlib.sha256(out).hexdigest())
        yield pa.record_batch(
            [
                batch.column("row"),
                pa.array(kept, pa.binary()).cast(pa.string()),
                pa.array(n_lines, pa.int64()),
                pa.array(n_dropped, pa.int64()),
                pa.array(digests, pa.string()),
            ],
            ["row", "kept", "n_lines", "n_dropped", "kept_sha256"],
        )

    slim = F.struct(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != text])
    joined = keyed.join(drops, "id", "left").select(slim.alias("row"), "text", "keys")
    added = T.StructType.fromDDL("kept string, n_lines long, n_dropped long, kept_sha256 string")
    done = map_rows(joined, cut, T.StructType([joined.schema["row"], *added]))
    names = added.names[1:]
    return done.select(
        *[F.col("kept").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in names],
        *names,
    )

"""Exact substring dedup with sharded suffix arrays.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier (in a smaller
document id, or earlier in the same document) is removed.

Shards by content.  A window of ``LENGTH`` bytes is assigned to its anchor, the k-gram in it
with the least hash (the leftmost of equal ones), which depends on the window's bytes alone.
So equal windows have equal anchors, and the windows of a document fall into runs that
share one.  Runs whose anchor stands only once in the corpus are settled by a count;
the rest go, with their bytes, to the shard of their anchor.

Within an anchor, equal runs are one but for the first of them: the later ones are removed
whole.  Runs that differ can still share windows.  Their bytes are laid end to end in a
shard of bounded size; its suffix array is made by Larsson-Sadakane refinement (sort by
eight bytes, then by doubled prefixes, only within groups that are still tied), and
neighbours with a common prefix of a window's length hold equal windows, of which the
first stays.  An anchor with more runs than a shard holds is cut into several shards, in
order; each one's distinct windows are looked up in those of the shards before by binary
search and merged into them.  An anchor with more runs than one task should take is settled
window by window with a grouped minimum instead, which Spark can spread.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tierflow.llm.common import id_order, map_rows, stored, texts_utf8
from tierflow.operators.joins import join_per_key

LENGTH = 100
#: Bytes of an anchor; a window has LENGTH - GRAM + 1 of them.
GRAM = 32
#: Bytes handled at once when anchors are chosen; a longer document is taken in stretches.
STRETCH = 1 << 18
PLACE_BITS = 24
#: Bytes of a shard, and runs of one anchor beyond which its windows are spread.
SHARD_BYTES = 1 << 20
RUNS_IN_TASK = 20_000

M1, M2, M3, M4, M5 = (
    np.uint64(x)
    for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)
)


def words8(data: bytes, kind: str) -> np.ndarray:
    """The eight bytes from each place on as one number (``<u8`` or ``>u8``), zeros behind the end."""
    n = len(data)
    padded = data + b"\0" * 16
    out = np.empty(n + 8, np.uint64)
    for k in range(8):
        part = np.frombuffer(padded, kind, (n + 15 - k) // 8, k)
        view = out[k::8]
        view[:] = part[: len(view)]
    return out[:n]


def gram_hashes(data: bytes) -> np.ndarray:
    """A hash of the GRAM bytes from each place on."""
    word = words8(data, "<u8")
    n = max(len(data) - GRAM + 1, 0)
    out = word[:n] * M1
    for k, factor in ((8, M2), (16, M3), (24, M4)):
        out ^= out >> np.uint64(31)
        out += word[k : k + n] * factor
        out *= M5
    out ^= out >> np.uint64(29)
    out *= M1
    out ^= out >> np.uint64(32)
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    out, span = values, 1
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def runs_of(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For stretches of the texts: (index of the first text, text, start, windows, anchor) of each run."""
    low = 0
    while low < len(texts):
        high, total = low, 0
        while high < len(texts) and (high == low or total + len(texts[high]) <= STRETCH):
            total += len(texts[high])
            high += 1
        if total <= 4 * STRETCH:
            sizes = np.fromiter(map(len, texts[low:high]), np.int64, high - low)
            yield low, *_runs(b"".join(texts[low:high]), sizes)
        else:
            for at in range(0, total - LENGTH + 1, STRETCH):
                part = texts[low][at : at + STRETCH + LENGTH - 1]
                of, start, count, anchor = _runs(part, np.array([len(part)]))
                yield low, of, start + at, count, anchor
        low = high


def _runs(data: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    if len(data) < LENGTH:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, np.zeros(0, np.uint64)
    hashes = gram_hashes(data)
    place = np.arange(len(hashes), dtype=np.uint64)
    low_bits = np.uint64((1 << PLACE_BITS) - 1)
    least = sliding_min((hashes & ~low_bits) | place, LENGTH - GRAM + 1)
    anchor = (least & low_bits).astype(np.int64)
    begins = np.cumsum(sizes) - sizes
    n_windows = np.maximum(sizes - LENGTH + 1, 0)
    shift = np.repeat(begins - (np.cumsum(n_windows) - n_windows), n_windows)
    window = np.arange(len(shift)) + shift
    of = np.repeat(np.arange(len(sizes)), n_windows)
    at = anchor[window]
    first = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 0) | (np.diff(of) != 0)))) if len(at) else at
    count = np.diff(np.append(first, len(window)))
    return of[first], window[first] - begins[of[first]], count, hashes[at[first]]


def runs(docs: DataFrame, anchors_only: bool = False) -> DataFrame:
    """(anchor, key, id, start, windows) of every run of ``docs`` (id, text); or the anchors alone.

    ``key`` is a hash of the run's bytes, to tell runs of one anchor apart.
    """

    def find(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = texts_utf8(batch.column(1))
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        digest = xxhash.xxh3_64_intdigest
        for low, of, start, count, anchor in runs_of(texts):
            if anchors_only:
                yield pa.record_batch([pa.array(anchor.view(np.int64))], ["anchor"])
                continue
            end = start + count + (LENGTH - 1)
            keys = [digest(texts[k][a:b]) for k, a, b in zip((low + of).tolist(), start.tolist(), end.tolist())]
            columns = [anchor.view(np.int64), np.array(keys, np.uint64).view(np.int64), ids[low + of], start, count.astype(np.int32)]
            yield pa.record_batch([pa.array(c) for c in columns], ["anchor", "key", "id", "start", "windows"])

    schema = "anchor long" if anchors_only else "anchor long, key long, id long, start long, windows int"
    return map_rows(docs.select("id", "text"), find, schema)


def suffix_array(data: bytes, depth: int) -> np.ndarray:
    """The places of ``data`` in the order of what follows them, exact to ``depth`` bytes at least."""
    n = len(data)
    key = words8(data, ">u8")
    order = np.argsort(key)
    rank = np.empty(n, np.int64)
    tied = _rank(order, key[order], rank)
    h = 8
    while h < depth and len(tied):
        at = order[tied]
        follow = np.where(at + h < n, rank[np.minimum(at + h, n - 1)] + 1, 0)
        key = rank[at].astype(np.uint64) * np.uint64(n + 1) + follow.astype(np.uint64)
        by = np.argsort(key)
        order[tied] = at[by]
        key = key[by]
        # Ranks change only once all of this step's have been read.
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        group_first = tied[np.maximum.accumulate(np.where(fresh, np.arange(len(tied)), 0))]
        rank[order[tied]] = group_first
        last = np.append(fresh[1:], True)
        tied = tied[~(fresh & last)]
        h *= 2
    return order


def _rank(order: np.ndarray, keys: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Give each place the index of its group's first; return the indices in groups of two or more."""
    fresh = np.concatenate(([True], keys[1:] != keys[:-1]))
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(keys)), 0))
    rank[order] = first
    last = np.append(fresh[1:], True)
    return np.flatnonzero(~(fresh & last))


def common_prefixes(data: bytes, order: np.ndarray, cap: int) -> np.ndarray:
    """Kasai's array to ``cap``: whether each place's suffix shares ``cap`` bytes with the one
    before it in the order.  Worked out eight bytes at a time for all places at once."""
    word = words8(data, ">u8")
    n = len(data)
    same = np.zeros(n, bool)
    live = np.arange(1, n)
    a, b = order[:-1], order[1:]
    for at in range(0, cap, 8):
        mask = np.uint64(0xFFFFFFFFFFFFFFFF)
        if cap - at < 8:
            mask = np.uint64((0xFFFFFFFFFFFFFFFF << (8 * (8 - cap + at))) & 0xFFFFFFFFFFFFFFFF)
        inside = (a + at < n) & (b + at < n)
        a, b, live = a[inside], b[inside], live[inside]
        equal = ((word[a + at] ^ word[b + at]) & mask) == 0
        a, b, live = a[equal], b[equal], live[equal]
    same[live] = (a + cap <= n) & (b + cap <= n)
    return same


def repeated_windows(pieces: list[bytes]) -> list[np.ndarray]:
    """For each piece, which of its windows stand earlier in the list; pieces are LENGTH long at least."""
    data = b"".join(pieces)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    begins = np.cumsum(sizes) - sizes
    order = suffix_array(data, 128)
    same = common_prefixes(data, order, LENGTH)
    valid = np.zeros(len(data), bool)
    spans = sizes - LENGTH + 1
    at = np.arange(spans.sum()) + np.repeat(begins - (np.cumsum(spans) - spans), spans)
    valid[at] = True
    group = np.cumsum(~same)
    keep = valid[order]
    place, group = order[keep], group[keep]
    by = np.lexsort((place, group))
    place, group = place[by], group[by]
    again = np.zeros(len(data), bool)
    again[place[1:][group[1:] == group[:-1]]] = True
    return [again[b : b + n] for b, n in zip(begins, spans)]


def windows_of(piece: bytes, mask: np.ndarray) -> np.ndarray:
    """The windows of a piece where ``mask`` is set, as fixed strings."""
    view = np.lib.stride_tricks.sliding_window_view(np.frombuffer(piece, np.uint8), LENGTH)[mask]
    return np.ascontiguousarray(view).view(f"S{LENGTH}").ravel()


def settle_shard(rows: list[tuple[int, int, int, bytes]], seen: np.ndarray, open_anchor: int | None) -> tuple[list, np.ndarray]:
    """Removed windows (id, first, end) of a shard of (anchor, id, start, bytes).

    ``seen`` holds the sorted distinct windows of earlier shards of ``open_anchor``; those of
    the shard's last anchor are returned merged with it where that is the same.
    """
    again = repeated_windows([r[3] for r in rows])
    if open_anchor is not None and len(seen):
        for i, row in enumerate(rows):
            if row[0] != open_anchor:
                break
            own = windows_of(row[3], np.ones(len(again[i]), bool))
            at = np.minimum(np.searchsorted(seen, own), len(seen) - 1)
            again[i] = again[i] | (seen[at] == own)
    out = []
    for (_, doc_id, start, _), mask in zip(rows, again):
        edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
        out += [(doc_id, start + int(a), start + int(b)) for a, b in zip(edge[::2], edge[1::2])]
    last = rows[-1][0]
    fresh = [windows_of(r[3], ~m) for r, m in zip(rows, again) if r[0] == last]
    carried = [seen] if last == open_anchor else []
    return out, np.sort(np.concatenate(carried + fresh)) if fresh else seen


def settle(rows: DataFrame) -> DataFrame:
    """(id, first, end): removed windows, from (anchor, id, start, bytes) sorted so within partitions."""

    def run(batches):
        shard, held = [], 0
        seen, open_anchor = np.zeros(0, f"S{LENGTH}"), None

        def close(next_anchor):
            nonlocal shard, held, seen, open_anchor
            found = []
            if len(shard) > 1 or shard and shard[0][0] == open_anchor:
                if shard[-1][0] == next_anchor:
                    found, seen = settle_shard(shard, seen, open_anchor)
                    open_anchor = next_anchor
                else:
                    found, _ = settle_shard(shard, seen, open_anchor)
                    open_anchor = None
            elif shard and shard[0][0] == next_anchor:
                seen, open_anchor = np.sort(windows_of(shard[0][3], np.ones(len(shard[0][3]) - LENGTH + 1, bool))), next_anchor
            if open_anchor is None:
                seen = seen[:0]
            shard, held = [], 0
            return pa.record_batch(
                [pa.array([f[k] for f in found], pa.int64()) for k in range(3)], ["id", "first", "end"]
            )

        single = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                anchor = row[0]
                if single is not None:
                    if anchor == single[0]:
                        shard.append(single)
                        held += len(single[3])
                        single = None
                    else:
                        single = None
                        if held >= SHARD_BYTES:
                            yield close(anchor)
                if shard and shard[-1][0] == anchor or open_anchor == anchor:
                    if held >= SHARD_BYTES:
                        yield close(anchor)
                    shard.append(row)
                    held += len(row[3])
                else:
                    if held >= SHARD_BYTES:
                        yield close(None)
                    single = row  # an anchor with one run has nothing to settle
        yield close(None)

    return rows.mapInArrow(run, "id long, first long, end long")


def settle_spread(rows: DataFrame) -> DataFrame:
    """The same for anchors with very many runs: windows keyed by their bytes' hash, the first stays."""

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for _, doc_id, start, piece in zip(*(c.to_pylist() for c in batch.columns)):
            n = len(piece) - LENGTH + 1
            keys = [xxhash.xxh3_128_digest(piece[i : i + LENGTH]) for i in range(n)]
            yield pa.record_batch(
                [pa.array(keys, pa.binary()), pa.array([doc_id] * n, pa.int64()), pa.array(range(start, start + n), pa.int64())],
                ["key", "id", "first"],
            )

    windows = map_rows(rows, each, "key binary, id long, first long")
    least = windows.groupBy("key").agg(F.min(F.struct("id", "first")).alias("least"), F.count("*").alias("n"))
    later = join_per_key(windows, least.filter("n > 1"), ["key"])
    later = later.filter(F.struct("id", "first") > F.col("least"))
    return later.select("id", "first", (F.col("first") + 1).alias("end"))


def removed_windows(docs: DataFrame, runs_in_task: int = RUNS_IN_TASK) -> DataFrame:
    """(id, first, end): the windows of ``docs`` (id, text) that stand earlier, as ranges of starts."""
    shared = _shared_anchors(docs)
    found = _shared_runs(docs, shared)
    firsts, whole = _later_runs(found)
    several = _several(firsts)
    crowded = F.col("runs") > runs_in_task
    rows = _with_bytes(docs, firsts, several.filter(~crowded))
    parts = [whole, settle(rows.repartition("anchor").sortWithinPartitions("anchor", "id", "start"))]
    if not several.filter(crowded).isEmpty():
        parts.append(settle_spread(_with_bytes(docs, firsts, several.filter(crowded))))
    out = stored(reduce(DataFrame.unionAll, parts))
    _free_shuffles(docs.sparkSession)
    return out


def _shared_anchors(docs: DataFrame) -> DataFrame:
    """The anchors that stand twice or more."""
    out = stored(runs(docs, anchors_only=True).groupBy("anchor").count().filter("count > 1").select("anchor"))
    _free_shuffles(docs.sparkSession)
    return out


def _shared_runs(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """The runs of those anchors."""
    out = stored(runs(docs).join(shared, "anchor"))
    _free_shuffles(docs.sparkSession)
    return out


def _later_runs(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first of equal runs (anchor, key, id, start, windows); the others as removed windows."""
    least = found.groupBy("anchor", "key").agg(F.min(F.struct("id", "start", "windows")).alias("least"))
    firsts = stored(least.select("anchor", "key", "least.*"))
    of = firsts.select("anchor", "key", F.col("id").alias("first_id"), F.col("start").alias("first_start"))
    later = found.join(of, ["anchor", "key"])
    later = later.filter((F.col("id") != F.col("first_id")) | (F.col("start") != F.col("first_start")))
    whole = stored(later.select("id", F.col("start").alias("first"), (F.col("start") + F.col("windows")).alias("end")))
    _free_shuffles(found.sparkSession)
    return firsts, whole


def _several(firsts: DataFrame) -> DataFrame:
    """(anchor, runs): the anchors with runs that differ, and how many."""
    return stored(firsts.groupBy("anchor").agg(F.count("*").alias("runs")).filter("runs > 1"))


def _with_bytes(docs: DataFrame, firsts: DataFrame, several: DataFrame) -> DataFrame:
    """(anchor, id, start, bytes) of the first runs of the anchors in ``several``."""

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for doc_id, text, own in zip(batch.column(0).to_pylist(), texts_utf8(batch.column(1)), batch.column(2).to_pylist()):
            for run in own:
                start, key = run["start"], run["key"]
                part = text[start : start + run["windows"] + LENGTH - 1]
                # Another row with this id may hold the run.
                if xxhash.xxh3_64_intdigest(part) == key % (1 << 64):
                    out.append((run["anchor"], doc_id, start, part))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        columns = list(zip(*out)) or [()] * 4
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["anchor", "id", "start", "bytes"])

    chosen = firsts.join(several.select("anchor"), "anchor")
    per_doc = chosen.groupBy("id").agg(F.collect_list(F.struct("anchor", "key", "start", "windows")).alias("own"))
    joined = docs.join(per_doc, "id").select("id", "text", "own")
    return map_rows(joined, cut, "anchor long, id long, start long, bytes binary")


def _free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that are written and done with."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def dedup_substrings(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    keep_bytes: bool = True,
    runs_in_task: int = RUNS_IN_TASK,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept) for every row of ``docs``.

    ``spans`` are the maximal removed runs as (from, to) in bytes; ``kept`` is what is left,
    as bytes, since a cut may fall within a character (null without ``keep_bytes``).

    A null text is empty.  Texts of fewer than ``LENGTH`` bytes lose nothing.  A null id is
    returned as null and sorts behind all others.  Rows that share an id are one document
    with several texts: a string is earlier there if it starts at a smaller place in any of
    them, so that repeated rows lose the same.  An empty table gives no rows.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), id_order(id_column).alias("id"), F.col(text).alias("text"))
    removed = removed_windows(rows.select("id", "text"), runs_in_task)
    per_doc = removed.groupBy("id").agg(F.collect_list(F.struct("first", "end")).alias("windows"))
    joined = rows.join(per_doc, "id", "left").select("doc_id", "text", "windows")

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        for value, windows in zip(texts_utf8(batch.column(1)), batch.column(2).to_pylist()):
            spans: list[list[int]] = []
            for first, end in sorted((w["first"], min(w["end"] - 1 + LENGTH, len(value))) for w in windows or ()):
                if spans and first <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], end)
                else:
                    spans.append([first, end])
            left, at = [], 0
            for first, end in spans:
                left.append(value[at:first])
                at = end
            kept = b"".join([*left, value[at:]]) if spans else value
            digest = hashlib.sha256(kept).hexdigest()
            pairs = [{"from": a, "to": b} for a, b in spans]
            out.append((len(value), len(value) - len(kept), len(spans), digest, pairs, kept if keep_bytes else None))
        columns = list(zip(*out))
        span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), span, pa.binary()]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
        yield pa.record_batch([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names)

    added = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<from: long, to: long>>, kept binary"
    return map_rows(joined, cut, T.StructType([joined.schema["doc_id"], *T.StructType.fromDDL(added)]))

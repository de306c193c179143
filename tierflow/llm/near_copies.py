"""Near copies: documents whose sets of word shingles have a Jaccard similarity of 0.8 or more.

Candidates come from two sides, and every pair is then verified on the whole shingle sets,
so no pair below the similarity links.  The one side is the pigeonring of ``simhash``: sets
whose fingerprints differ in two bits or fewer.  A SimHash of b bits differs in about 0.15 b
bits at similarity 0.8; for such a radius the pigeonring guarantees no equal box of more than
a few bits, so its candidates would grow with the square of the table.  The pairs beyond its
radius come from the other side, min-wise hashing: of ``BANDS * ROWS`` permutations of the
shingle hashes a document keeps the least values, and documents that agree on all ``ROWS``
values of a band are compared.  Two documents of similarity s agree on some band with
probability 1 - (1 - s**ROWS)**BANDS, which is 0.9996 at 0.8.

Equal sets are one from the start.  A bucket of more than ``PAIRS_UP_TO`` sets is first
compared with a few leaders, and what they join is one; then only pairs of members that
are still apart are compared, all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tierflow.llm.common import copy_key, id_order, map_rows, one_row_of, stored
from tierflow.llm.components import components
from tierflow.llm.simhash import bit_majority, links as pigeonring, shingle_hashes
from tierflow.operators.joins import join_per_key

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 5
#: Buckets up to this size are compared pair by pair at once.
PAIRS_UP_TO = 16
#: Rounds in which a crowded bucket is compared with one of its members.
LEADERS = 2
_RANDOM = np.random.default_rng(42)
FACTORS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, np.uint64)


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """The distinct shingle hashes in ascending order."""
    return np.unique(np.array(shingle_hashes(text, words), np.uint64))


def bands(shingles: np.ndarray) -> list[int]:
    """A key for each band; none for an empty set."""
    if not len(shingles):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(shingles), 2000):
        mixed = FACTORS[:, None] * shingles[None, low : low + 2000] + SHIFTS[:, None]
        np.minimum(least, mixed.min(axis=1), out=least)
    return [xxhash.xxh64_intdigest(band.tobytes()) - (1 << 63) for band in least.reshape(BANDS, ROWS)]


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


def sketches(rows: DataFrame, words: int) -> DataFrame:
    """(id, copy, set, n, fp, bands) of ``rows`` (id, copy, text): a name of the shingle set, its size, SimHash and bands."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        names, sizes, prints, keys = [], [], [], []
        texts = batch.column(2).cast(pa.binary())
        for row in range(len(texts)):
            shingles = shingle_set(texts[row].as_py() or b"", words)
            names.append(xxhash.xxh128_digest(shingles.tobytes()))
            sizes.append(len(shingles))
            prints.append(bit_majority(shingles, np.zeros(1, np.int64))[0])
            keys.append(bands(shingles))
        fps = pa.array(np.array(prints, np.uint64).view(np.int64))
        columns = [pa.array(names, pa.binary()), pa.array(sizes, pa.int32()), fps, pa.array(keys, pa.list_(pa.int64()))]
        yield pa.record_batch([batch.column(0), batch.column(1), *columns], ["id", "copy", "set", "n", "fp", "bands"])

    return map_rows(rows, run, "id long, copy string, set binary, n int, fp long, bands array<long>")


def verified(pairs: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """The ``pairs`` (u, v) whose ``texts`` (set, text) have that similarity."""
    side = lambda name: texts.select(F.col("set").alias(name), F.col("text").alias(f"{name}_text"))
    laid = pairs.join(side("u"), "u").join(side("v"), "v").select("u", "v", "u_text", "v_text")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        # A text at a time; the sets of a few texts are kept, since pairs of one text often follow each other.
        texts = [batch.column(k).cast(pa.binary()) for k in (2, 3)]
        known: dict[bytes, np.ndarray] = {}

        def shingles(name: bytes, column: pa.Array, row: int) -> np.ndarray:
            if name not in known:
                if len(known) >= 50:
                    known.pop(next(iter(known)))
                known[name] = shingle_set(column[row].as_py() or b"", words)
            return known[name]

        names = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        alike = [similar(shingles(u, texts[0], k), shingles(v, texts[1], k), similarity) for k, (u, v) in enumerate(names)]
        yield batch.select([0, 1]).filter(pa.array(alike))

    return map_rows(laid, run, "u binary, v binary")


def pairs_within(entries: DataFrame, similarity: float, apart: bool = False) -> DataFrame:
    """(u, v) with u < v, each once: pairs of a bucket whose sizes allow the similarity."""
    extra = ["root"] if apart else []
    one = entries.select("band", "key", F.col("set").alias("u"), F.col("n").alias("n_u"), *[F.col(c).alias("root_u") for c in extra])
    two = entries.select("band", "key", F.col("set").alias("v"), F.col("n").alias("n_v"), *[F.col(c).alias("root_v") for c in extra])
    found = one.join(two, ["band", "key"]).filter("u < v").filter(_sizes_allow(similarity))
    return (found.filter("root_u <> root_v") if apart else found).select("u", "v").distinct()


def _sizes_allow(similarity: float):
    return F.least("n_u", "n_v") >= F.lit(similarity) * F.greatest("n_u", "n_v") - F.lit(1e-9)


def pairs_by_fingerprint(distinct: DataFrame, similarity: float) -> DataFrame:
    """(u, v) with u < v: candidates of ``distinct`` (set, n, fp) by the pigeonring, whose sizes allow the similarity.

    A fingerprint is stood for by its least set: the others of it are paired with that one,
    and linked fingerprints by theirs, so the pairs grow with the table and not with groups.
    """
    marked = distinct.filter("n > 0").select("fp", F.col("set").alias("v"), F.col("n").alias("n_v"))
    least = F.min(F.struct("v", "n_v")).alias("least")
    first = stored(marked.groupBy("fp").agg(least).select("fp", F.col("least.v").alias("u"), F.col("least.n_v").alias("n_u")))
    same = join_per_key(marked, first, ["fp"]).select("u", "n_u", "v", "n_v")
    near = pigeonring(first.select("fp")).select(F.col("u").alias("fp"), F.col("v").alias("other"))
    other = first.select(F.col("fp").alias("other"), F.col("u").alias("v"), F.col("n_u").alias("n_v"))
    near = near.join(first, "fp").join(other, "other").select("u", "n_u", "v", "n_v")
    pairs = same.unionAll(near).filter("u <> v").filter(_sizes_allow(similarity))
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def links(distinct: DataFrame, texts_of, words: int, similarity: float) -> DataFrame:
    """(u, v): links that give the components of ``distinct`` (set, n, fp, bands).

    ``texts_of`` gives (set, text) for a frame of sets.
    """
    entries = distinct.select("set", "n", F.posexplode("bands").alias("band", "key"))
    sizes = entries.groupBy("band", "key").count().filter("count > 1")
    entries = stored(join_per_key(entries, sizes, ["band", "key"]))
    pairs = stored(pairs_by_fingerprint(distinct, similarity))
    compared = entries.select("set").unionAll(pairs.select("u")).unionAll(pairs.select("v"))
    texts = stored(texts_of(compared.distinct()))
    crowded = entries.filter(F.col("count") > PAIRS_UP_TO).select("band", "key", "set", "n")
    pairs = pairs.unionAll(pairs_within(entries.filter(F.col("count") <= PAIRS_UP_TO), similarity)).distinct()
    edges = stored(verified(pairs, texts, words, similarity))
    if crowded.isEmpty():
        return edges
    for turn in range(LEADERS + 1):
        roots = components(edges)
        members = crowded.join(roots, crowded["set"] == roots["node"], "left").select(
            "band", "key", "set", "n", F.coalesce("root", "set").alias("root")
        )
        split = members.groupBy("band", "key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
        members = stored(join_per_key(members, split.select("band", "key"), ["band", "key"]))
        if members.isEmpty():
            break
        if turn < LEADERS:
            rank = F.struct(F.xxhash64(F.lit(turn), "root"), F.xxhash64("set"), "set", "n", "root")
            least = members.groupBy("band", "key").agg(F.min(rank).alias("least")).select(
                "band", "key", F.col("least.set").alias("u"), F.col("least.n").alias("n_u"), F.col("least.root").alias("root_u")
            )
            star = join_per_key(members.withColumnRenamed("n", "n_v"), least, ["band", "key"])
            star = star.filter(F.col("root") != F.col("root_u")).filter(_sizes_allow(similarity))
            pairs = star.select(F.least("u", "set").alias("u"), F.greatest("u", "set").alias("v")).distinct()
        else:
            pairs = pairs_within(members, similarity, apart=True)
        edges = stored(edges.unionAll(verified(pairs, texts, words, similarity)))
    return edges


def one_of_each(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = WORDS, similarity: float = SIMILARITY
) -> DataFrame:
    """The documents without near copies: of each component of linked rows the one with the smallest id.

    All columns stay.  A null or blank text has an empty set, and all of them are one
    component.  Rows are told apart by id and text, so of different texts that share an id,
    or have none, each stays that is no near copy of another; of rows with the same id and
    text one stays.
    """
    rows = docs.select(id_order(id_column).alias("id"), copy_key(text).alias("copy"), F.col(text).alias("text"))
    marked = stored(sketches(rows, words))
    first = F.min(F.struct("id", "copy")).alias("first")
    distinct = stored(marked.groupBy("set").agg(first, F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("bands").alias("bands")))

    def texts_of(sets: DataFrame) -> DataFrame:
        wanted = distinct.join(sets, "set", "left_semi").select("first.id", "first.copy", "set")
        return rows.join(wanted, ["id", "copy"]).select("set", "text").dropDuplicates(["set"])

    roots = components(links(distinct.select("set", "n", "fp", "bands"), texts_of, words, similarity))
    named = distinct.join(roots, distinct["set"] == roots["node"], "left").select("first", F.coalesce("root", "set").alias("root"))
    winners = named.groupBy("root").agg(F.min("first").alias("first")).select("first.id", "first.copy")
    return one_row_of(docs, winners, id_column, text)

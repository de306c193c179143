"""Benchmark decontamination by spaced-seed hashing.

A mask picks some positions of a window and ignores the others.  The tokens at a mask's
positions are hashed to a seed, at every place of every document and benchmark item.
Where seeds agree, the item is laid over the document on that diagonal, and the overlap
counts if some window of ``WINDOW`` tokens has at most ``SUBSTITUTIONS`` unequal ones.
The three masks together hit every such window: wherever two substitutions fall, one of
them has a place inside the window that avoids both (a test tries all places).

Only the benchmark's seeds are broadcast, each with its item's name, length and place, in
blocks by seed of about ``BLOCK_SEEDS``, one pass over the documents per block.  Beyond
``MAX_PASSES`` blocks seeds are shuffled instead, with the same result.  A
document's tokens never leave its row: each hit carries the stretch of token hashes under
the item, no longer than the item.  The item's own tokens are fetched once the diagonals
are distinct.  All steps are DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tierflow.llm.common import copy_key, stored

WINDOW = 12
SUBSTITUTIONS = 2
#: Positions a mask looks at, weight six in spans of up to eleven tokens.
MASKS = ((0, 2, 3, 4, 5, 7), (0, 1, 2, 7, 8, 9), (0, 1, 3, 7, 9, 10))
#: Seeds in one broadcast, whatever the items' lengths: four numbers each.
BLOCK_SEEDS = 400_000
#: Passes over the documents, one for each block; a benchmark of more is joined by a shuffle.
MAX_PASSES = 8


def token_hashes(text: str) -> Column:
    """Hashes of the runs of letters and digits, lower-cased; none for a null text."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def seeds(tokens: str, at: str) -> Column:
    """One seed per mask for the place ``at``; null where the mask passes the end."""
    n = F.size(tokens)
    return F.array(
        *[
            F.when(
                F.col(at) + mask[-1] < n,
                F.xxhash64(F.lit(i), *[F.get(tokens, F.col(at) + p) for p in mask]),
            )
            for i, mask in enumerate(MASKS)
        ]
    )


def seeded(rows: DataFrame, tokens: str, at: str) -> DataFrame:
    """A row for each seed of each place."""
    # The outer form keeps Spark from working the tokens out twice to skip empty texts.
    places = rows.select("*", F.posexplode_outer(tokens).alias(at, "_token")).drop("_token")
    return places.select("*", F.explode(seeds(tokens, at)).alias("seed")).filter("seed is not null")


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    block_seeds: int = BLOCK_SEEDS,
) -> DataFrame:
    """(id, item_id, n_tokens, n_equal, start): the items found in each document.

    ``n_tokens`` is the item's length, ``n_equal`` how many of them stand in the document
    on the best diagonal, ``start`` the place of the item's first token there (negative if
    the document begins within the item).

    A null or empty text has no overlap, nor has an item of fewer than ``WINDOW`` tokens.
    Each row is compared by its own text; what rows that share an id, or have none, hold
    is then reported as one document's, by its best overlap, under that id or null.  Items
    with a null id are left out, those that share one are each compared.  Repeated
    passages give one row.  Empty tables give no rows.
    """
    # Rows are told apart by id and text, as copies of one row hold the same.
    row = F.struct(F.col(id_column).alias("id"), copy_key(text).alias("copy"))
    found = _found(docs.select(row.alias("id"), token_hashes(text).alias("tokens")), benchmark, item_column, item_text, block_seeds)
    return _best(found.withColumn("id", F.col("id.id")))


def _found(
    tokens: DataFrame, benchmark: DataFrame, item_column: str, item_text: str, block_seeds: int, max_passes: int | None = None
) -> DataFrame:
    """``overlaps`` of rows (id, tokens); rows with one id hold the same tokens, ids may be of any type."""
    max_passes = MAX_PASSES if max_passes is None else max_passes
    items = stored(
        benchmark.select(F.col(item_column).alias("item_id"), token_hashes(item_text).alias("item"))
        .filter((F.size("item") >= WINDOW) & F.col("item_id").isNotNull())
        .distinct()
        .select(F.xxhash64("item_id", "item").alias("item_key"), "item_id", "item", F.size("item").alias("n"))
    )
    total = items.agg(F.sum("n")).first()[0]
    if not total:
        kind = T.StructType.fromDDL("item_id long, n_tokens int, n_equal int, start int")
        return tokens.sparkSession.createDataFrame([], T.StructType([tokens.schema["id"], *kind]))
    blocks = -(-total * len(MASKS) // block_seeds)
    index = seeded(items, "item", "item_at").select("seed", "item_key", "n", "item_at")
    if blocks > max_passes:
        return _best(verified(shuffled_hits(tokens, index), items))
    places = seeded(tokens, "tokens", "at")
    index = stored(index) if blocks > 1 else index
    hits = None
    for block in range(blocks):
        part = index.filter(F.pmod("seed", F.lit(blocks)) == block)
        found = laid(places.join(F.broadcast(part), "seed"))
        hits = found if hits is None else hits.unionAll(found)
    return _best(verified(hits, items))


def _best(found: DataFrame) -> DataFrame:
    """The best overlap of each document and item, the first of equals."""
    best = F.max(F.struct("n_equal", (-F.col("start")).alias("late"))).alias("best")
    return (
        found.groupBy("id", "item_id", "n_tokens")
        .agg(best)
        .select("id", "item_id", "n_tokens", "best.n_equal", (-F.col("best.late")).alias("start"))
    )


def shuffled_hits(tokens: DataFrame, index: DataFrame) -> DataFrame:
    """The hits of a benchmark of any size, in one pass: seeds meet by a shuffle.

    Only seed, row and place are shuffled; of a seed that many items share each item's
    places are kept, since all of them are found.  The stretches of the documents are
    fetched once the diagonals are distinct.
    """
    rows = tokens.dropDuplicates(["id"])
    slim = seeded(rows, "tokens", "at").select("id", "at", "seed")
    start = (F.col("at") - F.col("item_at")).alias("start")
    diagonals = slim.join(index, "seed").select("id", "item_key", "n", start).distinct()
    under = F.slice("tokens", F.greatest(F.col("start"), F.lit(0)) + 1, F.col("n"))
    return diagonals.join(rows, "id").select("id", "item_key", "start", under.alias("under"))


def laid(hits: DataFrame) -> DataFrame:
    """(id, item_key, start, under): the diagonal of each hit, and the document's stretch under the item."""
    start = F.col("at") - F.col("item_at")
    under = F.slice("tokens", F.greatest(start, F.lit(0)) + 1, F.col("n"))
    return hits.select("id", "item_key", start.alias("start"), under.alias("under"))


def verified(hits: DataFrame, items: DataFrame) -> DataFrame:
    """The diagonals of ``hits`` that hold a window with few enough substitutions.

    A diagonal is kept once, with the stretch of the document under the item, before the
    item is fetched and compared; so the rows of the seed join stay in generated code.
    """
    once = hits.groupBy("id", "item_key", "start").agg(F.first("under").alias("under"))
    once = once.join(items, "item_key")
    skipped = F.greatest(-F.col("start"), F.lit(0))
    equal = F.transform(
        "item",
        lambda token, i: F.when(i >= skipped, F.coalesce((F.get("under", i - skipped) == token).cast("int"), F.lit(0))).otherwise(0),
    )
    found = once.select("id", "item_id", F.size("item").alias("n_tokens"), "start", equal.alias("equal"))
    within = F.exists(
        F.sequence(F.lit(1), F.col("n_tokens") - WINDOW + 1),
        lambda s: F.aggregate(F.slice("equal", s, WINDOW), F.lit(0), lambda a, b: a + b) >= WINDOW - SUBSTITUTIONS,
    )
    n_equal = F.aggregate("equal", F.lit(0), lambda a, b: a + b)
    return found.filter(within).select("id", "item_id", "n_tokens", n_equal.alias("n_equal"), "start")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents in which no benchmark item was found; all their columns stay.

    Each row is judged by its own text, whatever its id; a null or empty text stays, of
    repeated rows all stay or none.  Empty tables and items as in ``overlaps``.
    """
    tokens = docs.select(copy_key(text).alias("id"), token_hashes(text).alias("tokens"))
    bad = _found(tokens, benchmark, "item_id", "text", BLOCK_SEEDS).select("id").distinct()
    return docs.join(bad, copy_key(text) == bad["id"], "left_anti")

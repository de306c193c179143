"""Source divergence audit: how the words of a language's sources differ, in exact arithmetic.

Terms are counted by length-bucketed packing.  A task lays the texts of one group after
another as bytes and cuts them into runs of letters.  A term of up to eight bytes becomes one
uint64 word, one of up to sixteen bytes two; each bucket of lengths is put in order by a
radix sort of its 16-bit digits, as many as its longest term has, and equal neighbours are
counted.  Longer terms go to a bucket of their own, sorted as bytes.  The sorts are stable,
so within a term the groups and documents stay in order, and counting the changes gives
occurrences and documents at once.  What is counted is summed within each task before
anything is shuffled.

Probabilities are whole billionths.  The distance of two sources is summed in square tiles
of sources, over the terms that either tile has; a term that neither has adds the distance
of their floors, as often as there are such terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tierflow.llm.common import map_rows, stored, texts_utf8
from tierflow.operators.joins import join_per_key

LEAST_DOCS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
PSEUDO = 5
#: Bytes of text packed at once; a longer text is packed in stretches.
CHUNK_BYTES = 8_000_000
#: Longest terms of the packed buckets, in bytes; those of the last two take a second word.
BUCKETS = (2, 4, 6, 8, 12, 16)
#: Sources in a side of a tile, and terms in a part of a tile.
TILE = 64
TILE_TERMS = 4_000


def _letters() -> np.ndarray:
    """Byte to its term byte: A-Z lower-cased, a-z and all above 127 as they are; 0 for the rest."""
    table = np.zeros(256, np.uint8)
    for code in range(256):
        if code >= 128 or chr(code).isalpha():
            table[code] = ord(chr(code).lower()) if code < 128 else code
    return table


LETTERS = _letters()


def packed_words(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The first eight bytes from each start as a big-endian number, bytes beyond the size zero.

    ``data`` must go on for eight bytes behind the last start.
    """
    windows = np.lib.stride_tricks.sliding_window_view(data, 8)
    words = np.ascontiguousarray(windows[starts]).view(">u8").ravel().astype(np.uint64)
    short = np.clip(8 - sizes, 0, 8).astype(np.uint64) * np.uint64(8)
    return np.where(short >= 64, np.uint64(0), (words >> np.minimum(short, np.uint64(63))) << np.minimum(short, np.uint64(63)))


def radix_order(words: list[np.ndarray], digits: list[tuple[int, int]]) -> np.ndarray:
    """A stable order by the given (word, 16-bit digit) places, most significant first."""
    order = np.arange(len(words[0]))
    for word, digit in reversed(digits):
        part = ((words[word][order] >> np.uint64(48 - 16 * digit)) & np.uint64(0xFFFF)).astype(np.uint16)
        order = order[np.argsort(part, kind="stable")]  # a counting sort for this type
    return order


def changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before; the first row always does."""
    out = np.zeros(len(columns[0]), bool)
    if len(out):
        out[0] = True
        for column in columns:
            out[1:] |= column[1:] != column[:-1]
    return out


def run_counts(terms: list[np.ndarray], group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted rows: the first row of each (term, group), its occurrences and its documents."""
    new = changes(*terms, group)
    firsts = np.flatnonzero(new)
    count = np.diff(np.append(firsts, len(group)))
    docs = np.add.reduceat(changes(*terms, group, doc).astype(np.int64), firsts) if len(firsts) else count
    return firsts, count, docs


def as_strings(chars: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Strings that stand end to end in ``chars``."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(pa.string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(chars))])


def count_terms(texts: list[bytes], groups: np.ndarray) -> pa.Table:
    """(term, group, n, docs) of texts whose groups ascend: a row for each term of a group in each bucket."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    data = LETTERS[np.frombuffer(b" ".join(texts) + b" " * 17, np.uint8)]
    edge = np.diff((data != 0).astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    length = ends - starts
    doc = np.searchsorted(np.cumsum(sizes), starts, "right")
    bucket = np.searchsorted(np.array(BUCKETS), length, "left")
    out = []
    for b, longest in enumerate(BUCKETS):
        rows = np.flatnonzero(bucket == b)
        if not len(rows):
            continue
        words = [packed_words(data, starts[rows], length[rows])]
        if longest > 8:
            words.append(packed_words(data, starts[rows] + 8, length[rows] - 8))
        order = radix_order(words, [(d // 4, d % 4) for d in range(longest // 2)])
        words, docs = [w[order] for w in words], doc[rows[order]]
        firsts, count, in_docs = run_counts(words, groups[docs], docs)
        chars = np.stack([w[firsts] for w in words], axis=1).astype(">u8").view(np.uint8).ravel()
        terms = as_strings(chars[chars != 0], length[rows[order]][firsts])  # no term holds a zero byte
        out.append([terms, groups[docs[firsts]], count, in_docs])
    rows = np.flatnonzero(bucket == len(BUCKETS))
    if len(rows):
        flat = data.tobytes()
        names = [flat[a:b] for a, b in zip(starts[rows].tolist(), ends[rows].tolist())]
        order = np.array(sorted(range(len(names)), key=names.__getitem__))
        names, docs = [names[k] for k in order], doc[rows[order]]
        number = np.cumsum([a != b for a, b in zip(names, [None, *names])])
        firsts, count, in_docs = run_counts([number], groups[docs], docs)
        out.append([pa.array([names[k] for k in firsts], pa.binary()).cast(pa.string()), groups[docs[firsts]], count, in_docs])
    empty = [[pa.array([], pa.string()), *[np.zeros(0, np.int64)] * 3]]
    parts = [pa.table([part[0], *map(pa.array, part[1:])], ["term", "group", "n", "docs"]) for part in out or empty]
    return pa.concat_tables(parts)


def count_long(text: bytes, group: int) -> pa.Table:
    """As ``count_terms`` of one text of any length, packed in stretches that end between terms."""
    parts, low = [], 0
    while low < len(text):
        high = min(low + CHUNK_BYTES, len(text))
        while high < len(text) and LETTERS[text[high]]:
            high += 1
        parts.append(count_terms([text[low:high]], np.full(1, group)))
        low = high
    summed = pa.concat_tables(parts).group_by(["term", "group"]).aggregate([("n", "sum"), ("docs", "max")])
    return summed.select(["term", "group", "n_sum", "docs_max"]).rename_columns(["term", "group", "n", "docs"])


def counted(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): the counted terms of stretches of texts, not yet summed.

    Every group that occurs has a row with a null term.  Nulls count as empty.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    slim = docs.select(name(lang).alias("lang"), name(source).alias("source"), F.col(text).alias("text"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        numbers: dict[tuple[str, str], int] = {}
        keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        group = np.array([numbers.setdefault(k, len(numbers)) for k in keys], np.int64)
        langs, sources = (pa.array(names, pa.string()) for names in zip(*numbers))

        def rows(table: pa.Table) -> Iterator[pa.RecordBatch]:
            at = table.column("group")
            named = [langs.take(at), sources.take(at), table.column("term"), table.column("n"), table.column("docs")]
            yield from pa.table(named, ["lang", "source", "term", "n", "docs"]).to_batches()

        n = len(numbers)
        none = pa.array([0] * n, pa.int64())
        yield from rows(pa.table([pa.nulls(n, pa.string()), pa.array(range(n), pa.int64()), none, none], ["term", "group", "n", "docs"]))
        texts = texts_utf8(batch.column(2))
        order = np.argsort(group, kind="stable").tolist()
        low = 0
        while low < len(order):
            high, total = low, 0
            while high < len(order) and (high == low or total + len(texts[order[high]]) <= CHUNK_BYTES):
                total += len(texts[order[high]])
                high += 1
            part = order[low:high]
            if total > CHUNK_BYTES:
                yield from rows(count_long(texts[part[0]], int(group[part[0]])))
            else:
                yield from rows(count_terms([texts[r] for r in part], group[part]))
            low = high

    return map_rows(slim, run, "lang string, source string, term string, n long, docs long")


def billionths(count: Column | str, total: Column | str, terms: Column | str) -> Column:
    """1 + floor(SCALE * (count + PSEUDO) / (total + PSEUDO * terms)), in whole numbers."""
    part = (F.col(count) if isinstance(count, str) else count) + PSEUDO
    whole = (F.col(total) if isinstance(total, str) else total) + (F.col(terms) if isinstance(terms, str) else terms) * PSEUDO
    product = part.cast("decimal(18,0)") * F.lit(SCALE).cast("decimal(18,0)")
    return F.lit(1).cast("long") + F.call_function("div", product, whole.cast("decimal(18,0)"))


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_docs: int = LEAST_DOCS,
    top: int = TOP_TERMS,
    tile: int = TILE,
) -> DataFrame:
    """(lang, source, part, item, value, rank): for each group of a language and source,
    its distance from each other source, and the terms it has more of than its language.

    A language keeps the terms found in at least ``least_docs`` of its documents; the groups'
    and the language's probabilities are over those.  A null text has no terms, a null
    language or source is the empty one.  A language that keeps no term has distances of 0
    and no terms; a group without terms is compared all the same.  Equal values rank by item.
    Repeated rows count as often as they are there.  An empty table has no rows; other
    columns are not looked at.
    """
    parts = counted(docs, text, lang, source)
    counts = stored(parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    per_term = counts.filter("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs"))
    kept = stored(per_term.filter(F.col("docs") >= least_docs).drop("docs"))
    of_lang = kept.groupBy("lang").agg(F.sum("n_lang").alias("total_lang"), F.count("*").alias("terms"))
    found = counts.filter("term is not null").drop("docs")
    found = stored(join_per_key(found, kept, ["lang", "term"]))
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.filter("term is null").select("lang", "source")
    groups = groups.join(totals, ["lang", "source"], "left").join(of_lang, "lang", "left")
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = stored(
        groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "total_lang", "terms")])
        .withColumn("number", number)
        .withColumn("floor", F.when(F.col("terms") > 0, billionths(F.lit(0), "total", "terms")).otherwise(F.lit(0)))
    )
    found = join_per_key(found, groups, ["lang", "source"], measure=False).withColumn("p", billionths("n", "total", "terms"))
    found = stored(found.select("lang", "source", "term", "p", "number", "terms", billionths("n_lang", "total_lang", "terms").alias("q")))
    return typical_terms(found, top).unionByName(distances(found, groups, tile))


def ranked(rows: DataFrame, part: str) -> DataFrame:
    by = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(by).alias("rank"))


def typical_terms(found: DataFrame, top: int) -> DataFrame:
    more = found.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return ranked(more, "term").filter(F.col("rank") <= top)


def distances(found: DataFrame, groups: DataFrame, tile: int = TILE) -> DataFrame:
    """Part ``pair``: the sources of a language are compared in tiles of ``tile`` by ``tile``.

    A tile's terms are spread over as many tasks as they need, by a hash of the term, each
    with the floors of the tile's sources; so a part holds a bounded number of rows.
    """
    shares = F.ceil(F.col("terms") / F.lit(TILE_TERMS)).cast("int")
    block = (F.col("number") / F.lit(tile)).cast("int")
    last = groups.groupBy("lang").agg(F.max(block).alias("last"))
    # A source is in the row of tiles before its block, the diagonal one, and the column behind it.
    tiles = F.transform(
        F.sequence(F.lit(0), F.col("last")), lambda b: F.struct(F.least(b, block).alias("a"), F.greatest(b, block).alias("b"))
    )
    entry = groups.withColumn("share", F.explode(F.sequence(F.lit(0), F.greatest(shares - 1, F.lit(0)))))
    entry = entry.join(last, "lang").withColumn("tile", F.explode(tiles))
    floors = entry.select("lang", "tile.a", "tile.b", "share", F.lit(None).cast("string").alias("term"), "number", F.col("floor").alias("p"), "terms", "source")
    values = found.join(last, "lang").withColumn("tile", F.explode(tiles))
    share = F.pmod(F.xxhash64("term"), F.greatest(shares, F.lit(1)).cast("long")).cast("int")
    values = values.select("lang", "tile.a", "tile.b", share.alias("share"), "term", "number", "p", "terms", F.lit(None).cast("string").alias("source"))

    def summed(table: pa.Table) -> pa.Table:
        return tile_sums(table, tile)

    sums = floors.unionByName(values).groupBy("lang", "a", "b", "share").applyInArrow(
        summed, "lang string, one string, two string, value long, seen long, gap long, terms long"
    )
    pairs = sums.groupBy("lang", "one", "two").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"), F.first("gap").alias("gap"), F.first("terms").alias("terms"))
    pairs = stored(pairs.select("lang", "one", "two", (F.col("value") + (F.col("terms") - F.col("seen")) * F.col("gap")).alias("value")))
    both = pairs.select("lang", F.col("one").alias("source"), F.col("two").alias("item"), "value").unionByName(
        pairs.select("lang", F.col("two").alias("source"), F.col("one").alias("item"), "value")
    )
    return ranked(both, "pair")


def tile_sums(table: pa.Table, tile: int) -> pa.Table:
    """(lang, one, two, value, seen, gap, terms) for each pair of a tile's sources, over one part of its terms.

    ``seen`` is how many terms the part has, ``gap`` the distance where neither has a term.
    """
    a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
    number, p = table.column("number").to_numpy(), table.column("p").to_numpy()
    term = table.column("term").combine_chunks().dictionary_encode()
    is_floor = np.asarray(table.column("term").is_null())
    base = a * tile
    place = np.where(number // tile == a, number - base, number - b * tile + tile)
    at = place[is_floor]
    floor = np.zeros(2 * tile, np.int64)
    floor[at] = p[is_floor]
    name = dict(zip(at.tolist(), table.column("source").filter(pa.array(is_floor)).to_pylist()))
    n = len(term.dictionary)
    grid = np.repeat(floor[:, None], n, axis=1)
    code = term.indices.fill_null(0).to_numpy(zero_copy_only=False)
    grid[place[~is_floor], code[~is_floor]] = p[~is_floor]
    rows = []
    here = sorted(name)
    for i in here:
        others = [j for j in here if j > i and (a == b or (i < tile <= j))]
        if others:
            value = np.abs(grid[others] - grid[i]).sum(axis=1)
            gap = np.abs(floor[others] - floor[i])
            rows += zip([name[i]] * len(others), [name[j] for j in others], value.tolist(), gap.tolist())
    terms = table.column("terms")[0].as_py()
    lang = table.column("lang")[0].as_py()
    columns = list(zip(*rows)) or [(), (), (), ()]
    return pa.table(
        {
            "lang": pa.array([lang] * len(rows), pa.string()),
            "one": pa.array(columns[0], pa.string()),
            "two": pa.array(columns[1], pa.string()),
            "value": pa.array(columns[2], pa.int64()),
            "seen": pa.array([n] * len(rows), pa.int64()),
            "gap": pa.array(columns[3], pa.int64()),
            "terms": pa.array([terms] * len(rows), pa.int64()),
        }
    )

"""Prefix trie of conversations: what conversations share from their first turn on.

A prefix is named by the exclusive or of hashes of its turns and their places, 128 bits in
all, so the name of every prefix follows from sums over a conversation that may be spread
over many tasks.  Nodes that more than ``SHARD_ROWS`` rows hang on are *spines*; the
conversations below a child of a spine go to one shard, which that bound keeps small.

A shard's trie is a string of balanced parentheses, laid out from its sorted paths.  Blocks
of it keep the least and the largest excess; ``findclose`` skips the blocks that cannot hold
the end of a subtree.  Counting the pairs ``()`` before both ends gives the leaves,
cumulative arrays over the nodes in their order the members and the tokens saved.

Spines are shared by shards.  They merge by their names: their members are counted over all
rows, and what their subtrees hold is summed up the trie by doubling, in as many rounds as
the logarithm of the longest spine.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tierflow.llm.common import stored
from tierflow.operators.joins import join_per_key

#: Rows below a child of a spine, at most; also the rows a task lays out at once.
SHARD_ROWS = 100_000
#: Parentheses in a block.
BLOCK = 64
#: Members' ids in one piece of a spine's list.
IDS = 10_000
#: How conversations are grafted: from the first of each hundred, up to five turns.
FAMILY, GRAFTS = 100, 6

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
SHARD_NODE = NODE + ", q1 long, q2 long"
_EMPTY = hashlib.sha256(b"").hexdigest()


def in_order(rows: DataFrame, key: str, order: list[Column], *sorting: str) -> DataFrame:
    """``rows`` with ``part`` and ``place``: written in the order of ``key`` and ``order``.

    A key may fill many parts; within a part the places of its rows follow each other.
    """
    ranged = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    # The number is given in the sorted tasks that write, and is read from then on.
    placed = stored(ranged.withColumn("place", F.monotonically_increasing_id()))
    return placed.withColumn("part", F.shiftright("place", 33))


def carried(rows: DataFrame, key: str, **sums: Column) -> DataFrame:
    """(key, part, first, and for each of ``sums`` what the key's earlier parts hold); one row per key and part."""
    per_part = rows.groupBy(key, "part").agg(F.min("place").alias("first"), F.count("*").alias("n"), *[c.alias(f"_{n}") for n, c in sums.items()])
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    every = [F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before")]
    every += [F.coalesce(F.bit_xor(f"_{n}").over(before), F.lit(0).cast("long")).alias(n) for n in sums]
    return per_part.select(key, "part", "first", "n", *every)


def numbered(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, at, t1, t2, chars): the turns of each conversation in their order, numbered from 1.

    ``t1`` and ``t2`` are hashes of role and text, whose nulls are empty; ``chars`` is the
    text's code points.  A null turn comes first; turns that share a number come in the order
    of the MD5 of role and text, so repeated rows are turns of their own.  Rows without a
    conversation's id belong to none and are left out.
    """
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    slim = turns.select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(role_, F.lit("\0"), text_))).alias("tie"),
        F.xxhash64(role_, text_).alias("t1"),
        F.xxhash64(F.lit(13), text_, role_).alias("t2"),
        F.char_length(text_).cast("long").alias("chars"),
    ).filter(F.col("conv").isNotNull())
    rows = in_order(slim, "conv", [F.col("turn").asc_nulls_first(), F.col("tie")])
    parts = stored(carried(rows, "conv"))
    at = F.col("place") - F.col("first") + F.col("n_before") + 1
    return join_per_key(rows, parts.select("conv", "part", "first", "n_before"), ["conv", "part"]).select("conv", at.alias("at"), "t1", "t2", "chars")


def grafted(rows: DataFrame) -> DataFrame:
    """The conversations of ``rows`` rebuilt: (conv, at, t1, t2, chars, n), and a row with a null ``at`` for each.

    Conversation c begins with the first h turns of conversation c - c % ``FAMILY``, where h
    is the CRC-32 of c's decimal digits modulo ``GRAFTS``, and goes on with its own turns after
    its first h.  ``n`` is the length of the rebuilt conversation, perhaps 0.
    """
    rows = stored(rows)
    giver = F.col("conv") - F.col("conv") % FAMILY
    take = (F.crc32(F.col("conv").cast("string")) % GRAFTS).alias("take")
    heads = rows.filter((F.col("conv") % FAMILY == 0) & (F.col("at") < GRAFTS)).withColumnRenamed("conv", "giver")
    given = heads.groupBy("giver").agg(F.max("at").alias("given"))
    convs = rows.groupBy("conv").agg(F.max("at").alias("own")).select("conv", giver.alias("giver"), take, "own")
    convs = convs.join(given, "giver", "left").withColumn("got", F.least("take", F.coalesce("given", F.lit(0)).cast("long")))
    n = F.col("got") + F.greatest(F.col("own") - F.col("take"), F.lit(0))
    convs = stored(convs.select("conv", "giver", "take", "got", n.alias("n")))
    first = convs.join(heads, "giver").filter("at <= take").select("conv", "at", "t1", "t2", "chars", "n")
    rest = join_per_key(rows, convs, ["conv"]).filter("at > take")
    rest = rest.select("conv", (F.col("at") - F.col("take") + F.col("got")).alias("at"), "t1", "t2", "chars", "n")
    none = F.lit(None).cast("long")
    return first.unionByName(rest).unionByName(convs.select("conv", none.alias("at"), none.alias("t1"), none.alias("t2"), none.alias("chars"), "n"))


def whole(rows: DataFrame) -> DataFrame:
    """``numbered`` rows as conversations of their own, in the form ``trie`` takes."""
    rows = stored(rows)
    sizes = stored(rows.groupBy("conv").agg(F.max("at").alias("n")))
    none = F.lit(None).cast("long")
    return join_per_key(rows, sizes, ["conv"]).unionByName(
        sizes.select("conv", "n", none.alias("at"), none.alias("t1"), none.alias("t2"), none.alias("chars"))
    )


def trie(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A row per node of the trie of ``rows`` (conv, at, t1, t2, chars, n; see ``grafted``).

    ``conv_id`` is the node's smallest member and ``parent_conv_id`` its parent's (null for
    the root), ``n_convs`` its members, ``n_children`` and ``n_leaves`` its children and the
    childless nodes in its subtree, ``saved_tokens`` the sum over its subtree of each node's
    members but one times the code points of its last text, and ``ends_sha256`` the hash of
    the decimal ids of the conversations that end here, in order and joined by commas.
    A table without conversations gives no rows.
    """
    turns = rows.filter(F.col("at").isNotNull())
    z = [F.xxhash64("t1", "t2", "at"), F.xxhash64(F.lit(13), "at", "t2", "t1")]
    placed = in_order(turns.select("conv", "at", "chars", "n", z[0].alias("z1"), z[1].alias("z2")), "conv", [F.col("at")])
    before = carried(placed, "conv", x1=F.bit_xor("z1"), x2=F.bit_xor("z2")).drop("first", "n", "n_before")
    so_far = Window.partitionBy("conv", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    paths = placed.withColumns({"s1": F.bit_xor("z1").over(so_far), "s2": F.bit_xor("z2").over(so_far)})
    p1, p2 = F.col("s1").bitwiseXOR(F.col("x1")), F.col("s2").bitwiseXOR(F.col("x2"))
    paths = join_per_key(paths, before, ["conv", "part"]).select("conv", "at", "chars", "n", p1.alias("p1"), p2.alias("p2"), "z1", "z2")
    above = [p.bitwiseXOR(z).alias(q) for p, z, q in ((F.col("p1"), F.col("z1"), "q1"), (F.col("p2"), F.col("z2"), "q2"))]
    paths = stored(paths.select("conv", "at", "chars", "n", "p1", "p2", *above))

    convs = rows.filter(F.col("at").isNull())
    nodes = paths.groupBy("p1", "p2").agg(
        F.sum(F.col("n") - F.col("at") + 1).alias("below"),
        *[F.first(c).alias(c) for c in ("at", "chars", "q1", "q2")],
        F.count("*").alias("n_convs"),
        F.min("conv").alias("conv_id"),
    )
    zero = F.lit(0).cast("long")
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id")).filter("n_convs > 0").select(
        zero.alias("p1"), zero.alias("p2"), zero.alias("at"), zero.alias("chars"), zero.cast("long").alias("q1"), zero.alias("q2"), "n_convs", "conv_id"
    )
    spines = stored(nodes.filter(F.col("below") > shard_rows).drop("below").unionByName(root))
    marked = join_per_key(paths, spines.select("p1", "p2", F.lit(True).alias("spine")), ["p1", "p2"], "left", measure=True)
    step = F.struct("at", "p1", "p2", "q1", "q2", "chars")
    light = marked.filter(F.col("spine").isNull()).groupBy("conv").agg(F.sort_array(F.collect_list(step)).alias("steps"))
    light = light.select("conv", "steps", F.col("steps")[0]["p1"].alias("r1"), F.col("steps")[0]["p2"].alias("r2"))
    light = light.repartition("r1", "r2").sortWithinPartitions("r1", "r2", "conv")
    light = light.select("r1", "r2", "conv", F.col("steps")[0]["at"].alias("at"), F.col("steps")[0]["q1"].alias("q1"), F.col("steps")[0]["q2"].alias("q2"), "steps.p1", "steps.p2", "steps.chars")
    shards = stored(light.mapInArrow(lambda batches: shard_nodes(batches, shard_rows), SHARD_NODE))
    merged = merged_spines(spines, shards, spine_ends(spines, paths, convs))
    mine = spines.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("above"))
    tops = shards.filter(F.col("q1").isNotNull()).join(mine, ["q1", "q2"]).withColumn("parent_conv_id", F.col("above"))
    names = [f.split()[0] for f in NODE.split(", ")]
    return shards.filter(F.col("q1").isNull()).select(*names).unionByName(tops.select(*names)).unionByName(merged.select(*names))


def shard_nodes(batches: Iterator[pa.RecordBatch], shard_rows: int) -> Iterator[pa.RecordBatch]:
    """The nodes of shards, which come one after another; many small ones are laid out as one forest."""
    convs, first_at, above, p1, p2, chars = [], [], [], [], [], []
    held, root = 0, None

    def done() -> pa.RecordBatch:
        out = forest(convs, first_at, above, p1, p2, chars)
        for part in (convs, first_at, above, p1, p2, chars):
            part.clear()
        return out

    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(6)]
        paths = [batch.column(k) for k in (6, 7, 8)]
        for k, (r1, r2, conv, at, q1, q2) in enumerate(zip(*columns)):
            if (r1, r2) != root and held >= shard_rows:
                yield done()
                held = 0
            root = (r1, r2)
            convs.append(conv)
            first_at.append(at)
            above.append((q1, q2))
            for out, path in zip((p1, p2, chars), paths):
                out.append(path[k].values.to_numpy())
            held += len(p1[-1])
    if convs:
        yield done()


def forest(convs: list[int], first_at: list[int], above: list[tuple[int, int]], p1: list, p2: list, chars: list) -> pa.RecordBatch:
    """The nodes of the conversations' paths below their spines, as rows of ``SHARD_NODE``.

    A path gives for each level the name of its prefix.  Tops of the forest have the name of
    their spine; the others have their parent's id instead.
    """
    keys = [np.stack([a, b], axis=1).astype(">i8").tobytes() for a, b in zip(p1, p2)]
    order = sorted(range(len(convs)), key=lambda i: (keys[i], convs[i]))
    size = np.array([len(p1[i]) for i in order])
    start = np.cumsum(size) - size
    a, b, c = (np.concatenate([x[i] for i in order]) for x in (p1, p2, chars))
    conv, base = np.array([convs[i] for i in order], np.int64), np.array([first_at[i] for i in order], np.int64)
    of = np.repeat(np.arange(len(order)), size)
    level = np.arange(len(a)) - start[of]

    # A step begins a node unless the path before has the same prefix at this level.
    before = np.where((of > 0) & (level < size[of - 1]), start[of - 1] + level, -1)
    new = (before < 0) | (a[before] != a) | (b[before] != b)
    firsts = np.flatnonzero(new)
    n = len(firsts)
    by_level = np.lexsort((of, level))
    number = np.where(new, np.cumsum(new) - 1, -1)
    node = np.empty(len(a), np.int64)
    node[by_level] = np.maximum.accumulate(number[by_level] + level[by_level] * n) - level[by_level] * n

    depth = level[firsts]
    opens, closes, shut = parentheses(depth)
    leaf = np.zeros(2 * n + 1, np.int64)
    leaf[1:][opens[closes == opens + 1]] = 1
    leaves = np.cumsum(leaf)
    n_leaves = leaves[closes + 1] - leaves[opens]
    after = np.arange(n) + (closes - opens + 1) // 2  # the first node behind the subtree
    parent = np.where(depth > 0, node[np.maximum(firsts - 1, 0)], -1)

    ends = node[start + size - 1]
    ended = np.concatenate([[0], np.cumsum(np.bincount(ends, minlength=n))])
    n_convs = ended[after] - ended[:-1]
    # Members are neighbours among the sorted paths.
    cuts = np.stack([ended[:-1], ended[after]], axis=1).ravel()
    smallest = np.minimum.reduceat(np.append(conv, conv.max()), cuts)[::2]
    saved = np.concatenate([[0], np.cumsum((n_convs - 1) * c[firsts])])
    children = np.bincount(parent[parent >= 0], minlength=n)
    hashes = [_EMPTY] * n
    for k in np.unique(ends).tolist():
        hashes[k] = hashlib.sha256(",".join(map(str, sorted(conv[ended[k] : ended[k + 1]].tolist()))).encode()).hexdigest()
    top = parent < 0
    spine = np.array(above, np.int64)[np.array(order)[of[firsts]]]
    columns = [
        pa.array(smallest),
        pa.array(base[of[firsts]] + depth),
        pa.array(smallest[parent], mask=top),
        pa.array(n_convs),
        pa.array(children),
        pa.array(n_leaves),
        pa.array(saved[after] - saved[:-1]),
        pa.array(hashes, pa.string()),
        *[pa.array(spine[:, k].copy(), mask=~top) for k in (0, 1)],
    ]
    return pa.record_batch([x.cast(pa.int64()) if k != 7 else x for k, x in enumerate(columns)], [f.split()[0] for f in SHARD_NODE.split(", ")])


def parentheses(depth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of nodes in preorder: where each opens, where it closes, and the string as bits (1 opens)."""
    n = len(depth)
    opens = 2 * np.arange(n) - depth
    bits = np.zeros(2 * n, np.int8)
    bits[opens] = 1
    return opens, find_close(bits, opens), bits


def find_close(bits: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """The place of the parenthesis that closes each of ``opens``.

    That is the first place behind it whose excess is one less.  The blocks' least and largest
    excess stand in a heap; a search leaves its block, climbs until a block to the right
    reaches down to that excess, goes down to the first such block, and looks through it.
    """
    excess = np.cumsum(2 * bits.astype(np.int64) - 1)
    width = 1 << max(0, (-(-len(bits) // BLOCK) - 1).bit_length())
    padded = np.full(width * BLOCK, np.int64(1) << 60)
    padded[: len(excess)] = excess
    blocks = padded.reshape(width, BLOCK)
    low, high = np.empty(2 * width, np.int64), np.empty(2 * width, np.int64)
    low[width:], high[width:] = blocks.min(axis=1), blocks.max(axis=1)
    span = width // 2
    while span:
        kids = slice(2 * span, 4 * span)
        low[span : 2 * span] = low[kids].reshape(-1, 2).min(axis=1)
        high[span : 2 * span] = high[kids].reshape(-1, 2).max(axis=1)
        span //= 2

    goal = excess[opens] - 1
    out = np.full(len(opens), -1, np.int64)

    def look(who: np.ndarray, place: np.ndarray) -> None:
        """Go through the rest of a block from ``place`` on."""
        while len(who):
            hit = padded[place] == goal[who]
            out[who[hit]] = place[hit]
            stay = ~hit & ((place + 1) % BLOCK != 0)
            who, place = who[stay], place[stay] + 1

    start = opens + 1
    inside = start % BLOCK != 0
    look(np.flatnonzero(inside), start[inside])
    who = np.flatnonzero(out < 0)
    if len(who):
        at = width + opens[who] // BLOCK
        moving = np.ones(len(who), bool)
        while moving.any():  # up, until the block to the right holds the goal
            here = at[moving]
            beside = here | 1
            right = (here != beside) & (low[beside] <= goal[who[moving]]) & (goal[who[moving]] <= high[beside])
            at[moving] = np.where(right, beside, here // 2)
            moving[np.flatnonzero(moving)[right]] = False
        while (at < width).any():  # down, to the first block that holds it
            inner = at < width
            kid = 2 * at[inner]
            at[inner] = np.where(low[kid] <= goal[who[inner]], kid, kid + 1)
        look(who, (at - width) * BLOCK)
    return out


def spine_ends(spines: DataFrame, paths: DataFrame, convs: DataFrame) -> DataFrame:
    """(p1, p2, ends_sha256) of the spines at which conversations end.

    The ids are put in order over the cluster and joined in pieces; one task hashes a node's
    pieces as they come.
    """
    zero = F.lit(0).cast("long")
    last = paths.filter("at = n").select("p1", "p2", "conv")
    last = last.join(spines.filter("at > 0").select("p1", "p2"), ["p1", "p2"], "left_semi")
    last = last.unionByName(convs.filter("n = 0").select(zero.alias("p1"), zero.alias("p2"), "conv"))
    rows = last.repartitionByRange("p1", "p2", "conv").sortWithinPartitions("p1", "p2", "conv")

    def pieces(batches):
        node, ids = None, []
        out = []

        def close():
            if ids:
                out.append((*node, ids[0], ",".join(map(str, ids))))
                ids.clear()

        for batch in batches:
            for p1, p2, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if (p1, p2) != node or len(ids) >= IDS:
                    close()
                    node = (p1, p2)
                ids.append(conv)
            yield from flushed(out)
        close()
        yield from flushed(out)

    def flushed(out):
        if out:
            columns = list(zip(*out))
            yield pa.record_batch([*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())], ["p1", "p2", "conv", "ids"])
            out.clear()

    def hashed(batches):
        node, state = None, None
        for batch in batches:
            out = []
            for p1, p2, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (p1, p2) == node:
                    state.update(b",")
                else:
                    if node:
                        out.append((*node, state.hexdigest()))
                    node, state = (p1, p2), hashlib.sha256()
                state.update(ids.encode())
            yield from finished(out)
        if node:
            yield from finished([(*node, state.hexdigest())])

    def finished(out):
        if out:
            columns = list(zip(*out))
            yield pa.record_batch([*[pa.array(c, pa.int64()) for c in columns[:2]], pa.array(columns[2], pa.string())], ["p1", "p2", "ends_sha256"])

    joined = rows.mapInArrow(pieces, "p1 long, p2 long, conv long, ids string")
    return joined.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "conv").mapInArrow(hashed, "p1 long, p2 long, ends_sha256 string")


def merged_spines(spines: DataFrame, shards: DataFrame, ends: DataFrame) -> DataFrame:
    """The spines' rows: what hangs on them summed up the trie."""
    children = spines.filter("at > 0").groupBy("q1", "q2").agg(F.count("*").alias("spine_children"))
    tops = shards.filter(F.col("q1").isNotNull()).groupBy("q1", "q2").agg(
        F.count("*").alias("light_children"), F.sum("n_leaves").alias("light_leaves"), F.sum("saved_tokens").alias("light_saved")
    )
    keyed = lambda df: df.withColumnsRenamed({"q1": "p1", "q2": "p2"})
    rows = spines.join(keyed(children), ["p1", "p2"], "left").join(keyed(tops), ["p1", "p2"], "left").join(ends, ["p1", "p2"], "left")
    count = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    n_children = count("spine_children") + count("light_children")
    rows = stored(
        rows.select(
            "p1", "p2", "q1", "q2", "at", "conv_id", "n_convs", n_children.alias("n_children"),
            (count("light_leaves") + (n_children == 0).cast("long")).alias("n_leaves"),
            (count("light_saved") + (F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
        )
    )
    deepest = rows.agg(F.max("at")).first()[0] or 0
    # After k rounds a node has the sum of those less than 2**k below it, and knows the one 2**k above it.
    up = F.when(F.col("at") > 0, F.struct("q1", "q2"))
    state = rows.select("p1", "p2", "n_leaves", "saved_tokens", up.alias("up"))
    for _ in range(int(deepest).bit_length()):
        known = F.col("up").isNotNull()
        given = state.filter(known).groupBy(F.col("up.q1").alias("p1"), F.col("up.q2").alias("p2"))
        given = given.agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        higher = state.select(F.col("p1").alias("h1"), F.col("p2").alias("h2"), F.col("up").alias("higher"))
        moved = state.join(higher, (F.col("up.q1") == F.col("h1")) & (F.col("up.q2") == F.col("h2")), "left")
        state = stored(
            moved.join(given, ["p1", "p2"], "left").select(
                "p1", "p2",
                (F.col("n_leaves") + count("more_leaves")).alias("n_leaves"),
                (F.col("saved_tokens") + count("more_saved")).alias("saved_tokens"),
                F.col("higher").alias("up"),
            )
        )
    sums = state.select("p1", "p2", "n_leaves", "saved_tokens")
    above = rows.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("above"))
    out = rows.drop("n_leaves", "saved_tokens").join(sums, ["p1", "p2"]).join(above, ["q1", "q2"], "left")
    return out.withColumn("depth", F.col("at")).withColumn("parent_conv_id", F.when(F.col("at") > 0, F.col("above")))

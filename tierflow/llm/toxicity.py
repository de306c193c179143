"""A convolutional toxicity classifier, trained in numpy.

A word's embedding is the sum of hashed embeddings: of the word and of its first bytes,
so that inflected forms share some.  Filters of one, two and three words run over the
embedded text; each filter's largest value in the text, if positive, is a feature of a
logistic model.  It learns from all labelled rows: a quarter of them, by a hash of their
ids, is kept for calibration, the others are dealt to shards.  In each pass every shard
goes on from the same network by itself, and their changes are averaged.  The score is
calibrated on the counts of the kept rows' logits.

The score sees the text alone.  A document's language only chooses the threshold, which
is calibrated per language on the same rows; the score at 0.5 is the plain decision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tierflow.llm.common import copy_key, forget, give_back, map_rows, stored, stretches
from tierflow.llm.words import word_features

BUCKETS = 1 << 18
DIM = 16
FILTERS = 16
WIDTHS = (1, 2, 3)
PREFIXES = (4, 6)
#: Labels sent to all executors, so that texts are not shuffled to find theirs; more are joined by a shuffle.
LABELS_SENT = 1_000_000
#: Bytes of training text a shard, and the most shards; beyond them shards grow.
SHARD_BYTES = 32_000_000
SHARDS = 48
#: Bytes of text, in the order of a hash, that are shuffled and learned from at once; a longer text by itself.
LEARNED_BYTES = 4_000_000
#: Bytes of text scored at once; a longer text by itself.
SCORED_BYTES = 1_000_000
SEED = 7
EPOCHS = 6
#: Texts of a step; fewer if they have over ``CHUNK_WORDS`` words.
BATCH = 32
RATE = 0.2
#: Training texts a bucket must be in to be learned.
LEAST_DOCS = 3
#: Share of a text's words left out at random in a step, so that no word hides behind another.
LEFT_OUT = 0.4
#: Words scored at once.
CHUNK_WORDS = 100_000
#: Parts of one that changes are rounded to, so that their sum does not depend on its order; the same of logits.
CHANGE_PARTS = 1 << 20
LOGIT_PARTS = 1 << 9
#: Bounds and default of a language's threshold.
THRESHOLDS = (0.3, 0.7)


@dataclass
class Model:
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: float
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        """What is sent to tasks: of the buckets only those that are not zero."""
        at = np.flatnonzero(self.embedding.any(axis=1))
        return self.__dict__ | {"embedding": (at.astype(np.int32), self.embedding[at])}

    def __setstate__(self, state: dict) -> None:
        at, known = state["embedding"]
        self.__dict__ |= state | {"embedding": np.zeros((BUCKETS, DIM), np.float32)}
        self.embedding[at] = known

    def embedded(self, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The texts' embeddings end to end, each followed by zeros; where texts start; which rows are zeros."""
        pad = max(WIDTHS) - 1
        sizes = counts + pad
        starts = np.cumsum(sizes) - sizes
        rows = np.arange(len(words)) + np.repeat(pad * np.arange(len(counts)), counts)
        out = np.zeros((int(sizes.sum()), DIM), np.float32)
        value = self.embedding[words[:, 0]]
        for k in range(1, words.shape[1]):
            value += self.embedding[words[:, k]]
        out[rows] = value
        blank = np.ones(len(out), bool)
        blank[rows] = False
        return out, starts, blank

    def convolved(self, embedded: np.ndarray, blank: np.ndarray) -> list[np.ndarray]:
        """Each filter's values; from behind a text's end on it sees nothing, not the next text."""
        out = []
        for width, filters, bias in zip(WIDTHS, self.filters, self.biases):
            value = embedded @ filters[0]
            for k in range(1, width):
                value[:-k] += embedded[k:] @ filters[k]
            value[blank] = 0
            out.append(value + bias)
        return out

    def pooled(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        embedded, starts, blank = self.embedded(words, counts)
        top = [np.maximum.reduceat(value, starts, axis=0) for value in self.convolved(embedded, blank)]
        return np.maximum(np.concatenate(top, axis=1), 0)

    def raw(self, texts: list[bytes]) -> np.ndarray:
        """Uncalibrated logits, worked out over a bounded number of words at a time."""
        words, counts = word_features(texts, PREFIXES, BUCKETS)
        out = np.empty(len(texts))
        at, low = 0, 0
        total = np.cumsum(counts)
        while low < len(texts):
            high = max(low + 1, int(np.searchsorted(total, at + CHUNK_WORDS, "right")))
            part = words[at : total[high - 1]]
            if high == low + 1 and len(part) > CHUNK_WORDS:
                out[low] = self._long(part) @ self.weights + self.bias
            else:
                out[low:high] = self.pooled(part, counts[low:high]) @ self.weights + self.bias
            at, low = int(total[high - 1]), high
        return out

    def _long(self, words: np.ndarray) -> np.ndarray:
        """A text of many words, pooled over overlapping stretches."""
        top = np.zeros(len(WIDTHS) * FILTERS)
        overlap = max(WIDTHS) - 1
        for at in range(0, len(words), CHUNK_WORDS):
            part = words[at : at + CHUNK_WORDS + overlap]
            embedded, _, blank = self.embedded(part, np.array([len(part)]))
            # Only the text's own end is followed by nothing.
            end = None if at + CHUNK_WORDS >= len(words) else CHUNK_WORDS
            values = [value[:end].max(axis=0) for value in self.convolved(embedded, blank)]
            top = np.maximum(top, np.concatenate(values))
        return top

    def score(self, texts: list[bytes]) -> np.ndarray:
        slope, shift = self.scale
        return sigmoid(self.raw(texts) * slope + shift)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def blank(used: np.ndarray) -> tuple[Model, dict]:
    """A network of zeros and its Adagrad sums; buckets that are not ``used`` stay so."""

    def arrays() -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray], np.ndarray]:
        filters = [np.zeros((w, DIM, FILTERS), np.float32) for w in WIDTHS]
        return np.zeros((BUCKETS, DIM), np.float32), filters, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], np.zeros(FILTERS * len(WIDTHS))

    return Model(*arrays(), 0.0), dict(zip("efbw", arrays())) | {"o": 0.0, "used": used}


def begun(used: np.ndarray, seed: int = SEED) -> tuple[Model, dict]:
    """A network before training and its Adagrad sums; buckets that are not ``used`` are zero and stay so."""
    rng = np.random.default_rng(seed)
    model, seen = blank(used)
    model.embedding[used] = rng.normal(0, 0.1, (BUCKETS, DIM))[used]
    model.filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    model.weights = np.abs(rng.normal(0, 0.3, FILTERS * len(WIDTHS)))
    for array in (seen["e"], *seen["f"], *seen["b"], seen["w"]):
        array += 0.1
    seen["o"] = 0.1
    return model, seen


def flat(model: Model, seen: dict) -> np.ndarray:
    """A network in training as rows of ``DIM`` numbers and as many Adagrad sums: used buckets first, then all else."""

    def rows(embedding, filters, biases, weights, bias) -> np.ndarray:
        rest = np.concatenate([*(f.ravel() for f in filters), *biases, weights, [bias]])
        rest = np.append(rest, np.zeros(-len(rest) % DIM)).reshape(-1, DIM).astype(np.float32)
        return np.concatenate([embedding[seen["used"]], rest])

    own = rows(model.embedding, model.filters, model.biases, model.weights, model.bias)
    return np.concatenate([own, rows(*(seen[k] for k in "efbwo"))], axis=1)


def opened(used: np.ndarray, table: np.ndarray) -> tuple[Model, dict]:
    """The network that ``flat`` made a table of."""
    model, seen = blank(used)
    known = int(used.sum())
    for half, (embedding, filters, biases, weights) in enumerate(
        [(model.embedding, model.filters, model.biases, model.weights), (seen["e"], seen["f"], seen["b"], seen["w"])]
    ):
        part = table[:, half * DIM : (half + 1) * DIM]
        embedding[used] = part[:known]
        rest, at = part[known:].ravel(), 0
        for array in (*filters, *biases, weights):
            array[...] = rest[at : at + array.size].reshape(array.shape)
            at += array.size
        if half:
            seen["o"] = float(rest[at])
        else:
            model.bias = float(rest[at])
    return model, seen


def learn(model: Model, seen: dict, texts: list[bytes], toxic: np.ndarray, balance: np.ndarray, rng: np.random.Generator) -> None:
    """One pass over ``texts`` by Adagrad on the logistic loss.

    Only the place where a filter is largest gets a gradient.  Buckets in fewer than
    ``LEAST_DOCS`` training texts stay zero: unknown words say nothing, and texts are not
    learned by heart from their rare words.  Output weights stay positive, so that harmless
    words cannot outweigh others.
    """
    column = pa.array(texts, pa.binary())
    found = [word_features(part, PREFIXES, BUCKETS) for _, part in stretches(column, SCORED_BYTES)]
    words = np.concatenate([x for x, _ in found])
    counts = np.concatenate([x for _, x in found])
    firsts = np.cumsum(counts) - counts
    order = rng.permutation(len(texts))
    low = 0
    while low < len(order):
        total = np.cumsum(counts[order[low : low + BATCH]])
        rows = order[low : low + max(1, int(np.searchsorted(total, CHUNK_WORDS, "right")))]
        low += len(rows)
        parts = [words[firsts[r] : firsts[r] + counts[r]] for r in rows]
        parts = [part[rng.random(len(part)) >= LEFT_OUT] for part in parts]
        left = np.array([len(part) for part in parts])
        _step(model, np.concatenate(parts), left, toxic[rows], balance[toxic[rows].astype(int)], seen)


def _step(model: Model, words: np.ndarray, counts: np.ndarray, toxic: np.ndarray, balance: np.ndarray, seen: dict) -> None:
    embedded, starts, blank = model.embedded(words, counts)
    ends = np.append(starts[1:], len(embedded))
    places, tops = [], []
    for value in model.convolved(embedded, blank):
        place = np.stack([value[a:b].argmax(0) + a for a, b in zip(starts, ends)])
        places.append(place)
        tops.append(np.take_along_axis(value, place, 0))
    features = np.maximum(np.concatenate(tops, axis=1), 0)
    error = (sigmoid(features @ model.weights + model.bias) - toxic) * balance / len(counts)
    back = error[:, None] * model.weights * (features > 0)

    grad = features.T @ error + 1e-5 * model.weights
    seen["w"] += grad**2
    model.weights = np.maximum(model.weights - RATE * grad / np.sqrt(seen["w"]), 0)
    seen["o"] += error.sum() ** 2
    model.bias -= float(RATE * error.sum() / seen["o"] ** 0.5)

    into = np.zeros_like(embedded)
    last = len(embedded) - 1
    for k, width in enumerate(WIDTHS):
        g = back[:, k * FILTERS : (k + 1) * FILTERS].astype(np.float32)
        grads = np.empty_like(model.filters[k])
        for j in range(width):
            at = np.minimum(places[k] + j, last)
            inside = ((places[k] + j <= last) & ~blank[places[k]])[..., None]
            seen_rows = embedded[at] * inside
            grads[j] = np.einsum("df,dfe->ef", g, seen_rows)
            np.add.at(into, at, g[..., None] * model.filters[k][j].T * inside)
        seen["f"][k] += grads**2
        model.filters[k] -= RATE * grads / np.sqrt(seen["f"][k])
        gb = g.sum(0)
        seen["b"][k] += gb**2
        model.biases[k] -= RATE * gb / np.sqrt(seen["b"][k])

    pad = max(WIDTHS) - 1
    rows = np.arange(len(words)) + np.repeat(pad * np.arange(len(counts)), counts)
    grads = into[rows]
    live = np.flatnonzero(np.abs(grads).sum(1))
    if len(live):
        at, group = np.unique(words[live], return_inverse=True)
        total = np.zeros((len(at), DIM), np.float32)
        np.add.at(total, group.reshape(len(live), -1), grads[live][:, None, :])
        known = seen["used"][at]
        at, total = at[known], total[known]
        seen["e"][at] += total**2
        model.embedding[at] -= RATE * total / np.sqrt(seen["e"][at])


def calibrate(model: Model, raw: np.ndarray, toxic: np.ndarray, weight: np.ndarray, langs: np.ndarray) -> None:
    """Fit the score's slope and shift (Platt) and a threshold per language to logits that stand for ``weight`` rows each."""
    slope, shift = 1.0, 0.0
    share = np.average(toxic, weights=weight)
    edge = 1 / (2 + weight.sum())
    target = np.where(toxic == 1, 1 - edge, edge)
    if 0 < share < 1:
        mean = np.average(raw, weights=weight)
        spread = max(np.average((raw - mean) ** 2, weights=weight) ** 0.5, 1e-6)
        z, a, b = raw / spread, 1.0, 0.0
        for _ in range(300):
            p = sigmoid(a * z + b)
            g = weight * (p - target)
            h = np.maximum(weight * p * (1 - p), 1e-9)
            ga, gb = (g * z).sum() + 1e-3 * a, g.sum()
            haa, hab, hbb = (h * z * z).sum() + 1e-3, (h * z).sum(), h.sum() + 1e-6
            det = max(haa * hbb - hab * hab, 1e-9)
            da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
            step = min(1.0, 2 / max(abs(da), abs(db), 1e-9))
            a, b = max(a - step * da, 0.05), b - step * db
            if max(abs(da), abs(db)) < 1e-6:
                break
        slope, shift = a / spread, b
    model.scale = (float(slope), float(shift))
    score = sigmoid(raw * slope + shift)
    for lang in sorted({x for x in langs if x is not None}):
        of = langs == lang
        if len(set(toxic[of])) == 2:
            model.thresholds[lang] = _threshold(score[of], toxic[of], weight[of])


def _threshold(score: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> float:
    """The cut within ``THRESHOLDS`` with the least weighted error, the nearest to 0.5 of those."""
    cuts = np.linspace(*THRESHOLDS, 41)
    errors = [(weight * ((score >= c) != toxic)).sum() for c in cuts]
    best = min(errors)
    return float(min((c for c, e in zip(cuts, errors) if e <= best + 1e-12), key=lambda c: abs(c - 0.5)))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    lang: str | None = "lang",
    rows_per_class: int | None = None,
    class_bytes: int | None = None,
) -> tuple[DataFrame, dict[int, int]]:
    """(id, toxic, text, lang, size) of the rows to learn from, and how many labelled rows each class has.

    Without bounds, as ``fit`` calls it, that is every labelled row, and the same row may
    come more than once.  With a bound of each class rows are taken in the order of a hash
    of their ids, whatever their length: ``rows_per_class`` of them, fewer if their whole
    texts pass ``class_bytes``, one at least; of rows that share an id one is taken.
    """
    known = stored(labelled(labels, id_column))
    if known.count() <= LABELS_SENT:
        known = F.broadcast(known)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("size")
    sized = docs.select(F.col(id_column).alias("id"), size)
    present = sized.join(known, "id").dropDuplicates(["id", "toxic"])
    language = F.col(lang) if lang else F.lit(None)
    source = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), language.cast("string").alias("lang"), size)
    if rows_per_class is None and class_bytes is None:
        of_class = {x["toxic"]: x["count"] for x in present.groupBy("toxic").count().collect()}
        return source.join(known, "id").select("id", "toxic", "text", "lang", "size"), of_class
    present = stored(present)
    of_class = {x["toxic"]: x["count"] for x in present.groupBy("toxic").count().collect()}
    before = Window.partitionBy("toxic").orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, -1)
    drawn = None
    for toxic in (0, 1):
        part = present.filter(F.col("toxic") == toxic).orderBy(F.xxhash64("id"), "id")
        part = part if rows_per_class is None else part.limit(rows_per_class)
        drawn = part if drawn is None else drawn.unionAll(part)
    drawn = drawn.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    fits = F.lit(True) if class_bytes is None else F.col("before") + F.col("size") <= class_bytes
    taken = drawn.filter((F.col("before") == 0) | fits).select("id", "toxic")
    found = source.join(F.broadcast(taken), "id")
    return found.dropDuplicates(["id", "toxic"]).select("id", "toxic", "text", "lang", "size"), of_class


def labelled(labels: DataFrame, id_column: str) -> DataFrame:
    """(id, toxic) of the labels that may be learned from."""
    known = labels.select(F.col(id_column).alias("id"), F.col("toxic").cast("int").alias("toxic"))
    return known.filter(~held_out("id") & F.col("toxic").isin(0, 1)).distinct()


def held_out(id_column: str):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str | None = "lang") -> Model | None:
    """A model trained and calibrated on all labelled rows; None if the labels do not hold both classes.

    Rows of one id and text count once.  Labels of both classes of which no more than one
    class has documents are an error, since without a model everything would count as clean.
    """
    rows, of_class = labelled_sample(docs, labels, id_column, text, lang)
    if len(of_class) < 2:
        classes = labelled(labels, id_column).select("toxic").distinct().count()
        if classes == 2 and not docs.isEmpty():
            raise ValueError("the labels hold both classes, but the documents with labels do not")
        return None
    kept = F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(4)) == 0
    share = rows.groupBy(kept.alias("kept"), "toxic").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()
    apart = len(share) == 4
    used_for = [x for x in share if not (apart and x["kept"])]
    size = sum(x["size"] for x in used_for)
    n = np.array([sum(x["n"] for x in used_for if x["toxic"] == t) for t in (0, 1)], float)
    model = trained(rows.filter(~kept) if apart else rows, min(SHARDS, 1 + size // SHARD_BYTES), 0.5 * n.sum() / n)
    calibrate(model, *logits(rows.filter(kept) if apart else rows, model))
    return model


def trained(rows: DataFrame, shards: int, balance: np.ndarray) -> Model:
    """A network from all ``rows`` (id, toxic, text), its score not yet calibrated.

    ``balance`` is the weight of a row of each class.  A shard's rows stay on the disks of
    the executors from pass to pass.  What leaves a shard is bounded by the network: its
    changes, which are averaged over the shards that changed the same row.
    """
    order = F.xxhash64("id")
    dealt = (
        rows.select(F.pmod(order, F.lit(shards)).cast("int").alias("shard"), order.alias("order"), "id", "toxic", "text")
        .repartitionById(shards, "shard")
        .sortWithinPartitions("order", "id", "toxic", "text")
        .select("shard", "id", "toxic", "text")
        .persist(StorageLevel.DISK_ONLY)
    )
    try:
        used = known_buckets(dealt)
        table = flat(*begun(used))
        for turn in range(EPOCHS):
            change(dealt, used, table, balance, turn)
    finally:
        dealt.unpersist()
    return opened(used, table)[0]


def blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """(shard, texts, toxic) of stretches of a shard's sorted rows, rows that come again left out."""
    last, shard, size, texts, toxic = None, 0, 0, [], []
    for batch in batches:
        ids, marks, column = batch.column(1), batch.column(2), batch.column(3).cast(pa.binary())
        for k in range(batch.num_rows):
            text = column[k].as_py()
            row = (ids[k].as_py(), marks[k].as_py(), text)
            if row == last:
                continue
            if texts and size + len(text) > limit:
                yield shard, texts, np.array(toxic, float)
                size, texts, toxic = 0, [], []
            last, shard, size = row, batch.column(0)[k].as_py(), size + len(text)
            texts.append(text)
            toxic.append(row[1])
    if texts:
        yield shard, texts, np.array(toxic, float)


def known_buckets(dealt: DataFrame) -> np.ndarray:
    """Which buckets are in ``LEAST_DOCS`` of the texts or more."""

    def run(batches):
        forget()
        total = np.zeros(BUCKETS, np.int64)
        for _, texts, _ in blocks(batches, SCORED_BYTES):
            words, counts = word_features(texts, PREFIXES, BUCKETS)
            of = np.repeat(np.arange(len(texts)), counts * words.shape[1])
            total += np.bincount(np.unique(of * BUCKETS + words.ravel()) % BUCKETS, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    counts = dealt.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    used = np.zeros(BUCKETS, bool)
    used[counts.filter(F.col("n") >= LEAST_DOCS).select("bucket").toArrow()["bucket"].to_numpy()] = True
    return used


def change(dealt: DataFrame, used: np.ndarray, table: np.ndarray, balance: np.ndarray, turn: int) -> None:
    """Change ``table`` by one pass, averaged over the shards that changed a row.

    The network is broadcast for the pass and then taken away again everywhere, so that
    neither the driver nor the executors hold those of the passes before.
    """
    names = [f"c{k}" for k in range(table.shape[1])]
    network = dealt.sparkSession.sparkContext.broadcast((used, table))

    def run(batches):
        forget()
        model, rng = None, None
        for shard, texts, toxic in blocks(batches, LEARNED_BYTES):
            if model is None:
                model, seen = opened(*network.value)
                rng = np.random.default_rng([SEED, turn, shard])
            learn(model, seen, texts, toxic, balance, rng)
        if model is not None:
            change = np.rint((flat(model, seen) - network.value[1]) * CHANGE_PARTS).astype(np.int64)
            at = np.flatnonzero(change.any(axis=1))
            columns = [pa.array(at.astype(np.int32)), *(pa.array(change[at, k]) for k in range(len(names)))]
            yield pa.record_batch(columns, ["at", *names])
            del texts, toxic, model, seen, change, columns
        give_back()

    kind = ", ".join(["at int", *(f"{c} long" for c in names)])
    mean = [(F.sum(c) / F.count("*") / CHANGE_PARTS).cast("float").alias(c) for c in names]
    try:
        found = dealt.mapInArrow(run, kind).groupBy("at").agg(*mean).toArrow()
    finally:
        network.destroy()
    at = found["at"].to_numpy()
    for k, name in enumerate(names):
        table[at, k] += found[name].to_numpy()
    del found
    give_back()


def logits(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(logit, toxic, number of rows, lang): the uncalibrated logits of all ``rows``, rounded and counted."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw = np.concatenate([model.raw(part) for _, part in stretches(batch.column(4), SCORED_BYTES)])
        part = np.rint(raw * LOGIT_PARTS).astype(np.int64)
        yield pa.record_batch([*(batch.column(k) for k in range(4)), pa.array(part)], ["id", "copy", "toxic", "lang", "part"])

    marked = rows.select("id", copy_key().alias("copy"), "toxic", "lang", "text")
    kind = T.StructType([*marked.drop("text").schema, T.StructField("part", T.LongType())])
    once = map_rows(marked, run, kind).dropDuplicates(["id", "copy", "toxic"])
    found = once.groupBy("lang", "toxic", "part").count().orderBy("part", "toxic", "lang").toArrow()
    part, toxic, count = (found[c].to_numpy().astype(float) for c in ("part", "toxic", "count"))
    return part / LOGIT_PARTS, toxic, count, np.array(found["lang"].to_pylist(), object)


def scored(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text: str = "text", lang: str | None = "lang") -> DataFrame:
    """(doc_id, held_out, score, predicted, threshold, rejected) for every row of ``docs``.

    ``predicted`` is the score at 0.5; ``rejected`` is the score at the threshold of the
    row's language (0.5 for one without).  A null or empty text has the score of no words;
    without a model every score is 0.  A null id is not held out.  Repeated rows give a
    row each; other columns are not carried.
    """
    language = F.col(lang) if lang else F.lit(None)
    slim = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"), language.cast("string").alias("lang"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        langs = batch.column(2).to_pylist()
        columns = [batch.column(0), pa.array(scores(model, batch.column(1))), pa.array(cuts(model, langs))]
        yield pa.record_batch(columns, ["doc_id", "score", "threshold"])

    kind = T.StructType([slim.schema["doc_id"], *T.StructType.fromDDL("score double, threshold double")])
    return map_rows(slim, run, kind).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "threshold",
        (F.col("score") >= F.col("threshold")).alias("rejected"),
    )


def scores(model: Model | None, texts: pa.Array) -> np.ndarray:
    """The score of each whole text, worked out over a bounded number of bytes at a time."""
    out = np.zeros(len(texts))
    for low, part in stretches(texts, SCORED_BYTES):
        out[low : low + len(part)] = model.score(part) if model else 0.0
    return out


def cuts(model: Model | None, langs: list[str | None]) -> np.ndarray:
    return np.array([model.thresholds.get(x, 0.5) if model else 0.5 for x in langs], float)


def without_toxic(docs: DataFrame, model: Model | None, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that the model does not reject, all their columns kept.

    A null or empty text has the score of no words, a null language the threshold 0.5.
    Repeated rows are judged each, an empty table gives none.  Without a model, which
    ``fit`` gives only where no labels of both classes exist, all rows stay.
    """
    if model is None:
        return docs

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        forget()
        return pa.array(scores(model, texts))

    # Rows stay where they are: only texts go to Python, and only scores come back.
    cut = F.lit(0.5)
    for name, threshold in sorted(model.thresholds.items()):
        cut = F.when(F.col(lang).cast("string") == name, F.lit(threshold)).otherwise(cut)
    return docs.filter(score(F.col(text).cast("string")) < cut)

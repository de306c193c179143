"""Learned decision lists over text statistics.

Sequential covering: rules for low quality are learned one after another from labelled
statistics.  A rule is a conjunction of thresholds.  It is grown on one part of the
labelled rows by information gain, then pruned on the other part, and kept while it is
precise enough there; rows it covers are taken out before the next rule.  The list is
emitted as one ordered ``CASE WHEN``.

Statistics and verdicts are DataFrame functions.  The labelled sample is bounded, and only
its numbers, not its texts, reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame, functions as F

#: Words are runs of anything but these bytes of white space.
BLANK = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Bound of the labelled sample, in rows.
LABELLED_ROWS = 6_000
MAX_RULES = 12
MAX_CONDITIONS = 4
#: A rule must be right on this share of the pruning rows it covers, and cover so many.
PRECISION = 0.9
COVERAGE = 3

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE_COUNTS = ("n_lines", "n_upper", "n_marks", "n_distinct")


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, stat_<count>...): the counts of ``COUNTS`` and ``MORE_COUNTS``, and the other columns.

    A null text has none of anything.  The counts come out of a generator: a filter on them
    would otherwise be pushed into their making, and worked out once per word.
    """
    plain = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(plain, f"[{BLANK}]+"), lambda w: w != "")
    lines = F.filter(F.split(plain, "\n"), lambda line: line.rlike(f"[^{BLANK}]"))
    first = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row"),
        F.transform(words, lambda w: F.xxhash64(w)).alias("words"),
        F.transform(lines, lambda line: F.xxhash64(line, F.length(line))).alias("lines"),
        F.length(F.regexp_replace(plain, f"[{BLANK}]+", "")).cast("long").alias("word_chars"),
        _removed(plain, SYMBOLS).alias("n_symbols"),
        _removed(plain, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"),
        _removed(plain, "!").alias("n_marks"),
    )
    n = F.size("words")
    windows = F.when(
        n >= WINDOW,
        F.transform(
            F.slice("words", F.lit(1), n - (WINDOW - 1)),
            lambda word, i: F.xxhash64(word, *[F.get("words", i + k) for k in range(1, WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<long>"))
    second = first.withColumn("windows", windows)
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    in_order = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    third = second.withColumn("in_order", F.when(twice, in_order))

    def repeated(x: Column, i: Column) -> Column:
        beside = (F.get("in_order", i + k)["h"] == x["h"] for k in (-1, 1))
        before, after = (F.coalesce(same, F.lit(False)) for same in beside)
        return before | after

    places = F.sort_array(F.transform(F.filter("in_order", repeated), lambda x: x["at"]))
    fourth = third.withColumn("places", places)
    covered = F.aggregate(
        F.transform(
            "places",
            lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get("places", i + 1) - at, F.lit(WINDOW))),
        ),
        F.lit(0),
        lambda a, b: a + b,
    )
    counts = {
        "n_words": n,
        "word_chars": F.col("word_chars"),
        "n_symbols": F.col("n_symbols"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": F.size("lines"),
        "n_upper": F.col("n_upper"),
        "n_marks": F.col("n_marks"),
        "n_distinct": F.size(F.array_distinct("words")),
    }
    found = F.struct(*[value.cast("long").alias(stat(name)) for name, value in counts.items()])
    return fourth.select("row", F.inline(F.array(found)))


def stat(name: str) -> str:
    return f"stat_{name}"


def _removed(plain: Column, characters: str) -> Column:
    return (F.length(plain) - F.length(F.translate(plain, characters, ""))).cast("long")


def features() -> dict[str, Column]:
    """The numbers rules are made of."""
    s = {name: F.col(stat(name)) for name in (*COUNTS, *MORE_COUNTS)}
    words, chars = F.greatest(s["n_words"], F.lit(1)), F.greatest(s["word_chars"], F.lit(1))
    return {
        "words": s["n_words"].cast("double"),
        "chars_per_word": s["word_chars"] / words,
        "symbols_per_word": s["n_symbols"] / words,
        "dup_lines": s["n_dup_lines"] / F.greatest(s["n_lines"], F.lit(1)),
        "repeated_words": s["n_repeat_words"] / words,
        "upper": s["n_upper"] / chars,
        "marks": s["n_marks"] / words,
        "distinct_words": s["n_distinct"] / words,
    }


def base_failed() -> Column:
    words, repeated = F.col(stat("n_words")), F.col(stat("n_repeat_words"))
    return (words < 20) | (100 * repeated > 30 * words)


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    cut: float

    def holds(self, row: dict[str, float]) -> bool:
        return row[self.feature] >= self.cut if self.at_least else row[self.feature] < self.cut

    def column(self, found: dict[str, Column]) -> Column:
        value = found[self.feature]
        return value >= self.cut if self.at_least else value < self.cut


Rule = tuple[Condition, ...]


def learn(rows: list[tuple[dict[str, float], bool]]) -> list[Rule]:
    """Rules for the rows marked True, by growing and pruning; every third row is for pruning."""
    grow = [r for i, r in enumerate(rows) if i % 3]
    prune = [r for i, r in enumerate(rows) if i % 3 == 0]
    rules: list[Rule] = []
    while len(rules) < MAX_RULES and any(bad for _, bad in grow):
        rule = _prune(_grow(grow), prune)
        hit = [bad for row, bad in prune if _covers(rule, row)]
        if not rule or len(hit) < COVERAGE or sum(hit) < PRECISION * len(hit):
            break
        rules.append(rule)
        grow = [r for r in grow if not _covers(rule, r[0])]
        prune = [r for r in prune if not _covers(rule, r[0])]
    return rules


def _covers(rule: Rule, row: dict[str, float]) -> bool:
    return all(c.holds(row) for c in rule)


def _grow(rows: list) -> Rule:
    rule: Rule = ()
    while len(rule) < MAX_CONDITIONS and not all(bad for _, bad in rows):
        best = max((_best_cut(rows, name) for name in rows[0][0]), key=lambda x: x[0], default=(0, None))
        if best[0] <= 0:
            break
        rule += (best[1],)
        rows = [r for r in rows if best[1].holds(r[0])]
    return rule


def _best_cut(rows: list, name: str) -> tuple[float, Condition | None]:
    """The condition on one number that gains most, from one pass in its order."""
    values = sorted((row[name], bad) for row, bad in rows)
    total, bads = len(values), sum(bad for _, bad in values)
    if not bads:
        return 0.0, None
    prior = log2(bads / total)
    best: tuple[float, Condition | None] = (0.0, None)
    below = below_bad = 0
    for i, (value, bad) in enumerate(values):
        if i and value > values[i - 1][0]:
            cut = (value + values[i - 1][0]) / 2
            for at_least, n, p in ((False, below, below_bad), (True, total - below, bads - below_bad)):
                if p and (gain := p * (log2(p / n) - prior)) > best[0]:
                    best = (gain, Condition(name, at_least, cut))
        below += 1
        below_bad += bad
    return best


def _prune(rule: Rule, rows: list) -> Rule:
    """The rule cut behind the condition where (right - wrong) / covered is best."""

    def worth(candidate: Rule) -> float:
        hit = [bad for row, bad in rows if _covers(candidate, row)]
        return (2 * sum(hit) - len(hit)) / len(hit) if hit else -1.0

    cuts = [rule[:n] for n in range(1, len(rule) + 1)]
    return max(cuts, key=lambda c: (worth(c), -len(c)), default=())


def verdict(rules: list[Rule]) -> tuple[Column, Column]:
    """(kept, number of the first rule that holds, null if none) as ordered conditionals."""
    found = features()
    kept, which = None, None
    for i, rule in enumerate(rules, 1):
        holds = F.lit(True)
        for condition in rule:
            holds = holds & condition.column(found)
        kept = F.when(holds, F.lit(False)) if kept is None else kept.when(holds, F.lit(False))
        which = F.when(holds, F.lit(i)) if which is None else which.when(holds, F.lit(i))
    if kept is None:
        return F.lit(True), F.lit(None).cast("int")
    return kept.otherwise(F.lit(True)), which


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", rows: int = LABELLED_ROWS) -> list[Rule]:
    """Rules from at most ``rows`` labelled rows, taken by the order of a hash of their ids.

    Labels without a document are left out before the rows are taken.
    """
    known = labels.select(F.col(id_column).alias("id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter(F.col("quality").isin(0, 1) & F.col("id").isNotNull()).distinct()
    known = known.join(docs.select(F.col(id_column).alias("id")), "id", "left_semi")
    drawn = known.orderBy(F.xxhash64("id"), "id", "quality").limit(rows)
    source = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    stats = statistics(source.join(F.broadcast(drawn), "id"))
    found = stats.select(
        F.col("row.id").alias("id"),
        (F.col("row.quality") == 0).alias("bad"),
        base_failed().alias("failed"),
        *[c.alias(name) for name, c in features().items()],
    ).filter("not failed")
    names = list(features())
    taken = sorted(found.collect(), key=lambda r: (hash_order(r["id"]), r["bad"]))
    return learn([({n: r[n] for n in names}, r["bad"]) for r in taken])


def hash_order(value: int) -> int:
    """A fixed order that has nothing to do with the ids' own."""
    return int(value) * 0x9E3779B97F4A7C15 % (1 << 64)


def judged(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, with counts, ``base_failed``, ``kept`` and ``rule``.

    They replace columns of those names.  ``rule`` numbers the rule that rejected the row.  A
    null or empty text has no words and so fails the base; repeated rows are judged each; an
    empty table gives no rows.
    """
    kept, which = verdict(rules)
    stats = statistics(docs, text)
    added = (*COUNTS, "base_failed", "kept", "rule")
    return stats.select(
        *[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in (text, *added)],
        *[F.col(stat(c)).alias(c) for c in COUNTS],
        base_failed().alias("base_failed"),
        F.when(base_failed(), F.lit(False)).otherwise(kept).alias("kept"),
        which.alias("rule"),
    )

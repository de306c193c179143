"""Language of web pages by Bayesian fusion of text, markup, address and host.

Text: a page's visible text is scored under a byte-trigram model per language, counted over
all documents with a known language.  Markup: the language declared on ``<html>``.
Address: the last label of the host and a language-like first path segment.  Host: a prior
from the other pages of the host, smoothed towards the other pages of its domain, and that
towards all pages.

How far a declaration or an address can be trusted is not assumed but counted: the text
posteriors are summed by declared language, by address, by host and by domain in grouped
aggregations, and each page's own share is taken out of the sums it is judged by.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tierflow.llm.common import map_rows, stored, texts_utf8
from tierflow.llm.words import LETTERS, joined
from tierflow.operators.joins import join_per_key

BUCKETS = 1 << 14
#: Trigrams lean on each other: a text counts as at most so many independent ones.
INDEPENDENT = 60
#: Pages that a host's, a domain's and an evidence's prior is worth.
HOST_WEIGHT = 5.0
DOMAIN_WEIGHT = 20.0
EVIDENCE_WEIGHT = 10.0
#: Bytes handled at once within a batch.
CHUNK = 4_000_000

HIDDEN = re.compile(
    rb"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<[a-zA-Z/!?][^>]*(?:>|\Z)|&#?\w+;",
    re.IGNORECASE | re.DOTALL,
)
DECLARED = re.compile(rb"<html\b[^>]*?\slang\s*=\s*[\"']?([a-zA-Z]{2,3})(?![a-zA-Z])", re.IGNORECASE)
SEGMENT = re.compile(r"/([a-z]{2})(?:/|$)")


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams of the texts' words, and the text each belongs to.

    A word's trigrams include a blank at either end.
    """
    data, starts = joined(texts)
    letters = np.concatenate(([0], LETTERS[data], [0])).astype(np.uint32)
    code = (letters[:-2] << np.uint32(16)) | (letters[1:-1] << np.uint32(8)) | letters[2:]
    inner = letters[1:-1] != 0
    of = np.searchsorted(starts, np.flatnonzero(inner), "right") - 1
    return (code[inner] * np.uint32(0x9E3779B1)) >> np.uint32(32 - 14), of


def chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Stretches of the texts holding about ``CHUNK`` bytes."""
    low, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > CHUNK:
            yield low, i
            low, held = i, 0
        held += len(text)
    if low < len(texts):
        yield low, len(texts)


def language_code(column: str) -> Column:
    """The primary subtag, lower-cased; null where it is not two or three letters."""
    code = F.lower(F.regexp_extract(F.col(column), r"^([A-Za-z]{2,3})(?![A-Za-z])", 1))
    return F.when(code != "", code)


def trigram_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, bucket, n) over all documents with a language; summed per task before the shuffle."""

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            texts = texts_utf8(batch.column(0))
            for low, high in chunks(texts):
                buckets, of = trigrams(texts[low:high])
                for name in set(langs[low:high]):
                    own = (langs[low:high] == name)[of]
                    counts = np.bincount(buckets[own], minlength=BUCKETS)
                    sums[name] = sums[name] + counts if name in sums else counts
        for name, counts in sums.items():
            at = np.flatnonzero(counts)
            yield pa.record_batch(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())],
                ["lang", "bucket", "n"],
            )

    known = docs.select(F.col(text).alias("text"), language_code(lang).alias("lang")).filter("lang is not null")
    counted = known.mapInArrow(run, "lang string, bucket int, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def trigram_model(counts: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages and a row of log probabilities for each bucket.

    Its size is that of the languages times the buckets, whatever the corpus holds.
    """
    rows = counts.collect()
    langs = sorted({r["lang"] for r in rows})
    table = np.full((BUCKETS, len(langs)), 0.5)
    for r in rows:
        table[r["bucket"], langs.index(r["lang"])] += r["n"]
    return langs, np.log(table / table.sum(axis=0)) if langs else table


def visible(html: bytes) -> bytes:
    return HIDDEN.sub(b" ", html)


def place(url: str | None) -> tuple[str, str, str]:
    """(host, domain, address) of a URL; empty where it has none."""
    try:
        parts = urlsplit(url or "")
        host = (parts.hostname or "").rstrip(".")
    except ValueError:
        return "", "", ""
    labels = host.split(".")
    segment = SEGMENT.match(parts.path.lower())
    return host, ".".join(labels[-2:]), f"{labels[-1]}/{segment[1] if segment else ''}"


def page_evidence(pages: DataFrame, langs: list[str], model: np.ndarray, id_column: str, url: str, html: str) -> DataFrame:
    """A row per page: its declared language, host, domain, address and text posterior."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sources = texts_utf8(batch.column(2))
        declared = [m[1].decode().lower() if (m := DECLARED.search(x)) else "" for x in sources]
        texts = [visible(x) for x in sources]
        out = np.zeros((len(texts), len(langs)))
        for low, high in chunks(texts):
            buckets, of = trigrams(texts[low:high])
            n = np.bincount(of, minlength=high - low)
            for k in range(len(langs)):
                total = np.bincount(of, model[buckets, k], minlength=high - low)
                out[low:high, k] = total * np.minimum(n, INDEPENDENT) / np.maximum(n, 1)
        out = np.exp(out - out.max(axis=1, keepdims=True))
        out /= out.sum(axis=1, keepdims=True)
        places = [place(u) for u in batch.column(1).to_pylist()]
        yield pa.record_batch(
            [
                batch.column(0),
                batch.column(1),
                pa.array(declared),
                *[pa.array([p[k] for p in places], pa.string()) for k in range(3)],
                pa.array(list(out), pa.list_(pa.float64())),
            ],
            ["page_id", "url", "declared", "host", "domain", "address", "text"],
        )

    source = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return map_rows(
        source,
        run,
        "page_id long, url string, declared string, host string, domain string, address string, text array<double>",
    )


def summed(pages: DataFrame, key: str, n: int) -> DataFrame:
    """The text posteriors summed by a key."""
    return pages.groupBy(key).agg(F.array(*[F.sum(F.get("text", F.lit(k))) for k in range(n)]).alias(f"{key}_sums"))


def identify(
    pages: DataFrame,
    docs: DataFrame,
    id_column: str = "page_id",
    url: str = "url",
    html: str = "html",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """(page_id, url, lang, posterior, text_lang, declared, host_prior): a row per page.

    ``text_lang`` is what the text alone says, ``host_prior`` the prior of the answer.
    A null or empty page has no text evidence, a page without a declaration or address has
    that of other such pages; a page whose URL is null shares the empty host.  Ties go to
    the language first in the alphabet.  Repeated rows are answered each.  Without any
    document of a known language, ``lang`` is null.  An empty table gives no rows.
    """
    langs, model = trigram_model(trigram_counts(docs, text, lang))
    if not langs:
        return pages.select(
            F.col(id_column).cast("long").alias("page_id"),
            F.col(url).alias("url"),
            F.lit(None).cast("string").alias("lang"),
            F.lit(None).cast("double").alias("posterior"),
            F.lit(None).cast("string").alias("text_lang"),
            F.lit("").alias("declared"),
            F.lit(None).cast("double").alias("host_prior"),
        )
    n = len(langs)
    rows = stored(page_evidence(pages, langs, model, id_column, url, html))
    overall = rows.agg(*[F.sum(F.get("text", F.lit(k))) for k in range(n)]).first()
    pages_seen = sum(x or 0.0 for x in overall)
    share = F.array(*[F.lit(((x or 0.0) + 1) / (pages_seen + n)) for x in overall])
    for key in ("declared", "address", "domain", "host"):
        rows = join_per_key(rows, summed(rows.select(key, "text"), key, n), [key])

    def others(key: str) -> Column:
        """The sums without the page's own share."""
        return F.zip_with(F.col(f"{key}_sums"), F.col("text"), lambda a, b: F.greatest(a - b, F.lit(0.0)))

    def total(sums: Column) -> Column:
        return F.aggregate(sums, F.lit(0.0), lambda a, b: a + b)

    def prior(key: str, weight: float, above: Column) -> Column:
        whole = total(others(key)) + F.lit(weight)
        return F.zip_with(others(key), above, lambda a, b: (a + F.lit(weight) * b) / whole)

    def trust(key: str) -> Column:
        """P(evidence | language) up to a factor: P(language | evidence) over P(language)."""
        return F.zip_with(prior(key, EVIDENCE_WEIGHT, share), share, lambda a, b: F.log(a / b))

    rows = rows.withColumn("domain_prior", prior("domain", DOMAIN_WEIGHT, share))
    rows = rows.withColumn("prior", prior("host", HOST_WEIGHT, F.col("domain_prior")))
    rows = rows.withColumns({"by_markup": trust("declared"), "by_address": trust("address")})
    logs = F.transform(
        "text",
        lambda p, i: F.log(p + F.lit(1e-12))
        + F.log(F.get("prior", i))
        + F.get("by_markup", i)
        + F.get("by_address", i),
    )
    rows = rows.withColumn("logs", logs).withColumn("top", F.array_max("logs"))
    rows = rows.withColumn("best", F.array_position("logs", F.col("top")).cast("int") - 1)
    mass = F.aggregate(F.transform("logs", lambda x: F.exp(x - F.col("top"))), F.lit(0.0), lambda a, b: a + b)
    names = F.array(*[F.lit(x) for x in langs])
    by_text = F.array_position("text", F.array_max("text")).cast("int") - 1
    return rows.select(
        "page_id",
        "url",
        F.get(names, F.col("best")).alias("lang"),
        (1 / mass).alias("posterior"),
        F.get(names, by_text).alias("text_lang"),
        "declared",
        F.get("prior", F.col("best")).alias("host_prior"),
    )

"""The operators bound to the test tables, and the same in SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierflow.llm import (
    decontaminate,
    divergence,
    html_extract,
    language_id,
    line_dedup,
    near_copies,
    packing,
    prefix_trie,
    quality_rules,
    sharding,
    simhash,
    suffix_dedup,
    toxicity,
    warc,
)
from tierflow.llm.common import documents, work_folder


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.overlaps(documents(spark, sf_dir), benchmark).withColumnRenamed("id", "doc_id")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup_substrings(documents(spark, sf_dir), keep_bytes=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(documents(spark, sf_dir))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return html_extract.main_texts(pages.select("page_id", "url", "html"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path())


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.scored(docs, toxicity.fit(docs, labels(spark, sf_dir)))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rules = quality_rules.fit(docs, labels(spark, sf_dir))
    return quality_rules.judged(docs.select("doc_id", "text"), rules)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id"
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return language_id.identify(pages, documents(spark, sf_dir))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write(spark.read.parquet(f"{sf_dir}/pages.parquet"), work_folder(spark))
    rows = warc.resolved(warc.read(index.select("bundle"), payloads=False))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_trie.trie(prefix_trie.grafted(prefix_trie.numbered(turns)))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels(spark, sf_dir)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: as ``packing.pack``, with less remembered, since earlier stages have filled the executors."""
    return packing.pack(docs, tokenizer_path(), remembered=100_000)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.one_of_each(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_sharding": op3_sharding,
    "op4_line_dedup": op4_line_dedup,
    "op5_html_extraction": op5_html_extraction,
    "op6_packing": op6_packing,
    "op7_toxicity": op7_toxicity,
    "op8_quality_rules": op8_quality_rules,
    "op9_simhash": op9_simhash,
    "op10_language_id": op10_language_id,
    "op11_warc": op11_warc,
    "op12_divergence": op12_divergence,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES = {
    "op1_decontamination": r"""
        WITH doc AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS t FROM documents),
        item AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS i FROM benchmark),
        doc_at AS (SELECT doc_id, t, unnest(range(len(t))) AS p FROM doc),
        item_at AS (SELECT item_id, i, unnest(range(len(i))) AS q FROM item WHERE len(i) >= 12),
        doc_seed AS (
            SELECT doc_id, p, 0 AS m, [t[p+1], t[p+3], t[p+4], t[p+5], t[p+6], t[p+8]] AS s FROM doc_at WHERE p + 7 < len(t)
            UNION ALL SELECT doc_id, p, 1, [t[p+1], t[p+2], t[p+3], t[p+8], t[p+9], t[p+10]] FROM doc_at WHERE p + 9 < len(t)
            UNION ALL SELECT doc_id, p, 2, [t[p+1], t[p+2], t[p+4], t[p+8], t[p+10], t[p+11]] FROM doc_at WHERE p + 10 < len(t)),
        item_seed AS (
            SELECT item_id, q, 0 AS m, [i[q+1], i[q+3], i[q+4], i[q+5], i[q+6], i[q+8]] AS s FROM item_at WHERE q + 7 < len(i)
            UNION ALL SELECT item_id, q, 1, [i[q+1], i[q+2], i[q+3], i[q+8], i[q+9], i[q+10]] FROM item_at WHERE q + 9 < len(i)
            UNION ALL SELECT item_id, q, 2, [i[q+1], i[q+2], i[q+4], i[q+8], i[q+10], i[q+11]] FROM item_at WHERE q + 10 < len(i)),
        diagonal AS (SELECT DISTINCT doc_id, item_id, p - q AS start FROM doc_seed JOIN item_seed USING (m, s)),
        laid AS (
            SELECT doc_id, item_id, len(i) AS n_tokens, start,
                   list_transform(range(len(i)), lambda k: CASE WHEN start + k >= 0 AND start + k < len(t) AND t[start + k + 1] = i[k + 1] THEN 1 ELSE 0 END) AS e
            FROM diagonal JOIN doc USING (doc_id) JOIN item USING (item_id)),
        good AS (
            SELECT doc_id, item_id, n_tokens, start, list_sum(e) AS n_equal FROM laid
            WHERE list_max(list_transform(range(n_tokens - 11), lambda k: list_sum(e[k + 1 : k + 12]))) >= 10)
        SELECT doc_id, item_id, n_tokens, CAST(max(n_equal) AS INTEGER) AS n_equal,
               CAST(arg_max(start, n_equal * 1000000 - start) AS INTEGER) AS start
        FROM good GROUP BY doc_id, item_id, n_tokens
    """,
    "op4_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, unnest(list) AS line, generate_subscripts(list, 1) AS pos
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS list FROM documents)
        ), keyed AS (
            SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines
        ), owners AS (SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key)
        SELECT doc_id, count(*) AS n_lines,
               count(*) FILTER (WHERE doc_id > owner) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE owner IS NULL OR doc_id <= owner), ''))
                   AS kept_sha256
        FROM keyed LEFT JOIN owners USING (key) GROUP BY doc_id
    """,
    "op11_warc": r"""
        WITH page AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        hashed AS (SELECT page_id, body, sha1(body) AS h FROM page),
        parts AS (
            SELECT page_id, strlen(body) AS payload_bytes, body,
                   list_transform(range(8), lambda g: CAST('0x' || substr(h, CAST(1 + 5 * g AS INTEGER), 5) AS INTEGER)) AS v
            FROM hashed),
        named AS (
            SELECT page_id, payload_bytes, body, min(page_id) OVER (PARTITION BY body) AS first_id,
                   list_aggregate(list_transform(v, lambda x:
                       substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((x >> 15) & 31), 1) ||
                       substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((x >> 10) & 31), 1) ||
                       substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((x >> 5) & 31), 1) ||
                       substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (x & 31), 1)), 'string_agg', '') AS payload_digest
            FROM parts)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM named
    """,
    "op12_divergence": r"""
        WITH doc AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
        word AS (
            SELECT doc_id, lang, source, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM doc),
        kept AS (SELECT lang, term, count(*) AS n_lang FROM word GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 30),
        sized AS (SELECT lang, count(*) AS v, sum(n_lang) AS total FROM kept GROUP BY lang),
        grp AS (SELECT DISTINCT lang, source FROM doc),
        cell AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM word w JOIN kept USING (lang, term) GROUP BY ALL),
        dense AS (
            SELECT g.lang, g.source, k.term, k.n_lang, coalesce(c.n, 0) AS n,
                   sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
            FROM grp g JOIN kept k USING (lang) LEFT JOIN cell c USING (lang, source, term)),
        prob AS (
            SELECT d.lang, d.source, d.term, d.n,
                   1 + (1000000000::HUGEINT * (d.n + 5)) // (d.total::HUGEINT + 5 * v) AS p,
                   1 + (1000000000::HUGEINT * (n_lang + 5)) // (s.total::HUGEINT + 5 * v) AS q
            FROM dense d JOIN sized s USING (lang)),
        pair AS (
            SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
            FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN prob x ON x.lang = a.lang AND x.source = a.source
            LEFT JOIN prob y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
            GROUP BY ALL),
        every AS (
            SELECT lang, source, 'pair' AS part, item, value::BIGINT AS value FROM pair
            UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM prob WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, value,
               row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
        FROM every QUALIFY part = 'pair' OR rank <= 50
    """,
    "op13_prefix_trie": r"""
        WITH original AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(coalesce(role, '') || chr(0) || coalesce(text, ''))) AS at
            FROM conversations WHERE conv_id IS NOT NULL),
        conv AS (
            SELECT conv_id, conv_id - conv_id % 100 AS giver, xor(4294967295, list_reduce(
                       list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                       lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
                           lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 6 AS h
            FROM (SELECT DISTINCT conv_id FROM original)),
        rebuilt AS (
            SELECT c.conv_id, o.at AS k, 0 AS own, o.role, o.text FROM conv c JOIN original o ON o.conv_id = c.giver AND o.at <= c.h
            UNION ALL SELECT c.conv_id, o.at, 1, o.role, o.text FROM conv c JOIN original o USING (conv_id) WHERE o.at > c.h),
        step AS (
            SELECT conv_id, row_number() OVER w AS depth, length(text) AS chars,
                   md5(string_agg(md5(role) || md5(text), '') OVER w) AS name
            FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY own, k)
            UNION ALL SELECT conv_id, 0, 0, '' FROM conv),
        placed AS (
            SELECT *, lag(name) OVER (PARTITION BY conv_id ORDER BY depth) AS above,
                   depth = max(depth) OVER (PARTITION BY conv_id) AS last
            FROM step),
        node AS (
            SELECT name, depth, min(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256
            FROM placed GROUP BY name, depth),
        kids AS (SELECT above AS name, count(*) AS n FROM node WHERE depth > 0 GROUP BY above),
        full_node AS (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids USING (name)),
        below AS (
            SELECT p.name, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((f.n_convs - 1) * f.chars) AS saved_tokens
            FROM full_node f JOIN placed p ON p.conv_id = f.conv_id AND p.depth <= f.depth GROUP BY p.name)
        SELECT f.conv_id, f.depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, b.n_leaves::BIGINT AS n_leaves,
               b.saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
        FROM full_node f JOIN below b USING (name) LEFT JOIN full_node up ON up.name = f.above AND f.depth > 0
    """,
}

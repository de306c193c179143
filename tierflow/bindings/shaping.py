"""Row-wise expressions and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.bindings.tables import (
    FIRST_LOAD,
    bronze_frame,
    plain_number,
    silver_sql,
    table,
)
from tierflow.functions import (
    date_stamp,
    file_stem,
    market_codes,
    numeric_text,
    numeric_text_sql,
    safe_numeric,
    split_literal,
)
from tierflow.operators import require_key, to_silver
from tierflow.sources import union_ragged, with_load_ts
from tierflow.specs import (
    ALLROUNDERS,
    BATSMEN,
    BOWLERS,
    GALLERY,
    INTERNATIONAL_TEAMS,
    PHOTOS,
    PLAYERS,
    RESULTS,
    TEAM_RANKINGS,
    positional,
)


def safe_numbers(spark, sf_dir):
    level = split_literal("o_orderpriority", "-")
    first = F.get(level, F.lit(0))
    typed = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        safe_numeric(first).alias("level"),
        safe_numeric(F.get(level, F.lit(1))).alias("not_a_number"),
        safe_numeric(F.get(level, F.lit(2))).alias("out_of_range"),
        safe_numeric(F.concat(F.lit(" +"), first, F.lit("e2 "))).alias("exponent"),
    )
    return typed.select(
        "o_orderkey", *[numeric_text(c).alias(c) for c in typed.columns if c != "o_orderkey"]
    )


def number_text(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        numeric_text("l_quantity").alias("quantity"),
        numeric_text("l_extendedprice").alias("price"),
        numeric_text("l_discount").alias("discount"),
    )


def file_stems(spark, sf_dir):
    path = F.concat("url", F.lit(".v2.csv"))
    return table(spark, sf_dir, "pages").select("page_id", file_stem(path).alias("file_name"))


def code_classifier(spark, sf_dir):
    code = F.concat(F.lit(" "), F.repeat("l_returnflag", F.col("l_linenumber")), F.lit("  "))
    two, three = market_codes(code)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", two.alias("market_code2"), three.alias("market_code3"),
        F.coalesce(two, three, F.lit("none")).alias("fallback"),
    )


def default_chain(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.coalesce(
            F.nullif("c_mktsegment", F.lit("HOUSEHOLD")),
            F.when(F.col("c_acctbal") > 0, F.col("c_name")),
            F.lit("-1"),
        ).alias("country_name"),
    )


def required_key(spark, sf_dir):
    last = F.element_at(split_literal("url", "/"), -1)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", safe_numeric(last).alias("key"))
    return require_key(pages, "key").select("page_id", "url", numeric_text("key").alias("key"))


def column_swap_rename(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part_key"),
        F.col("p_brand").alias("p_name"),
        F.col("p_name").alias("p_brand"),
    )


def bronze_columns(spark, sf_dir):
    """All columns plus one load timestamp for the whole load."""
    ts = F.lit(FIRST_LOAD).cast("timestamp")
    loaded = table(spark, sf_dir, "supplier").transform(with_load_ts, ts)
    return loaded.withColumn("update_timestamp", F.col("update_timestamp").cast("string"))


def date_stamps(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        *[date_stamp("o_orderdate", k).alias(f"stamp_{k}") for k in ("day", "second", "folder")],
    )


def ragged_union(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_name", "name")
    supplier = table(spark, sf_dir, "supplier").withColumnRenamed("s_name", "name")
    return union_ragged([customer.drop("c_acctbal"), supplier.drop("s_acctbal")]).select(
        "name", "c_mktsegment", *[F.col(c).cast("string").alias(c) for c in ("c_custkey", "s_suppkey")]
    )


# Query name -> spec: the typed projection of every source, and the photo files
# taken by position (two columns exchanged, a numeric caption).
SILVER = {
    "silver_allrounders": ALLROUNDERS,
    "silver_batsmen": BATSMEN,
    "silver_bowlers": BOWLERS,
    "silver_team_rankings": TEAM_RANKINGS,
    "silver_gallery": GALLERY,
    "silver_photos": PHOTOS,
    "silver_photos_by_position": positional(PHOTOS),
    "silver_international": INTERNATIONAL_TEAMS,
    "silver_players": PLAYERS,
    "silver_results": RESULTS,
}
# The sources that need no more than their key on the way to Gold.
KEYED = {
    name.replace("silver_", "gold_"): spec
    for name, spec in SILVER.items()
    if name not in ("silver_international", "silver_photos_by_position")
}


def _typed(spec, keyed):
    def run(spark, sf_dir):
        rows = to_silver(bronze_frame(spark, sf_dir, spec.name), spec)
        if keyed:
            rows = require_key(rows, spec.key)
        cells = [f"{numeric_text_sql(c) if c in spec.numeric else c} as {c}" for c in spec.columns]
        return rows.selectExpr(*cells, "file_name")

    return run


def _typed_oracle(spec, keyed) -> str:
    cells = [
        f'{plain_number(c)} AS "{c}"' if c in spec.numeric else f'"{c}"' for c in spec.columns
    ]
    where = f' WHERE "{spec.key}" IS NOT NULL' if keyed else ""
    return f"SELECT {', '.join(cells)}, file_name FROM ({silver_sql(spec)}){where}"


QUERIES = {
    "safe_numeric": safe_numbers,
    "numeric_text": number_text,
    "file_stem": file_stems,
    "code_classifier": code_classifier,
    "default_chain": default_chain,
    "required_key": required_key,
    "column_swap_rename": column_swap_rename,
    "bronze_columns": bronze_columns,
    "date_stamps": date_stamps,
    "ragged_union": ragged_union,
    **{name: _typed(spec, keyed=False) for name, spec in SILVER.items()},
    **{name: _typed(spec, keyed=True) for name, spec in KEYED.items()},
}

ORACLES = {
    "safe_numeric": f"""
        SELECT o_orderkey,
               {plain_number("try_cast(split_part(o_orderpriority, '-', 1) AS decimal(38,9))")} AS level,
               {plain_number("try_cast(split_part(o_orderpriority, '-', 2) AS decimal(38,9))")} AS not_a_number,
               cast(NULL AS varchar) AS out_of_range,
               split_part(o_orderpriority, '-', 1) || '00' AS exponent
        FROM orders""",
    "numeric_text": f"""
        SELECT l_orderkey, l_linenumber,
               {plain_number("cast(l_quantity AS decimal(38,9))")} AS quantity,
               {plain_number("cast(l_extendedprice AS decimal(38,9))")} AS price,
               {plain_number("cast(l_discount AS decimal(38,9))")} AS discount
        FROM lineitem""",
    "file_stem": """
        SELECT page_id, split_part(split_part(url || '.v2.csv', '/', -1), '.', 1) AS file_name
        FROM pages""",
    "code_classifier": """
        WITH codes AS (SELECT l_orderkey, l_linenumber,
                              trim(' ' || repeat(l_returnflag, l_linenumber) || '  ') AS code
                       FROM lineitem)
        SELECT l_orderkey, l_linenumber,
               CASE WHEN length(code) = 2 THEN code END AS market_code2,
               CASE WHEN length(code) = 3 THEN code END AS market_code3,
               CASE WHEN length(code) IN (2, 3) THEN code ELSE 'none' END AS fallback
        FROM codes""",
    "default_chain": """
        SELECT c_custkey, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment
                               WHEN c_acctbal > 0 THEN c_name ELSE '-1' END AS country_name
        FROM customer""",
    "required_key": f"""
        SELECT page_id, url, {plain_number("key")} AS key
        FROM (SELECT page_id, url, try_cast(split_part(url, '/', -1) AS decimal(38,9)) AS key FROM pages)
        WHERE key IS NOT NULL""",
    "column_swap_rename": "SELECT p_partkey AS part_key, p_brand AS p_name, p_name AS p_brand FROM part",
    "bronze_columns": f"SELECT *, '{FIRST_LOAD}' AS update_timestamp FROM supplier",
    "date_stamps": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS stamp_day,
               strftime(o_orderdate, '%Y%m%d_%H%M%S') AS stamp_second,
               strftime(o_orderdate, '%Y-%m-%d') AS stamp_folder
        FROM orders""",
    "ragged_union": """
        SELECT c_name AS name, c_mktsegment, cast(c_custkey AS varchar) AS c_custkey,
               cast(NULL AS varchar) AS s_suppkey FROM customer
        UNION ALL
        SELECT s_name, NULL, NULL, cast(s_suppkey AS varchar) FROM supplier""",
    **{name: _typed_oracle(spec, keyed=False) for name, spec in SILVER.items()},
    **{name: _typed_oracle(spec, keyed=True) for name, spec in KEYED.items()},
}

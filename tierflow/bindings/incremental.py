"""Current, new, replaced and present rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.bindings.tables import table
from tierflow.operators import (
    latest_batch,
    load_tally,
    missing_sources,
    newer_than,
    one_per_key,
    replaced_by_key,
    rows_absent,
    rows_present,
)

ORDER_KEYS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
LAST_ORDERS = (
    "SELECT * FROM orders QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) = 1"
)


def _day(c):
    return F.date_format(c, "yyyy-MM-dd")


def latest_batch_rank(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("batch", F.date_trunc("day", "ts"))
    return latest_batch(events, "event_type", "batch").select(
        "event_id", "user_id", "event_type", "value", _day("batch").alias("batch")
    )


def one_row_per_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    first = one_per_key(
        orders, ["o_custkey"], [F.desc_nulls_last("o_orderdate"), F.asc_nulls_last("o_orderkey")]
    )
    return first.select(*ORDER_KEYS, _day("o_orderdate").alias("o_day"))


def incremental_newer(spark, sf_dir):
    """Silver holds the finished orders; Bronze brings all of them."""
    orders = table(spark, sf_dir, "orders")
    silver = orders.filter("o_orderstatus = 'F'")
    return newer_than(orders, silver, "o_custkey", "o_orderdate").select(*ORDER_KEYS)


def first_load(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    incoming = latest_batch(orders, "o_custkey", "o_orderdate")
    nothing = spark.createDataFrame([], orders.schema)
    return newer_than(incoming, nothing, "o_custkey", "o_orderdate").select(*ORDER_KEYS)


def no_change(spark, sf_dir):
    incoming = latest_batch(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")
    return newer_than(incoming, incoming, "o_custkey", "o_orderdate").select(*ORDER_KEYS)


def replace_by_key(spark, sf_dir):
    """Customers with pending orders are replaced by those orders."""
    orders = table(spark, sf_dir, "orders").select(*ORDER_KEYS)
    return replaced_by_key(
        orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderstatus = 'P'"), "o_custkey"
    )


def semi_by_exists(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return rows_present(table(spark, sf_dir, "orders").select(*ORDER_KEYS), lines, "o_orderkey")


def anti_by_not_exists(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return rows_absent(table(spark, sf_dir, "orders").select(*ORDER_KEYS), lines, "o_orderkey")


def tally_of_loads(spark, sf_dir):
    """Views have no known source; their row is not the total."""
    events = table(spark, sf_dir, "events").withColumn("source", F.expr("nullif(event_type, 'view')"))
    return load_tally(events, "source", F.col("event_type") != "error")


def missing_customers(spark, sf_dir):
    """Expected: every customer.  Arrived: those with a finished order."""
    expected = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("source"))
    loaded = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    return missing_sources(expected, loaded.select(F.col("o_custkey").alias("source")))


QUERIES = {
    "latest_batch_rank": latest_batch_rank,
    "one_row_per_key": one_row_per_key,
    "incremental_newer": incremental_newer,
    "first_load": first_load,
    "no_change": no_change,
    "replace_by_key": replace_by_key,
    "semi_by_exists": semi_by_exists,
    "anti_by_not_exists": anti_by_not_exists,
    "load_tally": tally_of_loads,
    "missing_sources": missing_customers,
}

_ORDER_COLUMNS = ", ".join(ORDER_KEYS)
ORACLES = {
    "latest_batch_rank": """
        SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS batch FROM events
        QUALIFY rank() OVER (PARTITION BY event_type ORDER BY date_trunc('day', ts) DESC) = 1""",
    "one_row_per_key": f"""
        SELECT {_ORDER_COLUMNS}, strftime(o_orderdate, '%Y-%m-%d') AS o_day FROM orders
        QUALIFY row_number() OVER (
            PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) = 1""",
    "incremental_newer": f"""
        WITH silver AS (SELECT * FROM orders WHERE o_orderstatus = 'F')
        SELECT {_ORDER_COLUMNS} FROM orders b
        WHERE NOT EXISTS (SELECT 1 FROM silver s WHERE s.o_custkey = b.o_custkey)
           OR EXISTS (SELECT 1 FROM silver s
                      WHERE s.o_custkey = b.o_custkey AND b.o_orderdate > s.o_orderdate)""",
    "first_load": f"SELECT {_ORDER_COLUMNS} FROM ({LAST_ORDERS})",
    "no_change": f"""
        WITH last AS ({LAST_ORDERS})
        SELECT {_ORDER_COLUMNS} FROM last b
        WHERE NOT EXISTS (SELECT 1 FROM last s WHERE s.o_custkey = b.o_custkey)
           OR EXISTS (SELECT 1 FROM last s
                      WHERE s.o_custkey = b.o_custkey AND b.o_orderdate > s.o_orderdate)""",
    "replace_by_key": f"""
        SELECT {_ORDER_COLUMNS} FROM orders o WHERE o_orderstatus = 'F' AND NOT EXISTS (
            SELECT 1 FROM orders p WHERE p.o_orderstatus = 'P' AND p.o_custkey = o.o_custkey)
        UNION ALL SELECT {_ORDER_COLUMNS} FROM orders WHERE o_orderstatus = 'P'""",
    "semi_by_exists": f"""
        SELECT {_ORDER_COLUMNS} FROM orders
        WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "anti_by_not_exists": f"""
        SELECT {_ORDER_COLUMNS} FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "load_tally": """
        SELECT CASE WHEN event_type <> 'view' THEN event_type END AS source,
               count(*) FILTER (event_type <> 'error') AS moved,
               count(*) FILTER (event_type = 'error') AS failed, false AS is_total
        FROM events GROUP BY event_type
        UNION ALL
        SELECT NULL, count(*) FILTER (event_type <> 'error'),
               count(*) FILTER (event_type = 'error'), true FROM events""",
    "missing_sources": """
        SELECT DISTINCT c_custkey AS source FROM customer WHERE c_custkey NOT IN (
            SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""",
}

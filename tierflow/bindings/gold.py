"""Enrichment, the wide and nested Gold tables, JSON packing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.bindings.tables import (
    FIRST_LOAD,
    MARKET_SQL,
    bronze_frame,
    market_frame,
    plain_number,
    silver_frames,
    silver_sql,
    table,
)
from tierflow.functions import numeric_text, numeric_text_sql
from tierflow.operators import (
    json_document,
    json_report,
    json_rows,
    left_join_any,
    nested_union,
    require_key,
    to_silver,
    wide_union,
)
from tierflow.plans import enrich_international, team_report
from tierflow.specs import (
    GOLD_STRUCTS,
    INTERNATIONAL_TEAMS,
    SOURCES,
    WIDE_COLUMNS,
    WIDE_NUMERIC,
    metadata_label,
)

DOCUMENT_BYTES = 64 * 1024


def gold_frames(spark, sf_dir):
    """The nine Gold inputs by tag, from the Silver-shaped bindings."""
    silver = silver_frames(spark, sf_dir)
    frames = {}
    for spec in SOURCES:
        if spec is INTERNATIONAL_TEAMS:
            frames[spec.tag] = enrich_international(silver[spec.name], market_frame(spark, sf_dir), scanned=True)
        else:
            frames[spec.tag] = require_key(silver[spec.name], spec.key)
    return frames


def or_join_pairs(spark, sf_dir):
    """Every market a team meets by code or by name."""
    teams = to_silver(bronze_frame(spark, sf_dir, "team_international"), INTERNATIONAL_TEAMS)
    pairs = left_join_any(
        teams.withColumn("code", F.trim("market_code")),
        market_frame(spark, sf_dir).select("alpha2", "alpha3", "country"),
        [
            (F.lower("code"), F.lower("alpha2")),
            (F.lower("code"), F.lower("alpha3")),
            (F.lower("country_name"), F.lower("country")),
        ],
        scanned=(True, True),
    )
    return pairs.select(
        numeric_text("team_id").alias("team_id"), "code", "country_name", "alpha2", "alpha3", "country"
    )


def gold_international(spark, sf_dir):
    teams = to_silver(bronze_frame(spark, sf_dir, "team_international"), INTERNATIONAL_TEAMS)
    got = enrich_international(teams, market_frame(spark, sf_dir), scanned=True)
    return got.select(
        "market_code", "market_code2", "market_code3", numeric_text("team_id").alias("team_id"),
        "country_name", numeric_text("image_id").alias("image_id"), "file_name",
        F.col("update_timestamp").cast("string").alias("update_timestamp"),
    )


def or_join_two_key(spark, sf_dir):
    """Teams, players by either key, results: each side's columns under a prefix."""
    teams = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("team_id"),
        (F.col("s_suppkey") + F.col("s_nationkey")).alias("image_id"),
        F.col("s_name").alias("name"),
    )
    players = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("image_id"), F.col("c_name").alias("name")
    )
    results = table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") * 2).alias("match_id"), F.col("o_orderpriority").alias("match_desc")
    )
    return team_report(teams, players, results, scanned=True)


def wide(spark, sf_dir):
    return wide_union(gold_frames(spark, sf_dir))


def _leaf_names():
    for struct, fields in GOLD_STRUCTS.items():
        for name, column in fields:
            yield struct, name, column, f"{struct}_{name}".lower()


def nested(spark, sf_dir):
    """The nested master table, shown leaf by leaf."""
    return _leaves(nested_union(gold_frames(spark, sf_dir)))


def _leaves(master):
    cells = [
        f"{numeric_text_sql(f'{struct}.{name}') if column in WIDE_NUMERIC else f'{struct}.{name}'} as {leaf}"
        for struct, name, column, leaf in _leaf_names()
    ]
    metadata = [
        f"cast(METADATA.{field} as string) as {field}"
        for field in master.schema["METADATA"].dataType.names
    ]
    # A function over an array stays out of the generated code, and so does its projection: all
    # these cells in one method would be more than the JVM compiles; apart they are compiled.
    tag = "element_at(transform(array(source_table), tag -> tag), 1) as source_table"
    return master.selectExpr(*cells, *metadata, tag)


def nested_guarded(spark, sf_dir):
    """Ranking structs for their own source only: how many rows fill each."""
    master = nested_union(gold_frames(spark, sf_dir), guarded=True)
    rankings = ("ICCRANKING_ALLROUNDER", "ICCRANKING_BATSMENS", "ICCRANKING_BOWLERS", "ICCRANKING_TEAMS")
    return master.groupBy("source_table").agg(
        *[F.count_if(F.col(s).isNotNull()).alias(s.lower()) for s in rankings]
    )


def json_lines(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", "props",
        F.when(F.col("event_type") == "purchase", F.col("user_id")).alias("buyer"),
    )
    return json_rows(events, "events")


def json_pack(spark, sf_dir):
    """All customers, balances as decimals, as JSON arrays of bounded bytes."""
    rows = table(spark, sf_dir, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))
    return json_document(rows, "customer", DOCUMENT_BYTES)


def json_side_by_side(spark, sf_dir):
    """Nine tables as one frame of JSON rows."""
    return json_report(gold_frames(spark, sf_dir))


QUERIES = {
    "or_join_pairs": or_join_pairs,
    "or_join_enrich": gold_international,
    "or_join_two_key": or_join_two_key,
    "wide_union": wide,
    "gold_nested": nested,
    "gold_nested_guarded": nested_guarded,
    "json_rows": json_lines,
    "json_pack": json_pack,
    "json_report": json_side_by_side,
}

# --- the same in SQL ---------------------------------------------------------------------

TEAMS_SQL = silver_sql(INTERNATIONAL_TEAMS)
def _matches(own: str, side: str) -> str:
    """Teams with the markets that agree on one of the three keys."""
    return f"SELECT t.*, m.alpha2, m.alpha3 FROM team t JOIN market m ON {own} = lower(m.{side})"


# Each key is joined by itself; a team that agrees with no market on any key keeps its own
# codes.  The pick is the least tuple of a team and country, which needs no window.
ENRICHED_SQL = f"""
    WITH market AS ({MARKET_SQL}),
    team AS (
        SELECT s.*, trim(market_code) AS code,
               if(len(trim(market_code)) = 2, trim(market_code), NULL) AS two,
               if(len(trim(market_code)) = 3, trim(market_code), NULL) AS three
        FROM ({TEAMS_SQL}) s WHERE team_id IS NOT NULL),
    agreed AS (
        {_matches("lower(t.two)", "alpha2")} UNION ALL
        {_matches("lower(t.three)", "alpha3")} UNION ALL
        {_matches("lower(t.country_name)", "country")}),
    candidate AS (
        SELECT * FROM agreed UNION ALL
        SELECT t.*, NULL, NULL FROM team t
        WHERE NOT EXISTS (SELECT 1 FROM agreed a
                          WHERE (a.team_id, a.file_name) IS NOT DISTINCT FROM (t.team_id, t.file_name)
                            AND a.country_name IS NOT DISTINCT FROM t.country_name
                            AND a.market_code IS NOT DISTINCT FROM t.market_code)),
    pick AS (
        SELECT team_id, country_name,
               arg_min(candidate, row(-epoch_us(update_timestamp::timestamp), coalesce(alpha2, '~'), coalesce(alpha3, '~'),
                                      file_name, coalesce(market_code, '~'), coalesce(image_id, 1e18))) AS best
        FROM candidate GROUP BY team_id, country_name)
    SELECT best.market_code AS market_code, coalesce(best.alpha2, best.two) AS market_code2,
           coalesce(best.alpha3, best.three) AS market_code3, team_id, country_name, best.image_id AS image_id,
           best.file_name AS file_name, best.update_timestamp AS update_timestamp
    FROM pick"""


def _gold_sql(spec) -> str:
    if spec is INTERNATIONAL_TEAMS:
        return ENRICHED_SQL
    return f'SELECT * FROM ({silver_sql(spec)}) WHERE "{spec.key}" IS NOT NULL'


def _gold_columns(spec) -> dict[str, bool]:
    """Columns of a Gold input and whether each is a number."""
    if spec is INTERNATIONAL_TEAMS:
        names = ("market_code", "market_code2", "market_code3", "team_id", "country_name", "image_id")
    else:
        names = tuple(spec.columns)
    return {n: n in spec.numeric for n in names}


def _wide_branch(spec) -> str:
    own = {n.lower(): (n, number) for n, number in _gold_columns(spec).items()}
    cells = []
    for c in WIDE_COLUMNS:
        if c == "file_name":
            cells.append("file_name")
        elif c == "update_timestamp":
            cells.append("cast(update_timestamp AS varchar) AS update_timestamp")
        elif c in own:
            name, number = own[c]
            value = plain_number(f'"{name}"') if number else f'"{name}"'
            cells.append(f"{value} AS {c}")
        else:
            cells.append(f"cast(NULL AS varchar) AS {c}")
    return f"SELECT {', '.join(cells)}, '{spec.tag}' AS source_table FROM ({_gold_sql(spec)})"


WIDE_SQL = " UNION ALL ".join(_wide_branch(s) for s in SOURCES)


def _nested_sql() -> str:
    cells = []
    for _, _, column, leaf in _leaf_names():
        value = column
        if column in WIDE_NUMERIC:
            value = plain_number(f"try_cast({column} AS decimal(38,9))")
        cells.append(f"{value} AS {leaf}")
    for suffix in ("file_name", "update_timestamp"):
        for spec in SOURCES:
            cells.append(
                f"CASE WHEN source_table = '{spec.tag}' THEN {suffix} END "
                f"AS {metadata_label(spec.tag)}_{suffix}"
            )
    return f"SELECT {', '.join(cells)}, source_table FROM ({WIDE_SQL})"


def _guarded_sql() -> str:
    owners = {
        "iccranking_allrounder": "stg_gold_ranking_allrounders",
        "iccranking_batsmens": "stg_gold_ranking_batsmens",
        "iccranking_bowlers": "stg_gold_ranking_bowlers",
        "iccranking_teams": "stg_gold_ranking_teams",
    }
    counts = ", ".join(
        f"count(*) FILTER (source_table = '{tag}') AS {name}" for name, tag in owners.items()
    )
    return f"SELECT source_table, {counts} FROM ({WIDE_SQL}) GROUP BY source_table"


def _json_object(columns: dict[str, str]) -> str:
    """SQL text of a JSON object: kind per column is text, number, double or time."""
    pieces = []
    for name, kind in columns.items():
        c = f'"{name}"'
        if kind == "text":
            value = f"cast(to_json({c}) AS varchar)"
        elif kind == "number":
            value = plain_number(c)
        elif kind == "time":
            value = f"""'"' || strftime({c}, '%Y-%m-%dT%H:%M:%S.%fZ') || '"'"""
        else:
            value = f"cast({c} AS varchar)"
        pieces.append(f"""'"{name}":' || coalesce({value}, 'null')""")
    return "'{' || " + " || ',' || ".join(pieces) + " || '}'"


CUSTOMER_JSON = _json_object(
    {"c_custkey": "plain", "c_name": "text", "c_nationkey": "plain", "c_acctbal": "number", "c_mktsegment": "text"}
)


def _report_sql() -> str:
    branches = []
    for spec in SOURCES:
        columns = {n: "number" if number else "text" for n, number in _gold_columns(spec).items()}
        columns |= {"file_name": "text", "update_timestamp": "time"}
        branches.append(
            f"SELECT '{spec.tag}' AS source_table, {_json_object(columns)} AS row_json FROM ({_gold_sql(spec)})"
        )
    return " UNION ALL ".join(branches)


ORACLES = {
    "or_join_pairs": f"""
        WITH teams AS (SELECT *, trim(market_code) AS code FROM ({TEAMS_SQL})), market AS ({MARKET_SQL})
        SELECT {plain_number("team_id")} AS team_id, code, country_name, alpha2, alpha3, country
        FROM teams LEFT JOIN market
          ON lower(code) = lower(alpha2) OR lower(code) = lower(alpha3) OR lower(country_name) = lower(country)""",
    "or_join_enrich": f"""
        SELECT market_code, market_code2, market_code3, {plain_number("team_id")} AS team_id, country_name,
               {plain_number("image_id")} AS image_id, file_name, '{FIRST_LOAD}' AS update_timestamp
        FROM ({ENRICHED_SQL})""",
    "or_join_two_key": """
        SELECT s_suppkey AS i_team_id, s_suppkey + s_nationkey AS i_image_id, s_name AS i_name,
               c_custkey AS p_id, c_custkey AS p_image_id, c_name AS p_name,
               o_orderkey * 2 AS r_match_id, o_orderpriority AS r_match_desc
        FROM supplier
        LEFT JOIN customer ON s_suppkey = c_custkey OR s_suppkey + s_nationkey = c_custkey
        LEFT JOIN orders ON s_suppkey = o_orderkey * 2""",
    "wide_union": WIDE_SQL,
    "gold_nested": _nested_sql(),
    "gold_nested_guarded": _guarded_sql(),
    "json_rows": f"""
        SELECT 'events' AS source_table,
               {_json_object({"event_id": "plain", "user_id": "plain", "event_type": "text",
                              "value": "plain", "props": "text", "buyer": "plain"})} AS row_json
        FROM (SELECT *, CASE WHEN event_type = 'purchase' THEN user_id END AS buyer FROM events)""",
    "json_pack": f"""
        WITH text AS (
            SELECT {CUSTOMER_JSON} AS row_json
            FROM (SELECT * REPLACE (c_acctbal::decimal(18,2) AS c_acctbal) FROM customer)),
        sized AS (SELECT row_json, strlen(row_json) + 1 AS size FROM text),
        placed AS (
            SELECT row_json, size,
                   sum(size) OVER (ORDER BY row_json ROWS UNBOUNDED PRECEDING)::bigint - size AS start
            FROM sized)
        SELECT 'customer' AS source_table,
               start // {DOCUMENT_BYTES // 2} * 2 + (size > {DOCUMENT_BYTES // 2})::int AS part,
               '[' || string_agg(row_json, ',' ORDER BY row_json) || ']' AS rows_json
        FROM placed GROUP BY ALL""",
    "json_report": _report_sql(),
}

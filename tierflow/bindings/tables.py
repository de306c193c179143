"""The test tables, and the nine sources read off them.

A source here is a table plus one expression per landing column.  The expressions
are plain SQL that Spark and the checking engine read alike; all the operators
under test come after them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tierflow.operators import to_silver
from tierflow.specs import BY_NAME, FILE_NAME, LOAD_TS, NUMERIC, SOURCES, SourceSpec

FIRST_LOAD = "2024-01-01 03:30:00"
SECOND_LOAD = "2024-02-01 03:30:00.000001"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@dataclass(frozen=True)
class Binding:
    table: str
    file_name: str
    columns: dict[str, str]


def _text(**columns: str) -> dict[str, str]:
    return {name: f"cast({sql} as string)" for name, sql in columns.items()}


BINDINGS: dict[str, Binding] = {
    "ranking_allrounders": Binding(
        "supplier",
        "concat('allrounders_', cast(s_nationkey as string))",
        _text(
            rank="s_suppkey + 1", id="s_suppkey", name="s_name",
            country="concat('NATION_', cast(s_nationkey as string))", countryId="s_nationkey",
            rating="s_acctbal", points="s_suppkey * 3", difference="''",
            trend="case when s_acctbal < 0 then 'Down' else 'Up' end",
            lastUpdatedOn="'2024-01-01'", faceImageId="s_suppkey * 7",
        ),
    ),
    "ranking_batsmen": Binding(
        "customer",
        "concat('batsmen_', cast(c_nationkey as string))",
        _text(
            rank="c_custkey + 1", id="split_part(c_name, '#', 2)", name="c_name",
            country="c_mktsegment", countryId="c_nationkey", rating="c_acctbal",
            points="c_custkey", difference="c_mktsegment", trend="c_mktsegment",
            lastUpdatedOn="'2024-01-02'", faceImageId="c_custkey * 5",
        ),
    ),
    "ranking_bowlers": Binding(
        "part",
        "concat('bowlers_', lower(p_type))",
        _text(
            rank="p_partkey + 1", id="p_partkey", name="p_name", country="p_type",
            countryId="split_part(p_brand, '#', 2)", rating="p_retailprice", points="p_size",
            difference="p_size - 25", trend="p_brand", lastUpdatedOn="'2024-01-03'",
            faceImageId="p_brand",
        ),
    ),
    "ranking_teams": Binding(
        "orders",
        "concat('teams_', lower(split_part(o_orderpriority, '-', 2)))",
        _text(
            rank="o_orderkey + 1", name="o_orderpriority", rating="o_totalprice",
            points="o_custkey", difference="split_part(o_orderpriority, '-', 1)",
            trend="o_orderstatus", lastUpdatedOn="'2024-01-04'",
        ),
    ),
    "photo_gallery": Binding(
        "pages",
        "concat('gallery_', split_part(url, '/', 4))",
        _text(
            caption="url", gallery_intro="length(html)", imageId="page_id",
            gallery_published_time="'1700000000'", imageHash="md5(html)",
            gallery_id="split_part(url, '/', 5)", gallery_state="split_part(url, ':', 1)",
            gallery_headline="split_part(url, '/', 3)",
        ),
    ),
    "photos": Binding(
        "documents",
        "concat('photos_', source)",
        _text(
            caption="lang", gallery_intro="md5(text)", gallery_published_time="source",
            imageId="doc_id",
        ),
    ),
    # Codes of one to three characters in mixed case; names in mixed case.
    "team_international": Binding(
        "part",
        "concat('international_', lower(p_type))",
        _text(
            teamId="p_partkey", imageId="p_size",
            countryName="case when p_type <> 'ECONOMY' then concat('nation_', cast(p_size as string)) end",
            teamSName="concat(' ', split_part(p_brand, '#', 2), case when p_type = 'PROMO' then 'X' else '' end)",
            teamName="case when p_type = 'ECONOMY' and p_size > 10 then p_name end",
        ),
    ),
    "team_players": Binding(
        "conversations",
        "concat('players_', role)",
        _text(
            name="role", battingStyle="md5(text)", id="conv_id * 1000 + turn",
            bowlingStyle="length(text)", imageId="conv_id",
        ),
    ),
    "team_results": Binding(
        "lineitem",
        "concat('results_', l_returnflag, l_linestatus)",
        _text(
            series_name="l_returnflag", match_id="l_orderkey", match_desc="l_linenumber",
            match_format="l_linestatus", match_status="l_linestatus", state="l_returnflag",
            team1_name="l_partkey", team1_short="l_suppkey", team2_name="l_suppkey",
            team2_short="l_partkey", venue_ground="l_returnflag", venue_city="l_linestatus",
            start_date="'1700000000'", end_date="'1700000001'", team1_runs="l_quantity",
            team1_wickets="l_linenumber", team1_overs="l_discount", team2_runs="l_extendedprice",
            team2_wickets="l_returnflag", team2_overs="l_tax",
        ),
    ),
}

# The market dimension, from the nations: '0x'..'9x', '10'..; three-letter from ten on.
MARKET = Binding(
    "nation",
    "'market'",
    _text(
        alpha2="concat(cast(n_nationkey as string), case when n_nationkey < 10 then 'x' else '' end)",
        alpha3="case when n_nationkey >= 10 then concat(cast(n_nationkey as string), 'x') end",
        country="n_name", region="n_regionkey", currency_code="'CUR'", currency_name="n_name",
    ),
)


def landing_frame(spark, sf_dir, name: str) -> DataFrame:
    """A source's landing columns, as text."""
    bound = BINDINGS[name]
    return table(spark, sf_dir, bound.table).selectExpr(
        *[f"{bound.columns[c]} as {c}" for c in BY_NAME[name].landing]
    )


def bronze_frame(spark, sf_dir, name: str, load_ts: str = FIRST_LOAD) -> DataFrame:
    """Landing columns plus file name and load timestamp."""
    bound = BINDINGS[name]
    return table(spark, sf_dir, bound.table).selectExpr(
        *[f"{bound.columns[c]} as {c}" for c in BY_NAME[name].landing],
        f"{bound.file_name} as {FILE_NAME}",
        f"timestamp '{load_ts}' as {LOAD_TS}",
    )


def market_frame(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, MARKET.table).selectExpr(
        *[f"{sql} as {c}" for c, sql in MARKET.columns.items()]
    )


def silver_frames(spark, sf_dir) -> dict[str, DataFrame]:
    return {s.name: to_silver(bronze_frame(spark, sf_dir, s.name), s) for s in SOURCES}


# --- the same in SQL ------------------------------------------------------------------

NUM = f"decimal({NUMERIC.precision},{NUMERIC.scale})"


def landing_sql(name: str) -> str:
    bound = BINDINGS[name]
    cells = ", ".join(f'{bound.columns[c]} AS "{c}"' for c in BY_NAME[name].landing)
    return (
        f"SELECT {cells}, {bound.file_name} AS file_name, "
        f"TIMESTAMP '{FIRST_LOAD}' AS update_timestamp FROM {bound.table}"
    )


def silver_sql(spec: SourceSpec) -> str:
    cells = []
    for out, src in spec.columns.items():
        value = f'"{src}"'
        if out in spec.defaults:
            further, final = spec.defaults[out]
            value = f"coalesce({value}, " + ", ".join(f'"{c}"' for c in further) + f", '{final}')"
        if out in spec.numeric:
            value = f"try_cast({value} AS {NUM})"
        cells.append(f'{value} AS "{out}"')
    return f"SELECT {', '.join(cells)}, file_name, update_timestamp FROM ({landing_sql(spec.name)})"


MARKET_SQL = (
    "SELECT " + ", ".join(f"{sql} AS {c}" for c, sql in MARKET.columns.items()) + " FROM nation"
)


def plain_number(sql: str) -> str:
    """SQL text of a decimal without trailing zeros."""
    return f"regexp_replace(cast({sql} AS varchar), '\\.?0+$', '')"

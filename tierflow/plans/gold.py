"""Silver to Gold: required keys, market enrichment and the published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierflow.functions import market_codes
from tierflow.operators import (
    json_report,
    left_join_any,
    left_join_any_located,
    left_join_hot,
    located,
    market_fallback,
    nested_union,
    one_per_key,
    prefixed,
    require_key,
)
from tierflow.operators.joins import HOT_ROWS
from tierflow.plans.sources import each_source
from tierflow.sources.csv_landing import scan_csv
from tierflow.sources.tables import TableStore
from tierflow.specs import (
    INTERNATIONAL_TEAMS,
    MARKET_LANDING,
    SOURCES,
)

TEAM_COLUMNS = (
    "market_code", "market_code2", "market_code3", "team_id", "country_name",
    "image_id", "file_name", "update_timestamp",
)


def enrich_international(teams: DataFrame, market: DataFrame, scanned: bool = False) -> DataFrame:
    """International teams with both market codes, one row per team and country.

    A market matches by two-letter code, three-letter code or country name, in
    any letter case.  Of several matches and loads the newest load wins, then the
    first market code; the further columns only make the pick repeatable.
    ``scanned`` says that ``teams`` is a Parquet scan (see ``left_join_any``).
    """
    own2, own3 = market_codes("market_code")
    keyed = require_key(teams, INTERNATIONAL_TEAMS.key)
    matched = left_join_any(
        keyed,
        market.select("alpha2", "alpha3", "country"),
        [
            (F.lower(own2), F.lower("alpha2")),
            (F.lower(own3), F.lower("alpha3")),
            (F.lower("country_name"), F.lower("country")),
        ],
        scanned=(scanned, False),
    )
    order = [F.desc_nulls_last("update_timestamp")] + [
        F.asc_nulls_last(c) for c in ("alpha2", "alpha3", "file_name", "market_code", "image_id")
    ]
    picked = one_per_key(matched, ["team_id", "country_name"], order)
    return market_fallback(picked).select(*TEAM_COLUMNS)


def gold_stage(store: TableStore, market: DataFrame) -> dict[str, DataFrame]:
    """The nine Gold inputs by tag, read from Silver."""
    frames = {}
    for spec in SOURCES:
        silver = store.silver(spec)
        if spec is INTERNATIONAL_TEAMS:
            frames[spec.tag] = enrich_international(silver, market, scanned=True)
        else:
            frames[spec.tag] = require_key(silver, spec.key)
    return frames


def nested_gold(frames: dict[str, DataFrame], guarded: bool = False) -> DataFrame:
    """The master table: all sources, eleven structs and the tag."""
    return nested_union(frames, guarded)


def json_gold(frames: dict[str, DataFrame]) -> DataFrame:
    """The nine tables as (source_table, row_json)."""
    return json_report(frames)


def team_report(
    teams: DataFrame,
    players: DataFrame,
    results: DataFrame,
    scanned: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Teams with players (by id or image) and results, columns prefixed by side.

    ``scanned`` says that all three are Parquet scans (see ``left_join_any``).  A team with
    very many players, and results of very many matches, are cut (see ``left_join_hot``).
    """
    i, p, r = prefixed(teams, "i_"), prefixed(players, "p_"), prefixed(results, "r_")
    with_players = left_join_any_located(
        i,
        p,
        [(F.col("i_team_id"), F.col("p_id")), (F.col("i_image_id"), F.col("p_image_id"))],
        scanned=(scanned, scanned),
        hot_rows=hot_rows,
    )
    matches = located(r, "_match_at", scanned)
    pair, match = ["_left_at", "_right_at"], ["_match_at"]
    report = left_join_hot(with_players, matches, "i_team_id", "r_match_id", pair, match, hot_rows=hot_rows)
    return report.drop(*pair, *match)


def build_gold(store: TableStore, market_landing: str | list[str]) -> DataFrame:
    """Rebuild the nine staged tables and the master table.  Returns the latter.

    The stages are written first so that the master table reads each finished
    stage once instead of repeating its joins.
    """
    market = scan_csv(store.spark, market_landing, MARKET_LANDING)
    stage = gold_stage(store, market)
    each_source(lambda spec: store.rebuild(stage[spec.tag], spec.tag))
    staged = {spec.tag: store.gold(spec.tag) for spec in SOURCES}
    store.rebuild(nested_gold(staged), "final")
    return store.gold("final")

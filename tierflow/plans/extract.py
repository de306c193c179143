"""Landed API responses to landing CSV, one batch per source and run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from tierflow.sources.csv_landing import batch_stamp, write_landing
from tierflow.sources.responses import (
    flatten_international,
    flatten_player_rankings,
    flatten_players,
    flatten_results,
    flatten_team_rankings,
    gallery_photos,
    read_documents,
)
from tierflow.specs import (
    ALLROUNDERS,
    BATSMEN,
    BOWLERS,
    INTERNATIONAL_TEAMS,
    PLAYERS,
    RESULTS,
    TEAM_RANKINGS,
    SourceSpec,
)

FLATTENERS = {
    ALLROUNDERS.name: flatten_player_rankings,
    BATSMEN.name: flatten_player_rankings,
    BOWLERS.name: flatten_player_rankings,
    TEAM_RANKINGS.name: flatten_team_rankings,
    INTERNATIONAL_TEAMS.name: flatten_international,
    PLAYERS.name: flatten_players,
    RESULTS.name: flatten_results,
}


def land_responses(
    spark: SparkSession, spec: SourceSpec, responses: str, landing: str, when: dt.datetime
) -> str | None:
    """Flatten all response files of a source into one landing batch.

    Returns the batch folder, or None if the responses held no record.
    """
    rows = FLATTENERS[spec.name](read_documents(spark, responses))
    return write_landing(rows, f"{landing}/{spec.name}", batch_stamp(spec, when), spec.landing)


def land_gallery(
    spark: SparkSession,
    spec: SourceSpec,
    index: str,
    details: str,
    landing: str,
    when: dt.datetime,
) -> str | None:
    """As ``land_responses`` for the gallery and photo sources.

    ``details`` holds one file per gallery that answered, named by its gallery id.
    """
    answered = read_documents(spark, details).withColumnRenamed("file_name", "gallery_id")
    rows = gallery_photos(read_documents(spark, index), answered)
    return write_landing(rows, f"{landing}/{spec.name}", batch_stamp(spec, when))

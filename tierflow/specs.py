"""What differs between the nine sources: one declarative spec each.

Every layer function takes a :class:`SourceSpec`, so the nine sources share one
code path.  The names and orders below are the data contract of the landing
files and of the published tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

NUMERIC = T.DecimalType(38, 9)
FILE_PATH = "file_path"
FILE_NAME = "file_name"
LOAD_TS = "update_timestamp"


@dataclass(frozen=True)
class SourceSpec:
    """Contract of one source from landing file to Gold tag.

    ``landing``   column names in the order the landing files are declared
    ``columns``   Silver column -> landing column it is read from, in order
    ``numeric``   Silver columns typed as decimal(38,9); bad text becomes NULL
    ``defaults``  Silver column -> (further landing columns, final literal)
    ``key``       Silver column that must be present for a row to reach Gold
    ``tag``       value of ``source_table`` in the Gold tables
    ``multiline`` quoted cells may hold newlines (such files cannot be split)
    ``stamp``     precision of the date in the name of a landed batch
    """

    name: str
    landing: tuple[str, ...]
    columns: dict[str, str]
    numeric: frozenset[str]
    key: str
    tag: str
    defaults: dict[str, tuple[tuple[str, ...], str]] = field(default_factory=dict)
    multiline: bool = False
    stamp: str = "day"
    bind: str = "name"

    @property
    def landing_schema(self) -> T.StructType:
        return string_schema(self.landing)

    @property
    def bronze_schema(self) -> T.StructType:
        return (
            self.landing_schema.add(FILE_NAME, T.StringType())
            .add(LOAD_TS, T.TimestampType())
        )

    @property
    def silver_schema(self) -> T.StructType:
        out = T.StructType()
        for name in self.columns:
            out.add(name, NUMERIC if name in self.numeric else T.StringType())
        return out.add(FILE_NAME, T.StringType()).add(LOAD_TS, T.TimestampType())


def string_schema(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# --- Fixed values: landing columns, Silver columns, keys and tags -------------

PLAYER_RANKING_LANDING = (
    "rank", "id", "name", "country", "countryId", "rating", "points",
    "difference", "trend", "lastUpdatedOn", "faceImageId",
)
PLAYER_RANKING_COLUMNS = {
    "rank": "rank",
    "id": "id",
    "name": "name",
    "country": "country",
    "country_id": "countryId",
    "rating": "rating",
    "points": "points",
    "difference": "difference",
    "trend": "trend",
    "last_updated_on": "lastUpdatedOn",
    "face_image_id": "faceImageId",
}
PLAYER_RANKING_NUMERIC = frozenset(
    {"rank", "id", "country_id", "rating", "points", "difference", "face_image_id"}
)


def _player_ranking(name: str, tag: str) -> SourceSpec:
    return SourceSpec(
        name=name,
        landing=PLAYER_RANKING_LANDING,
        columns=PLAYER_RANKING_COLUMNS,
        numeric=PLAYER_RANKING_NUMERIC,
        key="rank",
        tag=tag,
    )


ALLROUNDERS = _player_ranking("ranking_allrounders", "stg_gold_ranking_allrounders")
BATSMEN = _player_ranking("ranking_batsmen", "stg_gold_ranking_batsmens")
BOWLERS = _player_ranking("ranking_bowlers", "stg_gold_ranking_bowlers")

TEAM_RANKINGS = SourceSpec(
    name="ranking_teams",
    landing=("rank", "name", "rating", "points", "difference", "trend", "lastUpdatedOn"),
    columns={
        "rank": "rank",
        "name": "name",
        "rating": "rating",
        "points": "points",
        "difference": "difference",
        "trend": "trend",
        "last_updated_on": "lastUpdatedOn",
    },
    numeric=frozenset({"rank", "rating", "points", "difference"}),
    key="rank",
    tag="stg_gold_ranking_teams",
)

GALLERY = SourceSpec(
    name="photo_gallery",
    landing=(
        "caption", "gallery_intro", "imageId", "gallery_published_time",
        "imageHash", "gallery_id", "gallery_state", "gallery_headline",
    ),
    columns={
        "caption": "caption",
        "gallery_intro": "gallery_intro",
        "image_id": "imageId",
        "gallery_published_time": "gallery_published_time",
        "imageHash": "imageHash",
        "gallery_id": "gallery_id",
        "gallery_state": "gallery_state",
        "gallery_headline": "gallery_headline",
    },
    numeric=frozenset({"image_id", "gallery_id"}),
    key="image_id",
    tag="stg_gold_photos_galary",
    multiline=True,
)

PHOTOS = SourceSpec(
    name="photos",
    landing=("caption", "gallery_intro", "gallery_published_time", "imageId"),
    columns={
        "caption": "caption",
        "gallery_intro": "gallery_intro",
        "gallery_published_time": "gallery_published_time",
        "imageId": "imageId",
    },
    numeric=frozenset(),
    key="imageId",
    tag="stg_gold_photos",
    multiline=True,
    stamp="second",
)

INTERNATIONAL_TEAMS = SourceSpec(
    name="team_international",
    landing=("teamId", "imageId", "countryName", "teamSName", "teamName"),
    columns={
        "market_code": "teamSName",
        "team_id": "teamId",
        "country_name": "countryName",
        "image_id": "imageId",
    },
    numeric=frozenset({"team_id", "image_id"}),
    defaults={"country_name": (("teamName",), "-1")},
    key="team_id",
    tag="stg_gold_team_international",
)

PLAYERS = SourceSpec(
    name="team_players",
    landing=("name", "battingStyle", "id", "bowlingStyle", "imageId"),
    columns={
        "name": "name",
        "batting_style": "battingStyle",
        "id": "id",
        "bowling_style": "bowlingStyle",
        "image_id": "imageId",
    },
    numeric=frozenset({"id", "image_id"}),
    key="id",
    tag="stg_gold_team_players",
)

RESULTS = SourceSpec(
    name="team_results",
    landing=(
        "series_name", "match_id", "match_desc", "match_format", "match_status",
        "state", "team1_name", "team1_short", "team2_name", "team2_short",
        "venue_ground", "venue_city", "start_date", "end_date", "team1_runs",
        "team1_wickets", "team1_overs", "team2_runs", "team2_wickets", "team2_overs",
    ),
    columns={
        "series_name": "series_name",
        "match_id": "match_id",
        "match_desc": "match_desc",
        "match_format": "match_format",
        "match_status": "match_status",
        "state": "state",
        "team1_name": "team1_name",
        "team1_short": "team1_short",
        "team2_name": "team2_name",
        "team2_short": "team2_short",
        "venue_ground": "venue_ground",
        "venue_city": "venue_city",
        "start_date": "start_date",
        "end_date": "end_date",
        "team1_runs": "team1_runs",
        "team1_wickets": "team1_wickets",
        "team1_overs": "team1_overs",
        "team2_runs": "team2_runs",
        "team2_wicket": "team2_wickets",
        "team2_overs": "team2_overs",
    },
    numeric=frozenset(
        {
            "match_id", "team1_runs", "team1_wickets", "team1_overs",
            "team2_runs", "team2_wicket", "team2_overs",
        }
    ),
    key="match_id",
    tag="stg_gold_team_results",
)

MARKET_LANDING = (
    "alpha2", "alpha3", "country", "region", "currency_code", "currency_name",
)

# In tag order of the wide Gold table.
SOURCES: tuple[SourceSpec, ...] = (
    INTERNATIONAL_TEAMS, PLAYERS, RESULTS, PHOTOS, GALLERY,
    ALLROUNDERS, BATSMEN, BOWLERS, TEAM_RANKINGS,
)
BY_NAME: dict[str, SourceSpec] = {s.name: s for s in SOURCES}
# Every (layer, name) to empty for a fresh start.
LAYER_TABLES = tuple((layer, s.name) for layer in ("bronze", "silver") for s in SOURCES)


def positional(spec: SourceSpec) -> SourceSpec:
    """The spec for files bound by column position instead of header name.

    Photo files are written in another column order than declared, so bound by
    position their values land under neighbouring names.  This compatible mode
    keeps that binding and exchanges the two photo columns on the way to Silver.
    """
    if spec.name != PHOTOS.name:
        return replace(spec, bind="position")
    return replace(
        spec,
        bind="position",
        columns={
            "caption": "caption",
            "gallery_intro": "gallery_intro",
            "gallery_published_time": "imageId",
            "imageId": "gallery_published_time",
        },
        numeric=frozenset({"caption"}),
    )


# --- Fixed values: Gold wide columns and nested structs -----------------------

WIDE_COLUMNS = (
    "market_code", "market_code2", "market_code3", "team_id", "country_name",
    "image_id", "file_name", "update_timestamp", "caption", "gallery_intro",
    "gallery_published_time", "imageid", "imagehash", "gallery_id",
    "gallery_state", "gallery_headline", "rank", "id", "name", "country",
    "country_id", "rating", "points", "difference", "trend", "last_updated_on",
    "face_image_id", "batting_style", "bowling_style", "series_name", "match_id",
    "match_desc", "match_format", "match_status", "state", "team1_name",
    "team1_short", "team2_name", "team2_short", "venue_ground", "venue_city",
    "start_date", "end_date", "team1_runs", "team1_wickets", "team1_overs",
    "team2_runs", "team2_wicket", "team2_overs",
)

# Wide columns that are numbers wherever a nested struct shows them.
WIDE_NUMERIC = frozenset(
    {
        "team_id", "image_id", "imageid", "gallery_id", "rank", "id", "rating",
        "points", "face_image_id", "match_id", "team1_runs", "team1_wickets",
        "team1_overs", "team2_runs", "team2_wicket", "team2_overs",
    }
)


def _ranking_fields(prefix: str) -> tuple[tuple[str, str], ...]:
    return (
        (f"{prefix}_name", "name"),
        (f"{prefix}_id", "id"),
        (f"{prefix}_country_name", "country"),
        (f"{prefix}_rank", "rank"),
        (f"{prefix}_rating", "rating"),
        (f"{prefix}_points", "points"),
        (f"{prefix}_face_image_id", "face_image_id"),
        ("last_updated_on", "last_updated_on"),
    )


# Struct name -> (field, wide column) pairs, in output order.
GOLD_STRUCTS: dict[str, tuple[tuple[str, str], ...]] = {
    "GEOGRAPHY": (
        ("country_name", "country_name"),
        ("market_code", "market_code"),
        ("market_code2", "market_code2"),
        ("market_code3", "market_code3"),
    ),
    "ICCRANKING_ALLROUNDER": _ranking_fields("player"),
    "ICCRANKING_BATSMENS": _ranking_fields("batsmen"),
    "ICCRANKING_BOWLERS": _ranking_fields("bowler"),
    "ICCRANKING_TEAMS": (
        ("team_name", "name"),
        ("team_rank", "rank"),
        ("team_rating", "rating"),
        ("team_points", "points"),
        ("last_updated_on", "last_updated_on"),
    ),
    "INTERNATIONAL_TEAM": (
        ("country_name", "country_name"),
        ("team_id", "team_id"),
        ("image_id", "image_id"),
    ),
    "INTERNATIONAL_TEAM_PLAYERS": (
        ("player_name", "name"),
        ("player_id", "id"),
        ("batting_style", "batting_style"),
        ("bowling_style", "bowling_style"),
        ("image_id", "image_id"),
    ),
    "INTERNATIONAL_TEAM_RESULTS": tuple(
        (name, name)
        for name in (
            "series_name", "match_id", "match_desc", "match_format",
            "match_status", "team1_name", "team2_name", "venue_ground",
            "venue_city", "start_date", "end_date", "team1_runs",
            "team1_wickets", "team1_overs", "team2_runs", "team2_wicket",
            "team2_overs",
        )
    ),
    "PHOTOS": (
        ("caption", "caption"),
        ("image_id", "imageid"),
        ("gallery_intro", "gallery_intro"),
        ("gallery_published_time", "gallery_published_time"),
    ),
    "PHOTO_GALARY": (
        ("caption", "caption"),
        ("gallery_intro", "gallery_intro"),
        ("gallery_published_time", "gallery_published_time"),
        ("imageHash", "imagehash"),
        ("gallery_id", "gallery_id"),
        ("gallery_state", "gallery_state"),
        ("gallery_headline", "gallery_headline"),
    ),
}

# The ranking structs and the one source each is named after (guarded mode).
RANKING_OWNER = {
    "ICCRANKING_ALLROUNDER": ALLROUNDERS.tag,
    "ICCRANKING_BATSMENS": BATSMEN.tag,
    "ICCRANKING_BOWLERS": BOWLERS.tag,
    "ICCRANKING_TEAMS": TEAM_RANKINGS.tag,
}


def metadata_label(tag: str) -> str:
    """``stg_gold_photos`` -> ``photos``, the prefix of its METADATA fields."""
    return tag.removeprefix("stg_gold_")

"""Landed API responses (one JSON document per row) flattened to records.

Documents are parsed to VARIANT once and exploded; every step is narrow, so the
work splits by document and nothing is shuffled except in the gallery lookup.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierflow.functions.scalars import file_stem, uri_text
from tierflow.functions.variants import (
    elements,
    field_or_blank,
    field_text,
    has_field,
    is_array,
    is_object,
    is_truthy,
    value_text,
)
from tierflow.specs import (
    INTERNATIONAL_TEAMS,
    PLAYER_RANKING_LANDING,
    PLAYERS,
    TEAM_RANKINGS,
)

# Keys of the responses.
PLAYER_LIST_KEYS = ("player", "players", "list")
GALLERY_HEADER = {
    "gallery_headline": "headline",
    "gallery_intro": "intro",
    "gallery_published_time": "publishedTime",
    "gallery_state": "state",
}
MATCH_FIELDS = {
    "match_id": "matchInfo.matchId",
    "match_desc": "matchInfo.matchDesc",
    "match_format": "matchInfo.matchFormat",
    "match_status": "matchInfo.status",
    "state": "matchInfo.state",
    "team1_name": "matchInfo.team1.teamName",
    "team1_short": "matchInfo.team1.teamSName",
    "team2_name": "matchInfo.team2.teamName",
    "team2_short": "matchInfo.team2.teamSName",
    "venue_ground": "matchInfo.venueInfo.ground",
    "venue_city": "matchInfo.venueInfo.city",
    "start_date": "matchInfo.startDate",
    "end_date": "matchInfo.endDate",
    "team1_runs": "matchScore.team1Score.inngs1.runs",
    "team1_wickets": "matchScore.team1Score.inngs1.wickets",
    "team1_overs": "matchScore.team1Score.inngs1.overs",
    "team2_runs": "matchScore.team2Score.inngs1.runs",
    "team2_wickets": "matchScore.team2Score.inngs1.wickets",
    "team2_overs": "matchScore.team2Score.inngs1.overs",
}


def read_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file_name, value): one row per JSON file, the whole document as text."""
    return spark.read.text(path, wholetext=True).select(
        file_stem(uri_text(F.col("_metadata.file_path"))).alias("file_name"), "value"
    )


def _records(raw: DataFrame, items: Column, value: str = "value") -> DataFrame:
    """One row per object in a list of the document; other columns are kept."""
    kept = [c for c in raw.columns if c != value]
    listed = raw.withColumn("_doc", F.try_parse_json(value))
    exploded = listed.select(*kept, F.explode(items).alias("_item"))
    return exploded.filter(is_object(F.col("_item")))


def _doc_list(key: str) -> Column:
    return elements(F.col("_doc"), key)


def _fields(names, blank_if_absent=()) -> list[Column]:
    item = F.col("_item")
    return [
        (field_or_blank if n in blank_if_absent else field_text)(item, n).alias(n) for n in names
    ]


def flatten_player_rankings(raw: DataFrame) -> DataFrame:
    """One row per entry of ``rank[]``; an absent ``difference`` becomes ''."""
    return _records(raw, _doc_list("rank")).select(
        *_fields(PLAYER_RANKING_LANDING, blank_if_absent=("difference",))
    )


def flatten_team_rankings(raw: DataFrame) -> DataFrame:
    """As for players, with the seven team columns."""
    return _records(raw, _doc_list("rank")).select(
        *_fields(TEAM_RANKINGS.landing, blank_if_absent=("difference",))
    )


def flatten_international(raw: DataFrame) -> DataFrame:
    """One row per entry of ``list[]``."""
    return _records(raw, _doc_list("list")).select(*_fields(INTERNATIONAL_TEAMS.landing))


def flatten_players(raw: DataFrame) -> DataFrame:
    """Players from whichever list the document holds.

    The list is under the first of the known keys that is present, else under the
    first key (document order) whose value is a list, else the document itself.
    """
    by_key = F.from_json("value", "map<string,variant>")
    known = F.coalesce(
        *[F.when(F.map_contains_key("_map", k), F.lit(k)) for k in PLAYER_LIST_KEYS]
    )
    first_list = F.get(
        F.filter(F.map_keys("_map"), lambda k: is_array(F.element_at(F.col("_map"), k))), F.lit(0)
    )
    chosen = F.try_element_at("_map", F.coalesce(known, first_list))
    items = F.when(
        F.col("_map").isNull(), F.from_json("value", "array<variant>")
    ).otherwise(F.try_variant_get(chosen, "$", "array<variant>"))
    return (
        raw.withColumn("_map", by_key)
        .select(F.explode(items).alias("_item"))
        .filter(is_object(F.col("_item")))
        .select(*_fields(PLAYERS.landing))
    )


def flatten_results(raw: DataFrame) -> DataFrame:
    """One row per match of each series; absent nested objects leave NULLs."""
    item = F.col("_item")
    series = _records(raw, _doc_list("teamMatchesData")).select(
        field_or_blank(item, "matchDetailsMap.key").alias("series_name"),
        elements(item, "matchDetailsMap.match").alias("_matches"),
    )
    return (
        series.select("series_name", F.explode("_matches").alias("_item"))
        .filter(is_object(item))
        .select("series_name", *[field_text(item, p).alias(n) for n, p in MATCH_FIELDS.items()])
    )


def flatten_gallery_index(raw: DataFrame) -> DataFrame:
    """``gallery_id`` of every listed gallery that has one."""
    return listed_galleries(raw).select("gallery_id")


def listed_galleries(raw: DataFrame) -> DataFrame:
    """(gallery_id, listed): the galleries and where in which document they are listed."""
    gid = F.try_variant_get(F.col("_item"), "$.photoGalleryInfo.galleryId", "variant")
    file = F.col("file_name") if "file_name" in raw.columns else F.lit("")
    documents = raw.select(file.alias("_file"), F.try_parse_json("value").alias("_doc"))
    items = documents.select("_file", F.posexplode(_doc_list("photoGalleryInfoList")).alias("_place", "_item"))
    return (
        items.filter(is_object(F.col("_item")))
        .filter(gid.isNotNull() & is_truthy(gid))
        .select(value_text(gid).alias("gallery_id"), F.struct("_file", "_place").alias("listed"))
    )


def gallery_details(index: DataFrame, detail: DataFrame) -> DataFrame:
    """(gallery_id, value): the detail document of each listed gallery.

    ``detail`` holds one document per gallery that answered; galleries without
    one contribute nothing.
    """
    return index.select("gallery_id").join(detail.select("gallery_id", "value"), "gallery_id")


def flatten_gallery_detail(
    detail: DataFrame, photo_fields: tuple[str, ...] = ("caption", "imageId", "imageHash")
) -> DataFrame:
    """Gallery header × photos.  A photo's own key of the same name wins."""
    doc, photo = F.col("_doc"), F.col("_photo")
    photos = detail.withColumn("_doc", F.try_parse_json("value")).select(
        "gallery_id",
        *[field_or_blank(doc, key).alias(name) for name, key in GALLERY_HEADER.items()],
        F.explode(elements(doc, "photoGalleryDetails")).alias("_photo"),
    )
    header = ("gallery_id", *GALLERY_HEADER)
    return photos.select(
        *[
            F.when(has_field(photo, n), field_text(photo, n)).otherwise(F.col(n)).alias(n)
            for n in header
        ],
        *[field_text(photo, n).alias(n) for n in photo_fields if n not in header],
    )


def gallery_photos(index_raw: DataFrame, detail: DataFrame) -> DataFrame:
    """Index documents and detail documents to photo records, with all keys any photo has.

    The columns are the header's, then the photos' keys in first-seen order (see
    ``ragged_table``), in the order the galleries are listed.
    """
    answers = listed_galleries(index_raw).join(detail.select("gallery_id", "value"), "gallery_id")
    doc, photo = F.col("_doc"), F.col("_photo")
    header = [field_or_blank(doc, key).alias(name) for name, key in GALLERY_HEADER.items()]
    photos = answers.select(
        "gallery_id",
        "listed",
        F.try_parse_json("value").alias("_doc"),
        # As text, one by one: a photo that is no object keeps the header only.
        F.from_json("value", "photoGalleryDetails array<string>")["photoGalleryDetails"].alias("_photos"),
    ).select("gallery_id", "listed", *header, F.posexplode("_photos").alias("_photo_place", "_photo"))
    own = F.when(photo.startswith("{"), F.from_json(photo, "map<string,variant>"))
    records = photos.select(
        F.struct("listed", "gallery_id", "_photo_place").alias("_order"), "gallery_id", *GALLERY_HEADER, own.alias("_own")
    )
    return ragged_table(records, "_own", "_order")


def ragged_table(records: DataFrame, fields: str, order: str) -> DataFrame:
    """Records with a map of further fields (name to VARIANT) as one table.

    The columns are those of ``records``, then the names found in any map, in first-seen
    order: by the record's ``order`` and the place in its map.  A field with the name of a
    column replaces its value where the record has it, also by null; a record without
    a field leaves its cell null.  Names that differ in letter case only are one column,
    spelled as first seen.  Only the names, found by a grouped minimum, pass the driver:
    they are the schema.
    """
    place = F.struct(F.col(order).alias("record"), F.col("_place").alias("place"), F.col("_name").alias("name"))
    names = (
        records.select(order, F.posexplode(F.map_keys(fields)).alias("_place", "_name"))
        .groupBy(F.lower("_name").alias("_folded"))
        .agg(F.min(place).alias("_first"), F.collect_set("_name").alias("_spellings"))
        .orderBy("_first")
        .select(F.col("_first.name").alias("name"), "_folded", "_spellings")
        .collect()
    )
    fixed = [c for c in records.columns if c not in (fields, order)]
    spelled = {r["_folded"]: sorted(r["_spellings"], key=lambda s: (s != r["name"], s)) for r in names}

    def own(name: str, otherwise: Column) -> Column:
        out = otherwise
        for spelling in reversed(spelled.get(name.lower(), [])):
            out = F.when(F.map_contains_key(fields, spelling), value_text(F.try_element_at(fields, F.lit(spelling)))).otherwise(out)
        return out

    taken = {c.lower() for c in fixed}
    return records.select(
        *[own(c, F.col(c)).alias(c) for c in fixed],
        *[own(r["name"], F.lit(None).cast("string")).alias(r["name"]) for r in names if r["_folded"] not in taken],
    )


def union_ragged(frames: list[DataFrame]) -> DataFrame:
    """All rows of frames with differing columns; columns in first-seen order.

    Cells a frame lacks are NULL, which the CSV sink writes as an empty cell.
    """
    order = list(dict.fromkeys(c for df in frames for c in df.columns))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return union.select(*order)

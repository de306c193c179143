import datetime as dt
import json
import os
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierflow.operators import latest_batch, require_key, to_silver
from tierflow.plans import (
    archive,
    archive_check,
    archive_tally,
    archived_lines,
    arrival_audit,
    build_gold,
    enrich_international,
    incoming_rows,
    json_gold,
    land_gallery,
    land_responses,
    load_bronze,
    refresh_silver,
    team_report,
)
from tierflow.plans.gold import gold_stage
from tierflow.sources import scan_csv, write_landing
from tierflow.specs import (
    BY_NAME,
    GALLERY,
    INTERNATIONAL_TEAMS,
    LAYER_TABLES,
    MARKET_LANDING,
    PHOTOS,
    PLAYERS,
    SOURCES,
    TEAM_RANKINGS,
    positional,
)
from tierflow.streaming import ingest_stream

DAY = [dt.datetime(2024, 1, d, 3, 30, tzinfo=dt.timezone.utc) for d in range(1, 10)]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=str)


def team(rank, name, **more):
    return {"rank": rank, "name": name, **more}


def ranks(store):
    return rows(store.silver(TEAM_RANKINGS), "file_name", "rank", "name")


# --- Bronze and Silver ---------------------------------------------------------------


def test_bronze_appends_every_run(store, land):
    path = land("teams", "a_20240101.csv", TEAM_RANKINGS.landing, [team(1, "A"), team(2, "B")])
    load_bronze(store, TEAM_RANKINGS, path, DAY[0])
    bronze = load_bronze(store, TEAM_RANKINGS, path, DAY[1])
    assert bronze.count() == 4
    assert rows(bronze.groupBy("file_name", "load_id").count()) == [
        ("a_20240101", "L20240101033000000000", 2), ("a_20240101", "L20240102033000000000", 2),
    ]


def test_silver_scenarios(store, land):
    a, b = "a_20240101", "b_20240201"
    header = TEAM_RANKINGS.landing

    # nothing landed yet
    assert ranks(store) == []
    refresh_silver(store, TEAM_RANKINGS)
    assert ranks(store) == []

    # first load, a duplicate row is kept
    path = land("teams", f"{a}.csv", header, [team("1", "A"), team("1", "A"), team("x", "bad")])
    load_bronze(store, TEAM_RANKINGS, path, DAY[0])
    refresh_silver(store, TEAM_RANKINGS)
    one = Decimal("1.000000000")
    assert ranks(store) == sorted([(a, one, "A"), (a, one, "A"), (a, None, "bad")], key=str)

    # no new load: unchanged
    before = rows(store.silver(TEAM_RANKINGS))
    refresh_silver(store, TEAM_RANKINGS)
    assert rows(store.silver(TEAM_RANKINGS)) == before

    # the same file again: same rows, later timestamp
    load_bronze(store, TEAM_RANKINGS, path, DAY[1])
    refresh_silver(store, TEAM_RANKINGS)
    assert len(ranks(store)) == 3
    stamps = rows(store.silver(TEAM_RANKINGS).select("update_timestamp").distinct())
    assert stamps == [(DAY[1].replace(tzinfo=None),)]

    # the same file with other rows, beside a new file
    land("teams", f"{a}.csv", header, [team("7", "New")])
    land("teams", f"{b}.csv", header, [team("2", "B")])
    load_bronze(store, TEAM_RANKINGS, path, DAY[2])
    refresh_silver(store, TEAM_RANKINGS)
    assert ranks(store) == [(a, Decimal(7), "New"), (b, Decimal(2), "B")]

    # the old file left landing: Silver keeps it
    os.remove(f"{path}/{a}.csv")
    load_bronze(store, TEAM_RANKINGS, path, DAY[3])
    refresh_silver(store, TEAM_RANKINGS)
    assert ranks(store) == [(a, Decimal(7), "New"), (b, Decimal(2), "B")]
    latest = store.silver(TEAM_RANKINGS).filter(F.col("file_name") == b).first()
    assert latest.update_timestamp == DAY[3].replace(tzinfo=None)


def test_silver_repairs_a_lost_file(store, land):
    path = land("teams", "a.csv", TEAM_RANKINGS.landing, [team("1", "A")])
    path = land("teams", "b.csv", TEAM_RANKINGS.landing, [team("2", "B")])
    load_bronze(store, TEAM_RANKINGS, path, DAY[0])
    only_a = incoming_rows(store, TEAM_RANKINGS).filter("file_name = 'a'")
    store.replace_by_file(only_a, TEAM_RANKINGS.name)
    refresh_silver(store, TEAM_RANKINGS)
    assert [r[0] for r in ranks(store)] == ["a", "b"]


def test_all_digit_file_names_stay_text(store, land):
    path = land("teams", "007.csv", TEAM_RANKINGS.landing, [team("1", "A")])
    load_bronze(store, TEAM_RANKINGS, path, DAY[0])
    refresh_silver(store, TEAM_RANKINGS)
    assert ranks(store) == [("007", Decimal(1), "A")]


def test_refresh_reads_only_pending_loads(store, land, spark):
    for n in range(4):
        path = land(f"teams{n}", f"f{n}.csv", TEAM_RANKINGS.landing, [team(str(n), "A")])
        load_bronze(store, TEAM_RANKINGS, path, DAY[n])
        if n < 3:
            refresh_silver(store, TEAM_RANKINGS)
    rows_in = incoming_rows(store, TEAM_RANKINGS)
    assert [r.file_name for r in rows_in.collect()] == ["f3"]
    plan = rows_in._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*dynamicpruning", plan)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert store.latest(TEAM_RANKINGS).count() == 4


def test_latest_rows_come_from_the_manifest(store, land):
    path = land("teams", "a.csv", TEAM_RANKINGS.landing, [team("1", "A"), team("1", "A"), team("2", "B")])
    land("teams", "b.csv", TEAM_RANKINGS.landing, [team("3", "C")])
    load_bronze(store, TEAM_RANKINGS, path, DAY[0])
    os.remove(f"{path}/b.csv")
    land("teams", "a.csv", TEAM_RANKINGS.landing, [team("7", "New"), team("7", "New")])
    load_bronze(store, TEAM_RANKINGS, path, DAY[1])
    entries = store.manifest(TEAM_RANKINGS.name)
    assert rows(entries, "file_name", "n_rows") == sorted([("a", 2), ("a", 3), ("b", 1)])
    assert rows(store.latest(TEAM_RANKINGS), "file_name", "rank") == [("a", "7"), ("a", "7"), ("b", "3")]
    plan = store.latest(TEAM_RANKINGS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("bronze/ranking_teams") == 1 and re.search(r"PartitionFilters: \[[^]]*dynamicpruning", plan)


def test_a_load_without_its_entry_is_found(store, land, spark, folder):
    path = land("teams", "a.csv", TEAM_RANKINGS.landing, [team("1", "A")])
    load_bronze(store, TEAM_RANKINGS, path, DAY[0])
    refresh_silver(store, TEAM_RANKINGS)
    entry = store._enter
    store._enter = lambda *_: None  # the driver is lost before the entry is written
    land("teams", "b.csv", TEAM_RANKINGS.landing, [team("2", "B")])
    load_bronze(store, TEAM_RANKINGS, path, DAY[1])
    store._enter = entry
    refresh_silver(store, TEAM_RANKINGS)
    assert [r[0] for r in ranks(store)] == ["a", "b"]


@pytest.mark.parametrize("spec", SOURCES, ids=lambda s: s.name)
def test_every_source_reaches_silver(store, land, spec):
    header = list(reversed(spec.landing))  # bound by name, so the order is free
    path = land(spec.name, f"{spec.name}_20240101.csv", header, [{c: "3" for c in header}])
    load_bronze(store, spec, path, DAY[0])
    got = refresh_silver(store, spec)
    assert got.schema.simpleString() == spec.silver_schema.simpleString()
    row = got.first().asDict()
    assert row.pop("file_name") == f"{spec.name}_20240101"
    row.pop("update_timestamp")
    assert row == {c: Decimal(3) if c in spec.numeric else "3" for c in spec.columns}


def test_silver_types_edge_values(store, land):
    path = land(
        "players", "p.csv", PLAYERS.landing,
        [["n", "bat", "19.4", "bowl", "0.12345678955"], ["m", "", "1,000", "", "abc"]],
    )
    load_bronze(store, PLAYERS, path, DAY[0])
    got = refresh_silver(store, PLAYERS)
    assert rows(got, "name", "id", "image_id") == sorted(
        [("n", Decimal("19.400000000"), Decimal("0.123456790")), ("m", None, None)], key=str
    )


def test_default_chain(store, land):
    header = INTERNATIONAL_TEAMS.landing
    path = land("t", "t.csv", header, [
        {"teamId": "1", "countryName": "C", "teamName": "T"},
        {"teamId": "2", "teamName": "T"},
        {"teamId": "3"},
    ])
    load_bronze(store, INTERNATIONAL_TEAMS, path, DAY[0])
    assert rows(refresh_silver(store, INTERNATIONAL_TEAMS), "country_name") == [("-1",), ("C",), ("T",)]


EMITTED = [
    "gallery_id", "gallery_headline", "gallery_intro", "gallery_published_time",
    "gallery_state", "caption", "imageId", "imageHash",
]
PHOTO_ROW = ["7", "head", "intro", "1700", "active", "cap, \"q\"\nnext", "55", "h"]


def test_photos_by_name_and_by_position(store, land):
    path = land("photos", "gallery_details_20240101_010203.csv", EMITTED, [PHOTO_ROW])
    load_bronze(store, PHOTOS, path, DAY[0])
    by_name = refresh_silver(store, PHOTOS).first()
    assert (by_name.caption, by_name.imageId, by_name.gallery_published_time) == (
        'cap, "q"\nnext', "55", "1700")

    spec = positional(PHOTOS)
    other = type(store)(store.spark, store.root + "_positional")
    load_bronze(other, spec, path, DAY[0])
    by_position = refresh_silver(other, spec).first()
    # first four cells under the declared names, then the two columns exchanged
    assert by_position.caption == Decimal(7)
    assert by_position.gallery_intro == "head"
    assert by_position.gallery_published_time == "1700"
    assert by_position.imageId == "intro"


def test_gallery_by_position_loses_its_key(store, land):
    path = land("gallery", "g.csv", EMITTED, [PHOTO_ROW])
    spec = positional(GALLERY)
    load_bronze(store, spec, path, DAY[0])
    assert refresh_silver(store, spec).filter("image_id is not null").count() == 0
    other = type(store)(store.spark, store.root + "_named")
    load_bronze(other, GALLERY, path, DAY[0])
    assert refresh_silver(other, GALLERY).filter("image_id is not null").count() == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_silver_equals_latest_bronze_after_any_loads(store, spark, seed):
    rng = random.Random(seed)
    for step in range(4):
        batch = [
            (str(rng.randint(1, 9)), f"team{rng.randint(1, 3)}", f"file{f}")
            for f in range(4) if rng.random() < 0.5
            for _ in range(rng.randint(1, 3))
        ]
        df = spark.createDataFrame(batch, "rank string, name string, file_name string")
        empty = {c: F.lit(None).cast("string") for c in TEAM_RANKINGS.landing if c not in df.columns}
        load = df.withColumns(empty | {"update_timestamp": F.lit(DAY[step]).cast("timestamp")})
        store.append_bronze(load, TEAM_RANKINGS.name)
        if rng.random() < 0.7:
            refresh_silver(store, TEAM_RANKINGS)
    refresh_silver(store, TEAM_RANKINGS)
    newest = to_silver(latest_batch(store.bronze(TEAM_RANKINGS)), TEAM_RANKINGS)
    assert rows(store.silver(TEAM_RANKINGS)) == rows(newest)


# --- from responses to Silver -----------------------------------------------------------------


def test_responses_reach_silver(store, spark, folder):
    documents = {
        "ranking_batsmen": {"rank": [{"rank": "1", "id": 5, "name": "A, \"B\"", "points": 19.4}]},
        "ranking_teams": {"rank": [{"rank": 2, "name": "T"}]},
        "team_international": {"list": [{"teamId": 3, "teamName": "N"}]},
        "team_players": {"squad": [{"id": 4, "name": "P"}]},
        "team_results": {"teamMatchesData": [
            {"matchDetailsMap": {"key": "S", "match": [{"matchInfo": {"matchId": 6}}]}}]},
        "gallery_index": {"photoGalleryInfoList": [{"photoGalleryInfo": {"galleryId": 7}}]},
        "gallery_detail": {"intro": "I", "photoGalleryDetails": [{"caption": "c\nd", "imageId": 8}]},
    }
    for name, doc in documents.items():
        os.makedirs(f"{folder}/responses/{name}")
        with open(f"{folder}/responses/{name}/7.json", "w") as f:
            json.dump(doc, f, indent=2)
    landing, when = f"{folder}/landing", dt.datetime(2024, 3, 1, 2, 3, 4)
    keys = {}
    for name in ("ranking_batsmen", "ranking_teams", "team_international", "team_players", "team_results"):
        spec = BY_NAME[name]
        batch = land_responses(spark, spec, f"{folder}/responses/{name}", landing, when)
        assert batch == f"{landing}/{name}/20240301"
        load_bronze(store, spec, batch, DAY[0])
        keys[name] = [int(r[0]) for r in refresh_silver(store, spec).select(spec.key).collect()]
    for spec in (GALLERY, PHOTOS):
        batch = land_gallery(spark, spec, f"{folder}/responses/gallery_index",
                             f"{folder}/responses/gallery_detail", landing, when)
        load_bronze(store, spec, batch, DAY[0])
        got = refresh_silver(store, spec).first()
        assert (got.caption, got.gallery_intro) == ("c\nd", "I")
        keys[spec.name] = [int(got[spec.key])]
    assert os.path.exists(f"{landing}/photos/20240301_020304")
    assert keys == {"ranking_batsmen": [1], "ranking_teams": [2], "team_international": [3],
                    "team_players": [4], "team_results": [6], "photo_gallery": [8], "photos": [8]}


# --- Gold -----------------------------------------------------------------------------------

MARKET_ROWS = [
    ["IN", "IND", "India", "Asia", "INR", "Rupee"],
    ["AU", "AUS", "Australia", "Oceania", "AUD", "Dollar"],
    ["NZ", "NZL", "New Zealand", "Oceania", "NZD", "Dollar"],
    ["ZA", "ZAF", "South Africa", "Africa", "ZAR", "Rand"],
]
TEAM_ROWS = [
    {"teamId": "1", "teamSName": "in", "countryName": "India", "teamName": "India"},
    {"teamId": "2", "teamSName": "AUS", "countryName": "Australia", "teamName": "Australia"},
    {"teamId": "3", "teamSName": " NZ ", "teamName": "New Zealand"},
    {"teamId": "4", "teamSName": "WI-A", "countryName": "Nowhere", "teamName": "x"},
    {"teamId": "5", "teamSName": "SAF1", "countryName": "South Africa", "teamName": "x"},
    {"teamId": "6"},
    {"teamId": "7", "teamSName": "NZ", "countryName": "australia"},
    {"teamId": "8", "teamSName": "ENG", "countryName": "England"},
    {"teamId": "none", "teamSName": "IN", "countryName": "India"},
]


@pytest.fixture
def market(spark, land):
    return scan_csv(spark, land("market", "m.csv", MARKET_LANDING, MARKET_ROWS), MARKET_LANDING)


def test_market_enrichment(store, land, market):
    path = land("t", "t.csv", INTERNATIONAL_TEAMS.landing, TEAM_ROWS)
    load_bronze(store, INTERNATIONAL_TEAMS, path, DAY[0])
    got = enrich_international(refresh_silver(store, INTERNATIONAL_TEAMS), market)
    assert rows(got, F.col("team_id").cast("int"), "country_name", "market_code", "market_code2", "market_code3") == sorted([
        (1, "India", "in", "IN", "IND"),
        (2, "Australia", "AUS", "AU", "AUS"),
        (3, "New Zealand", " NZ ", "NZ", "NZL"),
        (4, "Nowhere", "WI-A", None, None),
        (5, "South Africa", "SAF1", "ZA", "ZAF"),
        (6, "-1", None, None, None),
        (7, "australia", "NZ", "AU", "AUS"),  # two markets match, the first code wins
        (8, "England", "ENG", None, "ENG"),  # own code, no market
    ], key=str)


def test_team_report(spark):
    teams = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "team_id int, image_id int")
    players = spark.createDataFrame([(1, 99, "id"), (8, 20, "image"), (1, 10, "both")], "id int, image_id int, n string")
    results = spark.createDataFrame([(2, "r"), (2, "s")], "match_id int, m string")
    got = team_report(teams, players, results)
    assert got.columns == ["i_team_id", "i_image_id", "p_id", "p_image_id", "p_n", "r_match_id", "r_m"]
    assert rows(got, "i_team_id", "p_n", "r_m") == sorted([
        (1, "id", None), (1, "both", None), (2, "image", "r"), (2, "image", "s"), (3, None, None),
    ], key=str)


def test_team_report_with_hot_teams(spark):
    """Teams with many players and many results, cut at a few rows: the same report."""
    teams = spark.range(6).selectExpr("cast(id as int) as team_id", "cast(id + 100 as int) as image_id")
    players = spark.range(90).selectExpr(
        "cast(if(id % 3 = 0, 1, id % 9) as int) as id", "cast(100 + id % 5 as int) as image_id", "id as n")
    results = spark.range(60).selectExpr("cast(if(id % 3 = 0, 1, id % 11) as int) as match_id", "id as m")
    whole = rows(team_report(teams, players, results))
    assert whole == rows(team_report(teams, players, results, hot_rows=4))
    assert len(whole) > 700


def land_all(land):
    paths = {}
    for spec in SOURCES:
        if spec is INTERNATIONAL_TEAMS:
            data = TEAM_ROWS
        else:
            data = [{c: "3" for c in spec.landing}, {c: "" for c in spec.landing}]
        paths[spec.name] = land(spec.name, f"{spec.name}_20240101.csv", spec.landing, data)
    return paths


def test_all_layers(store, land):
    paths = land_all(land)
    assert len(LAYER_TABLES) == 2 * len(paths)
    for name, path in paths.items():
        load_bronze(store, BY_NAME[name], path, DAY[0])
        refresh_silver(store, BY_NAME[name])
    market = land("market", "m.csv", MARKET_LANDING, MARKET_ROWS)
    gold = build_gold(store, market)
    counts = dict(rows(gold.groupBy("source_table").count()))
    # rows without their key do not reach Gold
    assert counts == {s.tag: 8 if s is INTERNATIONAL_TEAMS else 1 for s in SOURCES}
    first = gold.filter("source_table = 'stg_gold_team_results'").first()
    assert first.INTERNATIONAL_TEAM_RESULTS.team2_wicket == Decimal(3)
    assert first.METADATA.team_results_file_name == "team_results_20240101"
    assert first.METADATA.team_results_update_timestamp == DAY[0].replace(tzinfo=None)

    plan = require_key(store.silver(PLAYERS), "id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id)]" in plan

    # a second build replaces the first
    assert rows(build_gold(store, market).groupBy("source_table").count()) == sorted(counts.items())

    frames = gold_stage(store, scan_csv(store.spark, market, MARKET_LANDING))
    report = json_gold(frames)
    assert report.columns == ["source_table", "row_json"]
    tag = TEAM_RANKINGS.tag
    assert [r.row_json for r in report.filter(F.col("source_table") == tag).collect()] == [
        '{"rank":3,"name":"3","rating":3,"points":3,"difference":3,"trend":"3",'
        '"last_updated_on":"3","file_name":"ranking_teams_20240101",'
        '"update_timestamp":"2024-01-01T03:30:00.000000Z"}'
    ]


# --- table maintenance ------------------------------------------------------------------------


def test_rebuild_may_read_itself(store, spark):
    store.rebuild(spark.range(3), "t")
    first = store.gold("t")
    store.rebuild(store.gold("t").selectExpr("id + 10 as id"), "t")
    assert rows(store.gold("t")) == [(10,), (11,), (12,)]
    assert rows(first) == [(0,), (1,), (2,)]  # readers of the old build are not disturbed


def test_truncate_keeps_columns(store, land, spark):
    path = land("teams", "a.csv", TEAM_RANKINGS.landing, [team("1", "A")])
    load_bronze(store, TEAM_RANKINGS, path, DAY[0])
    refresh_silver(store, TEAM_RANKINGS)
    store.rebuild(spark.range(3), "t")
    store.truncate([("bronze", TEAM_RANKINGS.name), ("silver", TEAM_RANKINGS.name), ("gold", "t")])
    assert store.bronze(TEAM_RANKINGS).count() == 0
    assert store.silver(TEAM_RANKINGS).count() == 0
    assert store.gold("t").columns == ["id"] and store.gold("t").count() == 0
    load_bronze(store, TEAM_RANKINGS, path, DAY[1])
    refresh_silver(store, TEAM_RANKINGS)
    assert ranks(store) == [("a", Decimal(1), "A")]


def test_missing_table_without_schema_raises(store):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.read("gold", "nothing")


# --- archive and audit ---------------------------------------------------------------------------


def test_archive_and_tally(store, land, spark, folder):
    a = land("a", "x y.v2.csv", ["h"], [["1"], ["two, 2"]])
    land("a", "z.csv", ["h"], [["3"]])
    open(f"{a}/marker", "w").close()
    b = land("b", "b.csv", ["h"], [])
    sources = {"a": a, "b": b, "gone": f"{folder}/landing/gone"}
    day = dt.date(2024, 1, 1)
    assert archive(store, sources, day) == ["a", "b"]
    assert rows(archive_tally(store, sources, day)) == sorted(
        [("a", 2, 0, False), ("b", 1, 0, False), (None, 3, 0, True)], key=str)
    assert rows(archive_tally(store, sources, dt.date(2024, 1, 2))) == sorted(
        [("a", 0, 2, False), ("b", 0, 1, False), (None, 0, 3, True)], key=str)

    kept = archived_lines(store, "a", day).filter("file = 'x y.v2.csv'").orderBy("block_start", "line_id")
    with open(f"{a}/x y.v2.csv", newline="") as f:
        assert "\n".join(r.line for r in kept.collect()) + "\n" == f.read()

    # the same name on the same day replaces, another day is added
    land("a", "z.csv", ["h"], [["33"], ["34"]])
    archive(store, sources, day)
    archive(store, sources, dt.date(2024, 1, 2))
    table = archived_lines(store, "a").filter("file = 'z.csv'")
    assert rows(table.groupBy(F.col("archive_date").cast("string")).count()) == [
        ("2024-01-01", 3), ("2024-01-02", 3)]

    assert rows(arrival_audit(spark, sources)) == [("gone",)]


def test_archive_check_sees_content_and_order(store, land, spark, folder):
    """As many lines as before, but one changed, two exchanged, or a pair of copies for another."""
    text = {"same": "abcaa", "changed": "abc", "order": "abc", "copies": "aabb", "gone": "ab"}
    for name, cells in text.items():
        land("a", f"{name}.csv", ["h"], [[c] for c in cells])
    source, day = {"a": f"{folder}/landing/a"}, dt.date(2024, 1, 1)
    archive(store, source, day)
    for name, cells in {"changed": "abd", "order": "bac", "copies": "ccbb", "gone": "a", "new": "a"}.items():
        land("a", f"{name}.csv", ["h"], [[c] for c in cells])
    got = {r.file.split(".")[0]: r.moved for r in archive_check(store, source, day).collect()}
    assert got == {"same": True, **dict.fromkeys(("changed", "order", "copies", "gone", "new"), False)}


def test_archive_check_over_several_splits(store, land, spark, folder):
    """A file's numbers do not depend on how it was split, when archived or when checked."""
    land("a", "a.csv", ["h"], [[f"line {i % 7} {'x' * (i % 50)}"] for i in range(2000)])
    land("a", "b.csv", ["h"], [["1"]])
    source, day = {"a": f"{folder}/landing/a"}, dt.date(2024, 1, 1)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
        archive(store, source, day)
        assert archived_lines(store, "a", day).select("block_start").distinct().count() > 4
        assert rows(archive_check(store, source, day)) == [("a", "a.csv", True), ("a", "b.csv", True)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows(archive_check(store, source, day)) == [("a", "a.csv", True), ("a", "b.csv", True)]
    folders = spark.read.format("binaryFile").load(store.path("archive", "a")).select("archive_date", "run")
    assert folders.distinct().count() == 1


# --- stream ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("bind", ["name", "position"])
def test_stream_takes_each_file_once(store, land, spark, folder, bind):
    spec = TEAM_RANKINGS if bind == "name" else positional(TEAM_RANKINGS)
    header = TEAM_RANKINGS.landing if bind == "position" else tuple(reversed(TEAM_RANKINGS.landing))
    order = (lambda r: r) if bind == "position" else (lambda r: r[::-1])
    row = lambda n: order([str(n), f"team{n}", "", "", "", "", ""])
    path = land("s", "a [1].csv", header, [row(1), row(2)])

    def run():
        q = ingest_stream(spark, spec, path, store, f"{folder}/ckpt", refresh=True)
        q.awaitTermination(120)
        assert q.exception() is None

    run()
    assert rows(store.bronze(spec), "file_name", "rank", "name") == [
        ("a [1]", "1", "team1"), ("a [1]", "2", "team2")]
    run()
    assert store.bronze(spec).count() == 2
    land("s", "b.csv", header, [row(3)])
    run()
    assert store.bronze(spec).count() == 3
    assert rows(store.silver(spec), "file_name", "rank") == [
        ("a [1]", Decimal(1)), ("a [1]", Decimal(2)), ("b", Decimal(3))]


@pytest.mark.parametrize("bind", ["name", "position"])
def test_stream_archives_taken_files(store, land, spark, folder, bind):
    spec = TEAM_RANKINGS if bind == "name" else positional(TEAM_RANKINGS)
    kept = f"{folder}/kept"
    for n in range(3):
        path = land("s", f"f{n}.csv", TEAM_RANKINGS.landing, [team(str(n), "A")])
        q = ingest_stream(spark, spec, path, store, f"{folder}/ckpt", archive_dir=kept)
        q.awaitTermination(120)
        assert q.exception() is None
    assert store.bronze(spec).count() == 3
    moved = sorted(f for _, _, files in os.walk(kept) for f in files if f.endswith(".csv"))
    assert moved and set(moved) < {"f0.csv", "f1.csv", "f2.csv"}
    assert not set(moved) & set(os.listdir(path))


def test_repeated_stream_batch_replaces_itself(store, spark):
    batch = spark.createDataFrame([("1", "A")], "rank string, name string").withColumn(
        "update_timestamp", F.lit(DAY[0]))
    for _ in range(2):
        store.append_bronze(batch, "t", replay=True)
    assert store.read("bronze", "t").count() == 1


# --- landed batches -------------------------------------------------------------------------------


def test_source_folder_gives_its_batches_and_relanding_replaces(store, spark, folder):
    """The documented path: land, load the source's folder, refresh; then the same day again."""
    landing = f"{folder}/landing/{TEAM_RANKINGS.name}"
    columns = "rank string, name string"

    def land_day(rows, day):
        write_landing(spark.createDataFrame(rows, columns), landing, day, TEAM_RANKINGS.landing)

    land_day([("1", "A"), ("2", "B")], "20240101")
    land_day([("9", "Z")], "20240102")
    load_bronze(store, TEAM_RANKINGS, landing, DAY[0])
    refresh_silver(store, TEAM_RANKINGS)
    land_day([("3", "C")], "20240101")
    load_bronze(store, TEAM_RANKINGS, landing, DAY[1])
    refresh_silver(store, TEAM_RANKINGS)
    assert ranks(store) == [
        ("ranking_teams_20240101", Decimal(3), "C"), ("ranking_teams_20240102", Decimal(9), "Z")]


def test_a_batch_of_many_part_files_is_one_load(store, spark, folder):
    landing = f"{folder}/landing/{TEAM_RANKINGS.name}"
    rows = spark.range(40).selectExpr("cast(id as string) as rank", "'n' as name").repartition(20)
    write_landing(rows, landing, "20240101", TEAM_RANKINGS.landing)
    ingest_stream(spark, TEAM_RANKINGS, landing, store, f"{folder}/stream", refresh=True).awaitTermination()
    assert store.bronze(TEAM_RANKINGS).select("load_id").distinct().count() == 1
    assert store.silver(TEAM_RANKINGS).count() == 40


def test_archive_tells_equal_names_apart(store, land, spark, folder):
    land("a/20240101", "a.csv", ["h"], [["1"]])
    land("a/20240201", "a.csv", ["h"], [["2"], ["3"]])
    source = {"a": f"{folder}/landing/a"}
    archive(store, source, dt.date(2024, 1, 1))
    kept = archived_lines(store, "a").groupBy("file").count()
    assert rows(kept) == [("20240101/a.csv", 2), ("20240201/a.csv", 3)]


def test_several_hundred_layouts_are_one_plan(spark, land):
    for i in range(200):
        path = land("wide", f"f{i}.csv", [f"x{i}", "rank", f"y{i}"][:: 1 if i % 2 else -1], [["a", str(i), "b"][:: 1 if i % 2 else -1]])
    got = scan_csv(spark, path, ("rank", "name"), bind="name")
    assert rows(got) == sorted([(str(i), None) for i in range(200)], key=str)
    assert str(got._jdf.queryExecution().optimizedPlan()).count("CASE") == 0


def test_refresh_of_given_loads_reads_only_them(store, land, spark):
    first = land("teams", "a.csv", TEAM_RANKINGS.landing, [team("1", "A")])
    load_bronze(store, TEAM_RANKINGS, f"{first}/a.csv", DAY[0])
    second = land("more", "b.csv", TEAM_RANKINGS.landing, [team("2", "B")])
    bronze = load_bronze(store, TEAM_RANKINGS, f"{second}/b.csv", DAY[1])
    loads = sorted(r.load_id for r in bronze.select("load_id").distinct().collect())
    refresh_silver(store, TEAM_RANKINGS, loads[1:])
    assert ranks(store) == [("b", Decimal(2), "B")]
    refresh_silver(store, TEAM_RANKINGS, loads[1:])
    refresh_silver(store, TEAM_RANKINGS)
    assert ranks(store) == [("a", Decimal(1), "A"), ("b", Decimal(2), "B")]

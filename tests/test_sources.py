import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tierflow.sources import (
    flatten_gallery_detail,
    flatten_gallery_index,
    flatten_international,
    flatten_player_rankings,
    flatten_players,
    flatten_results,
    flatten_team_rankings,
    gallery_details,
    gallery_photos,
    headers_by_file,
    read_documents,
    scan_csv,
    stage_bronze,
    union_ragged,
    write_landing,
)
from tierflow.sources.csv_landing import first_line
from tierflow.specs import (
    GALLERY,
    MARKET_LANDING,
    PHOTOS,
    PLAYERS,
    SOURCES,
    TEAM_RANKINGS,
    positional,
)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=str)


# --- CSV landing -------------------------------------------------------------


def test_landing_column_counts():
    counts = {s.name: len(s.landing) for s in SOURCES}
    assert counts == {
        "ranking_allrounders": 11, "ranking_batsmen": 11, "ranking_bowlers": 11,
        "ranking_teams": 7, "photo_gallery": 8, "photos": 4, "team_international": 5,
        "team_players": 5, "team_results": 20,
    }
    assert len(MARKET_LANDING) == 6


def test_positional_scan_ignores_header_names(spark, land):
    path = land("p", "a.csv", ["x", "y", "z", "u", "v"], [["n", "bat", "1", "bowl", "9"]])
    got = scan_csv(spark, path, PLAYERS, bind="position")
    assert rows(got) == [("n", "bat", "1", "bowl", "9")]
    assert got.columns == list(PLAYERS.landing)


def test_positional_scan_pads_and_drops_cells(spark, land):
    path = land("p", "a.csv", PLAYERS.landing, [["n", "bat"], ["a", "b", "c", "d", "e", "extra"]])
    assert rows(scan_csv(spark, path, PLAYERS, bind="position")) == [
        ("a", "b", "c", "d", "e"), ("n", "bat", None, None, None),
    ]


def test_python_quoting_is_read(spark, land):
    tricky = ['a "quoted", cell', "x,y", "", "two\nlines"]
    path = land("g", "a.csv", PHOTOS.landing, [tricky])
    for bind in ("position", "name"):
        got = scan_csv(spark, path, PHOTOS, bind=bind).first()
        assert list(got) == ['a "quoted", cell', "x,y", None, "two\nlines"]


def test_quoted_empty_cell_is_null(spark, folder):
    os.makedirs(f"{folder}/q")
    with open(f"{folder}/q/a.csv", "w") as f:
        f.write('name,battingStyle,id,bowlingStyle,imageId\n"",b,1,"",2\n')
    assert rows(scan_csv(spark, f"{folder}/q", PLAYERS, bind="position")) == [
        (None, "b", "1", None, "2")
    ]


def test_scan_by_name_one_layout(spark, land):
    header = ["id", "name", "imageId", "other", "battingStyle"]
    path = land("p", "a.csv", header, [["1", "n", "9", "o", "bat"]])
    assert rows(scan_csv(spark, path, PLAYERS, bind="name")) == [("n", "bat", "1", None, "9")]


def test_scan_by_name_mixed_layouts_and_odd_file_names(spark, land):
    land("p", "a b+c.v2.csv", ["id", "name"], [["1", "one"], ["2", "two"]])
    land("p", "d[1].csv", PLAYERS.landing, [["three", "bat", "3", "bowl", "9"]])
    land("p", "only_header.csv", ["imageId", "id"], [])
    path = land("p", "e.csv", ["NAME", "Id", "extra"], [["four", "4"], ["five", "5", "x", "y"]])
    df = stage_bronze(scan_csv(spark, path, PLAYERS, bind="name", with_path=True))
    assert rows(df, "file_name", "id", "name", "imageId") == [
        ("a b+c", "1", "one", None), ("a b+c", "2", "two", None),
        ("d[1]", "3", "three", "9"),
        ("e", "4", "four", None), ("e", "5", "five", None),
    ]


def test_scan_by_name_exact_case_first(spark, land):
    path = land("p", "a.csv", ["ID", "id"], [["upper", "lower"]])
    assert scan_csv(spark, path, ("id",), bind="name").first().id == "lower"


def test_scan_by_name_splits_large_files(spark, land):
    """Header and rows stay right when one file is read in many splits."""
    many = [[str(i), f"name {i}"] for i in range(20_000)]
    land("p", "big.csv", ["id", "name"], many)
    path = land("p", "other.csv", ["name", "id"], [["x", "-1"]])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = scan_csv(spark, path, PLAYERS, bind="name", multiline=False)
        assert df.rdd.getNumPartitions() > 1
        total = df.agg(F.count("*").alias("n"), F.sum(F.col("id").cast("bigint")).alias("s"))
        assert tuple(total.first()) == (20_001, sum(range(20_000)) - 1)
        bad = df.filter("id <> -1 and name <> concat('name ', id)").count()
        assert bad == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_empty_folder_by_name(spark, folder):
    os.makedirs(f"{folder}/none")
    assert scan_csv(spark, f"{folder}/none", PLAYERS, bind="name").count() == 0


def test_photo_header_order_needs_binding_by_name(spark, land):
    emitted = [
        "gallery_id", "gallery_headline", "gallery_intro", "gallery_published_time",
        "gallery_state", "caption", "imageId", "imageHash",
    ]
    path = land("g", "gallery_details_20240101_010203.csv", emitted,
                [["7", "head", "intro", "1700", "active", "cap", "55", "h"]])
    by_name = scan_csv(spark, path, GALLERY).first()
    assert (by_name.gallery_id, by_name.caption, by_name.imageId) == ("7", "cap", "55")
    by_position = scan_csv(spark, path, positional(GALLERY)).first()
    assert (by_position.caption, by_position.imageId) == ("7", "intro")


def test_lineage_columns(spark, land):
    land("t", "rank_20240101.csv", TEAM_RANKINGS.landing, [["1", "A"]])
    path = land("t", "rank x.y.csv", TEAM_RANKINGS.landing, [["2", "B"], ["3", "C"]])
    df = stage_bronze(scan_csv(spark, path, TEAM_RANKINGS, bind="position", with_path=True))
    assert df.columns == [*TEAM_RANKINGS.landing, "file_name", "update_timestamp"]
    assert rows(df, "rank", "file_name") == [
        ("1", "rank_20240101"), ("2", "rank x"), ("3", "rank x"),
    ]
    assert df.select("update_timestamp").distinct().count() == 1


def test_csv_round_trip(spark, folder):
    cells = [("  pad  ", 'say "hi", ok', None, "", "12"), (None, "b", "c", "d", "e")]
    df = spark.createDataFrame(cells, "name string, battingStyle string, id string, bowlingStyle string, imageId string")
    target = write_landing(df, f"{folder}/players", "20240101")
    assert target == f"{folder}/players/20240101"
    back = scan_csv(spark, target, PLAYERS, bind="position")
    assert rows(back) == sorted(
        [("  pad  ", 'say "hi", ok', None, None, "12"), (None, "b", "c", "d", "e")], key=str
    )
    raw = spark.read.text(target).filter("value not like 'name%'")
    assert '  pad  ,"say ""hi"", ok",,,12' in [r.value for r in raw.collect()]


def test_empty_batch_is_not_written(spark, folder):
    assert write_landing(spark.createDataFrame([], "a string"), f"{folder}/x", "20240101") is None
    assert not os.path.exists(f"{folder}/x")


# --- JSON responses ------------------------------------------------------------


def docs(spark, *values):
    return spark.createDataFrame(
        [(v if isinstance(v, str) else json.dumps(v),) for v in values], "value string"
    )


def test_player_rankings(spark):
    raw = docs(
        spark,
        {"rank": [
            {"rank": "1", "id": 9, "name": "A", "points": 19.4, "difference": 3},
            {"rank": "2", "difference": None},
            {"rank": "3"},
            "no object",
        ]},
        {"other": []},
        {"rank": []},
        "broken {",
    )
    got = flatten_player_rankings(raw)
    assert got.columns == list(SOURCES[5].landing)
    assert rows(got, "rank", "id", "name", "points", "difference", "faceImageId") == sorted(
        [("1", "9", "A", "19.4", "3", None), ("2", None, None, None, None, None),
         ("3", None, None, None, "", None)], key=str)


def test_team_rankings_and_international(spark):
    got = flatten_team_rankings(docs(spark, {"rank": [{"rank": 1, "name": "T", "id": 5}]}))
    assert got.columns == list(TEAM_RANKINGS.landing)
    assert rows(got, "rank", "name", "difference") == [("1", "T", "")]
    teams = flatten_international(
        docs(spark, {"list": [{"teamId": 2, "teamName": "X"}, {"teamSName": "AUS"}]}, {})
    )
    assert rows(teams, "teamId", "teamName", "teamSName") == [("2", "X", None), (None, None, "AUS")]


@pytest.mark.parametrize(
    "doc,ids",
    [
        ({"player": [{"id": 1}], "list": [{"id": 2}]}, ["1"]),
        ({"list": [{"id": 2}], "players": [{"id": 3}]}, ["3"]),
        ({"z": [{"id": 8}], "list": [{"id": 2}]}, ["2"]),
        ({"other": 1, "text": "[x", "squad": [{"id": 4}, 5, "{", None], "late": [{"id": 6}]}, ["4"]),
        ([{"id": 7}, [1], "x"], ["7"]),
        ({"player": None, "squad": [{"id": 4}]}, []),
        ({"player": [], "squad": [{"id": 4}]}, []),
        ({"a": 1}, []),
        ("7", []),
    ],
)
def test_players_shape_fallback(spark, doc, ids):
    assert [r.id for r in flatten_players(docs(spark, doc)).collect()] == ids


def test_results(spark):
    doc = {"teamMatchesData": [
        {"matchDetailsMap": {"key": "Series", "match": [
            {"matchInfo": {"matchId": 1, "status": "won", "team1": {"teamName": "A", "teamSName": "a"},
                           "venueInfo": {"city": "C"}, "startDate": "170"},
             "matchScore": {"team1Score": {"inngs1": {"runs": 200, "overs": 19.4}}}},
            {"matchInfo": {"matchId": 2}},
        ]}},
        {"matchDetailsMap": {"match": [{"matchInfo": {"matchId": 3}}]}},
        {"matchDetailsMap": {"key": "none"}},
        {"adDetail": {"name": "x"}},
    ]}
    got = flatten_results(docs(spark, doc))
    assert got.columns == list(SOURCES[2].landing)
    assert rows(got, "series_name", "match_id", "match_status", "team1_short", "venue_city",
                "team1_runs", "team1_overs", "team2_runs") == sorted([
        ("Series", "1", "won", "a", "C", "200", "19.4", None),
        ("Series", "2", None, None, None, None, None, None),
        ("", "3", None, None, None, None, None, None)], key=str)


def test_gallery_index_drops_falsy_ids(spark):
    doc = {"photoGalleryInfoList": [
        {"photoGalleryInfo": {"galleryId": g}} for g in (11, 0, "", "0", None, "x", False, 0.0)
    ] + [{"photoGalleryInfo": {}}, {"ad": 1}]}
    assert rows(flatten_gallery_index(docs(spark, doc))) == [("0",), ("11",), ("x",)]


def test_gallery_detail(spark, folder):
    detail = {
        "1": {"headline": "H", "intro": "I", "state": None, "photoGalleryDetails": [
            {"caption": "c1", "imageId": 5, "imageHash": "h"},
            {"caption": "c2", "gallery_intro": "own", "gallery_id": None},
            "not an object",
        ]},
        "2": {"headline": "H2"},
        "3": {"photoGalleryDetails": [{"caption": "unlisted"}]},
    }
    os.makedirs(f"{folder}/detail")
    for gid, doc in detail.items():
        with open(f"{folder}/detail/{gid}.json", "w") as f:
            json.dump(doc, f, indent=1)
    frame = read_documents(spark, f"{folder}/detail").withColumnRenamed("file_name", "gallery_id")
    index = docs(spark, {"photoGalleryInfoList": [
        {"photoGalleryInfo": {"galleryId": g}} for g in (1, 2, 9)]})
    listed = gallery_details(flatten_gallery_index(index), frame)
    assert rows(listed, "gallery_id") == [("1",), ("2",)]
    got = flatten_gallery_detail(listed)
    assert rows(got, "gallery_id", "gallery_intro", "gallery_published_time", "gallery_state",
                "caption", "imageId", "imageHash") == sorted([
        ("1", "I", "", None, "c1", "5", "h"),
        (None, "own", "", None, "c2", None, None),
        ("1", "I", "", None, None, None, None)], key=str)
    assert set(gallery_photos(index, frame).columns) == set(GALLERY.landing)


def test_headers_are_read_from_the_beginning_of_files(spark, folder):
    """300 layouts: one scan of the rows, and of each file no more than its first bytes."""
    rng = random.Random(5)
    os.makedirs(f"{folder}/in")
    for n in range(300):
        names = list(TEAM_RANKINGS.landing) + [f"extra{n}"]
        rng.shuffle(names)
        with open(f"{folder}/in/f {n}+.csv", "w") as f:
            f.write("\n" * (n % 2) + ",".join(names) + "\n" + ",".join(f"{c}{n}" for c in names) + "\n")
    got = scan_csv(spark, f"{folder}/in", TEAM_RANKINGS, header_index=f"{folder}/index")
    assert sorted(r.rank for r in got.collect()) == sorted(f"rank{n}" for n in range(300))
    assert all(set(r.asDict().values()) == {f"{c}{r.rank[4:]}" for c in TEAM_RANKINGS.landing} for r in got.collect())
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan csv") == 1 and "FileScan text" not in plan
    # A file known by path, size and time is not opened again; a changed one is.
    index = spark.read.parquet(f"{folder}/index")
    assert index.count() == 300
    with open(f"{folder}/in/f 7+.csv", "w") as f:
        f.write("name,rank\nnew,first\n")
    again = scan_csv(spark, f"{folder}/in", TEAM_RANKINGS, header_index=f"{folder}/index")
    assert again.filter("rank = 'first' and name = 'new'").count() == 1
    assert spark.read.parquet(f"{folder}/index").count() == 301


def test_first_line(folder):
    for n, (content, want) in enumerate([
        (b"", None), (b"\n \r\n", None), (b"a,b", "a,b"), (b"\r\na,b\rc", "a,b"), (b"x" * 500 + b"\nrow\n", "x" * 500),
        ("é,ü\n".encode(), "é,ü"),
    ]):
        path = f"{folder}/{n}.csv"
        with open(path, "wb") as f:
            f.write(content)
        for step in (1, 7, 64_000):
            assert first_line(f"file:{path}", step) == want
    with gzip.open(f"{folder}/z.csv.gz", "wt") as f:
        f.write("h1,h2\n1,2\n")
    assert first_line(f"file:{folder}/z.csv.gz") == "h1,h2"


def test_number_text_is_as_the_extractor_writes_it(spark):
    cells = ["5.0", "1000.0", "1e3", "12", "true", "false", "0.00001", "1.50", "12345678901234567890", "1E16", "-7.10", '"5"', '"true"']
    ranks = ", ".join(f'{{"rank": {i}, "rating": {cell}}}' for i, cell in enumerate(cells))
    raw = spark.createDataFrame([(f'{{"rank": [{ranks}]}}',)], "value string")
    got = {int(r["rank"]): r.rating for r in flatten_player_rankings(raw).collect()}
    assert got == {i: str(json.loads(cell)) for i, cell in enumerate(cells)}


def test_photos_keep_all_their_keys_in_first_seen_order(spark, folder):
    detail = {
        "8": {"headline": "H8", "photoGalleryDetails": [{"zeta": 1, "caption": "c"}, {"Caption": "other case", "alpha": True}]},
        "5": {"headline": "H5", "photoGalleryDetails": [{"imageId": 2.0, "zeta": None, "beta": [1]}, 7, {}]},
    }
    frame = spark.createDataFrame([(k, json.dumps(v)) for k, v in detail.items()], "gallery_id string, value string")
    index = docs(spark, {"photoGalleryInfoList": [{"photoGalleryInfo": {"galleryId": g}} for g in (8, 5)]})
    got = gallery_photos(index, frame)
    assert got.columns[5:] == ["zeta", "caption", "alpha", "imageId", "beta"]
    assert rows(got, "gallery_id", *got.columns[5:]) == sorted([
        ("8", "1", "c", None, None, None), ("8", None, "other case", "True", None, None),
        ("5", None, None, None, "2.0", "[1]"), ("5",) + (None,) * 5, ("5",) + (None,) * 5], key=str)
    write_landing(got, f"{folder}/gallery", "20240101_000000")
    header = headers_by_file(spark, f"{folder}/gallery").first().header
    assert header.split(",")[-5:] == ["zeta", "caption", "alpha", "imageId", "beta"]
    assert len(gallery_photos(index, frame.filter("false")).columns) == 5


def test_union_ragged_keeps_first_seen_order(spark):
    a = spark.createDataFrame([(1, 2)], "b int, a int")
    b = spark.createDataFrame([(3, 4)], "c int, a int")
    got = union_ragged([a, b])
    assert got.columns == ["b", "a", "c"]
    assert rows(got) == sorted([(1, 2, None), (None, 4, 3)], key=str)

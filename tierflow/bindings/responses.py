"""API responses built row by row from the tables, then flattened again.

Each table row becomes one JSON document, so the number of documents grows with
the data and no document gathers rows of others.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.bindings.tables import table
from tierflow.sources import (
    flatten_gallery_index,
    flatten_international,
    flatten_player_rankings,
    flatten_players,
    flatten_results,
    flatten_team_rankings,
    gallery_details,
    gallery_photos,
)


def _doc(**fields):
    """One JSON document; NULL fields are left out, so their keys are absent."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()])).alias("value")


def _obj(**fields):
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(k) for k, c in fields.items()])


def player_rankings(spark, sf_dir):
    """Two entries per customer; the second, and overdrawn ones, lack ``difference``.

    ``points`` are numbers with a point and ``trend`` is a truth value.
    """
    c = table(spark, sf_dir, "customer")

    def entry(rank, difference):
        return _obj(
            rank=rank, id="c_custkey", name="c_name", country="c_mktsegment", countryId="c_nationkey",
            rating="c_acctbal", points=F.col("c_custkey").cast("double") * 2, difference=difference,
            trend=F.col("c_acctbal") >= 0, lastUpdatedOn=F.lit("2024-01-01"), faceImageId=F.lit(None).cast("int"),
        )

    owing = F.when(F.col("c_acctbal") >= 0, F.lit(5))
    raw = c.select(_doc(rank=F.array(entry(F.lit(1), owing), entry(F.lit(2), F.lit(None).cast("int")))))
    return flatten_player_rankings(raw)


def team_rankings(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    raw = s.select(
        _doc(rank=F.array(_obj(
            rank="s_suppkey", name="s_name", rating="s_acctbal", points="s_nationkey",
            difference=F.when(F.col("s_acctbal") < 0, F.lit("down")), trend=F.lit("Up"),
            lastUpdatedOn=F.lit("2024-01-01"), id="s_suppkey",
        )))
    )
    return flatten_team_rankings(raw)


def international(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    raw = s.select(
        _doc(list=F.array(
            _obj(teamId="s_suppkey", imageId="s_nationkey", countryName=F.lit(None).cast("string"),
                 teamSName=F.concat(F.lit("T"), F.col("s_nationkey")), teamName="s_name")
        ), other=F.lit(1))
    )
    return flatten_international(raw)


def players_fallback(spark, sf_dir):
    """The list's place in the document depends on the customer's segment."""
    c = table(spark, sf_dir, "customer")
    squad = F.array(
        _obj(name="c_name", battingStyle="c_mktsegment", id="c_custkey",
             bowlingStyle=F.when(F.col("c_acctbal") > 0, F.lit("fast")), imageId="c_nationkey")
    )
    other = F.array(_obj(name=F.lit("wrong list"), id=F.lit(-1)))
    segment = F.col("c_mktsegment")
    raw = c.select(
        F.when(segment == "AUTOMOBILE", _doc(zzz=other, list=other, players=other, player=squad))
        .when(segment == "BUILDING", _doc(aaa=other, list=other, players=squad))
        .when(segment == "FURNITURE", _doc(aaa=other, list=squad))
        .when(segment == "MACHINERY", _doc(z=F.lit("[not a list"), squad=squad, a=other))
        .otherwise(F.to_json(squad))
        .alias("value")
    )
    return flatten_players(raw)


def results(spark, sf_dir):
    """One series per order, with one match and one advert; open orders have no score."""
    o = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    score = F.when(
        status != "O",
        _obj(team1Score=_obj(inngs1=_obj(runs="o_custkey", wickets=F.lit(7), overs=F.lit(19.4)))),
    )
    match = _obj(
        matchInfo=_obj(
            matchId="o_orderkey", matchDesc="o_orderpriority", matchFormat=F.lit("T20"),
            status="o_orderstatus", team1=_obj(teamName=F.lit("A"), teamSName=F.lit("a")),
            venueInfo=F.when(status == "F", _obj(ground=F.lit("G"), city=F.lit("C"))),
            startDate=F.lit("170"),
        ),
        matchScore=score,
    )
    series = _obj(key=F.when(status != "P", F.col("o_orderpriority")), match=F.array(match))
    advert = F.lit(None).cast("string")
    items = F.array(
        _obj(matchDetailsMap=series, adDetail=advert),
        _obj(matchDetailsMap=F.when(F.lit(False), series), adDetail=F.lit("advert")),
    )
    return flatten_results(o.select(_doc(teamMatchesData=items)))


def _index(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        _doc(photoGalleryInfoList=F.array(_obj(photoGalleryInfo=_obj(galleryId="page_id"))))
    )


def _details(spark, sf_dir):
    """Only pages served over https answered.  Photos have keys that no table declares."""
    pages = table(spark, sf_dir, "pages").filter(F.col("url").startswith("https:"))
    nothing = F.lit(None).cast("string")
    photos = F.array(
        _obj(caption="url", imageId="page_id", imageHash=F.md5("html"), gallery_intro=nothing,
             width=F.length("html").cast("double"), credit=nothing),
        _obj(caption=nothing, imageId="page_id", imageHash=nothing, gallery_intro=F.lit("own intro"),
             width=F.lit(None).cast("double"), credit=F.when(F.col("page_id") % 2 == 0, F.col("url"))),
    )
    return pages.select(
        F.col("page_id").cast("string").alias("gallery_id"),
        _doc(headline=F.split_part("url", F.lit("/"), F.lit(3)), intro=F.lit("intro"),
             photoGalleryDetails=photos),
    )


def gallery_index(spark, sf_dir):
    return flatten_gallery_index(_index(spark, sf_dir))


def index_detail_join(spark, sf_dir):
    listed = gallery_details(gallery_index(spark, sf_dir), _details(spark, sf_dir))
    return listed.select(
        "gallery_id",
        F.get_json_object("value", "$.headline").alias("headline"),
        F.get_json_object("value", "$.photoGalleryDetails[0].imageHash").alias("first_hash"),
    )


def gallery_detail(spark, sf_dir):
    return gallery_photos(_index(spark, sf_dir), _details(spark, sf_dir))


QUERIES = {
    "flatten_player_rankings": player_rankings,
    "flatten_team_rankings": team_rankings,
    "flatten_international": international,
    "players_fallback": players_fallback,
    "flatten_results": results,
    "gallery_index": gallery_index,
    "index_detail_join": index_detail_join,
    "gallery_detail": gallery_detail,
}

ORACLES = {
    "flatten_player_rankings": """
        SELECT r AS rank, cast(c_custkey AS varchar) AS id, c_name AS name, c_mktsegment AS country,
               cast(c_nationkey AS varchar) AS "countryId",
               cast(c_acctbal AS varchar) AS rating,
               cast(c_custkey::double * 2 AS varchar) AS points,
               CASE WHEN r = '1' AND c_acctbal >= 0 THEN '5' ELSE '' END AS difference,
               CASE WHEN c_acctbal >= 0 THEN 'True' ELSE 'False' END AS trend, '2024-01-01' AS "lastUpdatedOn",
               cast(NULL AS varchar) AS "faceImageId"
        FROM customer, (VALUES ('1'), ('2')) AS ranks(r)""",
    "flatten_team_rankings": """
        SELECT cast(s_suppkey AS varchar) AS rank, s_name AS name,
               cast(s_acctbal AS varchar) AS rating,
               cast(s_nationkey AS varchar) AS points,
               CASE WHEN s_acctbal < 0 THEN 'down' ELSE '' END AS difference,
               'Up' AS trend, '2024-01-01' AS "lastUpdatedOn"
        FROM supplier""",
    "flatten_international": """
        SELECT cast(s_suppkey AS varchar) AS "teamId", cast(s_nationkey AS varchar) AS "imageId",
               cast(NULL AS varchar) AS "countryName", 'T' || s_nationkey AS "teamSName",
               s_name AS "teamName"
        FROM supplier""",
    "players_fallback": """
        SELECT c_name AS name, c_mktsegment AS "battingStyle", cast(c_custkey AS varchar) AS id,
               CASE WHEN c_acctbal > 0 THEN 'fast' END AS "bowlingStyle",
               cast(c_nationkey AS varchar) AS "imageId"
        FROM customer""",
    "flatten_results": """
        SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE '' END AS series_name,
               cast(o_orderkey AS varchar) AS match_id, o_orderpriority AS match_desc,
               'T20' AS match_format, o_orderstatus AS match_status, cast(NULL AS varchar) AS state,
               'A' AS team1_name, 'a' AS team1_short, cast(NULL AS varchar) AS team2_name,
               cast(NULL AS varchar) AS team2_short,
               CASE WHEN o_orderstatus = 'F' THEN 'G' END AS venue_ground,
               CASE WHEN o_orderstatus = 'F' THEN 'C' END AS venue_city,
               '170' AS start_date, cast(NULL AS varchar) AS end_date,
               CASE WHEN o_orderstatus <> 'O' THEN cast(o_custkey AS varchar) END AS team1_runs,
               CASE WHEN o_orderstatus <> 'O' THEN '7' END AS team1_wickets,
               CASE WHEN o_orderstatus <> 'O' THEN '19.4' END AS team1_overs,
               cast(NULL AS varchar) AS team2_runs, cast(NULL AS varchar) AS team2_wickets,
               cast(NULL AS varchar) AS team2_overs
        FROM orders""",
    "gallery_index": "SELECT cast(page_id AS varchar) AS gallery_id FROM pages WHERE page_id <> 0",
    "index_detail_join": """
        SELECT cast(page_id AS varchar) AS gallery_id, split_part(url, '/', 3) AS headline, md5(html) AS first_hash
        FROM pages
        WHERE page_id <> 0 AND starts_with(url, 'https:')""",
    "gallery_detail": """
        SELECT cast(page_id AS varchar) AS gallery_id, split_part(url, '/', 3) AS gallery_headline,
               CASE WHEN photo = 1 THEN 'intro' ELSE 'own intro' END AS gallery_intro,
               '' AS gallery_published_time, '' AS gallery_state,
               CASE WHEN photo = 1 THEN url END AS caption, cast(page_id AS varchar) AS "imageId",
               CASE WHEN photo = 1 THEN md5(html) END AS "imageHash",
               CASE WHEN photo = 1 THEN cast(length(html)::double AS varchar) END AS width,
               CASE WHEN photo = 2 AND page_id % 2 = 0 THEN url END AS credit
        FROM pages, (VALUES (1), (2)) AS photos(photo)
        WHERE page_id <> 0 AND starts_with(url, 'https:')""",
}

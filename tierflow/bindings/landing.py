"""Files and layer tables: write whole derived tables, then read them back.

Every run works in a new folder under the shared one.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tierflow.bindings import responses
from tierflow.bindings.gold import ORACLES as GOLD_ORACLES, _leaves
from tierflow.bindings.tables import (
    FIRST_LOAD,
    MARKET_SQL,
    SECOND_LOAD,
    bronze_frame,
    landing_frame,
    landing_sql,
    market_frame,
    plain_number,
    silver_sql,
    table,
)
from tierflow.functions import numeric_text
from tierflow.operators import load_tally, to_silver
from tierflow.plans import (
    archive,
    archive_check,
    archived_lines,
    build_gold,
    each_source,
    load_bronze,
    refresh_silver,
)
from tierflow.session import shared_dir
from tierflow.sources import TableStore, scan_csv, write_landing
from tierflow.sources.csv_landing import file_system
from tierflow.specs import (
    BATSMEN,
    LOAD_TS,
    MARKET_LANDING,
    PHOTOS,
    RESULTS,
    SOURCES,
)
from tierflow.streaming import ingest_stream, ingest_versions


def _run_dir(spark) -> str:
    return f"{shared_dir(spark)}/runs/{uuid.uuid4().hex}"


def csv_by_position(spark, sf_dir):
    batch = write_landing(landing_frame(spark, sf_dir, BATSMEN.name), _run_dir(spark), "20240101")
    return scan_csv(spark, batch, BATSMEN, bind="position")


def csv_by_name(spark, sf_dir):
    """Two batches: columns reversed for one, some missing and one unknown in the other."""
    folder = _run_dir(spark)
    rows = landing_frame(spark, sf_dir, BATSMEN.name)
    in_credit = F.col("rating").cast("double") >= 0
    write_landing(rows.filter(in_credit).select(*reversed(BATSMEN.landing)), folder, "20240101")
    other = rows.filter(~in_credit).drop("trend", "points").withColumn("unknown", F.lit("x"))
    write_landing(other, folder, "20240201")
    return scan_csv(spark, f"{folder}/*", BATSMEN, bind="name")


def csv_free_text(spark, sf_dir):
    """Whole documents as quoted cells with quotes, commas and newlines."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("text").alias("caption"), F.col("lang").alias("gallery_intro"),
        F.col("source").alias("gallery_published_time"), F.col("doc_id").cast("string").alias("imageId"),
    )
    batch = write_landing(docs, _run_dir(spark), "20240101_000000")
    return scan_csv(spark, batch, PHOTOS).select(
        "imageId", "gallery_intro", "gallery_published_time", F.md5("caption").alias("text_md5")
    )


def market_scan(spark, sf_dir):
    batch = write_landing(market_frame(spark, sf_dir), _run_dir(spark), "20240101")
    return scan_csv(spark, batch, MARKET_LANDING)


def bronze_load(spark, sf_dir):
    """The same landing folder loaded twice: every row, every run."""
    store = TableStore(spark, _run_dir(spark))
    landing = f"{store.root}/landing/{BATSMEN.name}"
    write_landing(landing_frame(spark, sf_dir, BATSMEN.name), landing, "20240101")
    for load in (FIRST_LOAD, SECOND_LOAD):
        bronze = load_bronze(store, BATSMEN, landing, F.lit(load).cast("timestamp"))
    return bronze.select(
        *BATSMEN.landing, "file_name", F.col(LOAD_TS).cast("string").alias(LOAD_TS)
    )


def _landed_again(spark, sf_dir, landing):
    """The day's batch as a second extraction wrote it: the rows in credit, another rating."""
    rows = landing_frame(spark, sf_dir, BATSMEN.name).filter("cast(rating as double) >= 0")
    write_landing(rows.withColumn("rating", F.lit("1000.50")), landing, "20240101", BATSMEN.landing)


def reland_batch(spark, sf_dir):
    """Two days landed, loaded and refreshed; the first day landed again, loaded, refreshed."""
    store = TableStore(spark, _run_dir(spark))
    landing = f"{store.root}/landing/{BATSMEN.name}"
    rows = landing_frame(spark, sf_dir, BATSMEN.name)
    write_landing(rows, landing, "20240101", BATSMEN.landing)
    write_landing(rows.filter("cast(rating as double) < 0"), landing, "20240102", BATSMEN.landing)
    load_bronze(store, BATSMEN, landing, F.lit(FIRST_LOAD).cast("timestamp"))
    refresh_silver(store, BATSMEN)
    _landed_again(spark, sf_dir, landing)
    load_bronze(store, BATSMEN, landing, F.lit(SECOND_LOAD).cast("timestamp"))
    return _silver_text(refresh_silver(store, BATSMEN))


def stream_reland(spark, sf_dir):
    """A batch taken in by the stream, landed again and taken again."""
    store = TableStore(spark, _run_dir(spark))
    landing = f"{store.root}/landing/{BATSMEN.name}"
    write_landing(landing_frame(spark, sf_dir, BATSMEN.name), landing, "20240101", BATSMEN.landing)
    for again in (False, True):
        if again:
            _landed_again(spark, sf_dir, landing)
        query = ingest_stream(spark, BATSMEN, landing, store, f"{store.root}/stream", refresh=True)
        query.awaitTermination()
    return _silver_text(store.silver(BATSMEN)).drop(LOAD_TS)


def _foreign_files(rows, folder):
    """Write ``rows`` as another system does: a CSV file of a fixed name for each ``file``."""

    def write(frame):
        where, name = file_system(f"{folder}/{frame['file'].iloc[0]}.csv")
        where.create_dir(name.rpartition("/")[0], recursive=True)
        with where.open_output_stream(name) as out:
            out.write(frame.drop(columns="file").to_csv(index=False).encode())
        return frame[["file"]].head(1)

    rows.groupBy("file").applyInPandas(write, "file string").write.format("noop").mode("overwrite").save()


def stream_versions(spark, sf_dir):
    """Files of a thousand ids each; those of even number rewritten under their paths.

    Three runs: all files, the rewritten ones, none.  The rows are Bronze, so a version taken
    twice or not at all shows.
    """
    store = TableStore(spark, _run_dir(spark))
    landing = f"{store.root}/landing"
    number = F.expr("cast(id as bigint) div 1000")
    rows = landing_frame(spark, sf_dir, BATSMEN.name).withColumn("file", F.concat(F.lit("players_"), number))
    _foreign_files(rows, landing)
    loads = [dt.datetime.fromisoformat(x) for x in (FIRST_LOAD, SECOND_LOAD, "2024-03-01 03:30:00")]
    ingest_versions(spark, BATSMEN, landing, store, loads[0])
    again = rows.filter((number % 2 == 0) & (F.col("rating").cast("double") >= 0))
    _foreign_files(again.withColumn("rating", F.lit("1000.50")), landing)
    for load in loads[1:]:
        ingest_versions(spark, BATSMEN, landing, store, load)
    return store.bronze(BATSMEN).select(
        *BATSMEN.landing, "file_name", F.col(LOAD_TS).cast("string").alias(LOAD_TS)
    )


def _second_load(spark, sf_dir):
    """Files landed again, with the rows in credit only and another rating."""
    rows = bronze_frame(spark, sf_dir, BATSMEN.name, SECOND_LOAD)
    return rows.filter("cast(rating as double) >= 0").withColumn("rating", F.lit("1000.50"))


def silver_refresh(spark, sf_dir):
    store = TableStore(spark, _run_dir(spark))
    for rows in (bronze_frame(spark, sf_dir, BATSMEN.name), _second_load(spark, sf_dir)):
        store.append_bronze(rows, BATSMEN.name)
        silver = refresh_silver(store, BATSMEN)
    return _silver_text(silver)


def _silver_text(silver):
    return silver.select(
        *[(numeric_text(c) if c in BATSMEN.numeric else F.col(c)).alias(c) for c in BATSMEN.columns],
        "file_name",
        F.col(LOAD_TS).cast("string").alias(LOAD_TS),
    )


def latest_batch_manifest(spark, sf_dir):
    """Two loads, of which each file's newest is read in its partition alone."""
    store = TableStore(spark, _run_dir(spark))
    for rows in (bronze_frame(spark, sf_dir, BATSMEN.name), _second_load(spark, sf_dir)):
        store.append_bronze(rows, BATSMEN.name)
    return store.latest(BATSMEN).select(
        *BATSMEN.landing, "file_name", F.col(LOAD_TS).cast("string").alias(LOAD_TS)
    )


def all_layers(spark, sf_dir):
    """Nine sources through Bronze, Silver and Gold tables; the master table leaf by leaf."""
    store = TableStore(spark, _run_dir(spark))

    def load(spec):
        store.append_bronze(bronze_frame(spark, sf_dir, spec.name), spec.name)
        refresh_silver(store, spec)

    each_source(load, SOURCES)
    market = write_landing(market_frame(spark, sf_dir), f"{store.root}/market", "20240101")
    return _leaves(build_gold(store, market))


def truncated_tables(spark, sf_dir):
    store = TableStore(spark, _run_dir(spark))
    store.append_bronze(bronze_frame(spark, sf_dir, BATSMEN.name), BATSMEN.name)
    refresh_silver(store, BATSMEN)
    store.rebuild(store.silver(BATSMEN), BATSMEN.name)
    layers = {
        "bronze": lambda: store.bronze(BATSMEN),
        "silver": lambda: store.silver(BATSMEN),
        "gold": lambda: store.gold(BATSMEN.name),
    }

    def counts(when):
        frames = [
            read().agg(F.count("*").alias("n")).select(F.lit(layer).alias("layer"), F.lit(when).alias("stage"), "n")
            for layer, read in layers.items()
        ]
        return frames[0].union(frames[1]).union(frames[2])

    before = spark.createDataFrame(counts("before").collect(), "layer string, stage string, n bigint")
    store.truncate([(layer, BATSMEN.name) for layer in layers])
    return before.union(counts("after"))


def archived_batches(spark, sf_dir):
    """Two days of a source and one of another archived, a third source not landed.

    Every archived line of both days is compared.  The tally counts batches: one moves if
    the archive has all its files line for line.  A batch landed after the archiving has not.
    """
    store = TableStore(spark, _run_dir(spark))
    names = ("ranking_allrounders", "ranking_batsmen", "ranking_bowlers")
    sources = {n: f"{store.root}/landing/{n}" for n in names}
    whole = {n: landing_frame(spark, sf_dir, n) for n in names[:2]}
    for name, batch, rows in (
        (names[0], "20240101", whole[names[0]]),
        (names[0], "20240102", whole[names[0]].withColumn("rating", F.lit("1000.5"))),
        (names[1], "20240101", whole[names[1]].filter("cast(rating as double) >= 0")),
    ):
        write_landing(rows, sources[name], batch)
    day = dt.date(2024, 1, 1)
    archive(store, sources, day)
    write_landing(whole[names[1]], sources[names[1]], "20240103")
    batch = F.split_part("file", F.lit("/"), F.lit(1)).alias("batch")
    unknown = F.lit(None).cast("long")
    lines = [
        archived_lines(store, n, day)
        .filter(~F.col("line").startswith("rank,id,name,"))
        .select(F.lit(n).alias("source"), batch, "line", unknown.alias("moved"), unknown.alias("failed"))
        for n in names[:2]
    ]
    batches = archive_check(store, sources, day).groupBy("source", batch).agg(F.bool_and("moved").alias("moved"))
    tally = load_tally(batches, "source", F.col("moved")).filter("not is_total")
    nothing = F.lit(None).cast("string")
    counted = tally.select("source", nothing.alias("batch"), nothing.alias("line"), "moved", "failed")
    return lines[0].unionByName(lines[1]).unionByName(counted)


def stream_ingest(spark, sf_dir):
    """A landing folder taken in by a stream, twice: each file is loaded once."""
    store = TableStore(spark, _run_dir(spark))
    landing = f"{store.root}/landing"
    write_landing(landing_frame(spark, sf_dir, BATSMEN.name), landing, "20240101")
    for _ in range(2):
        query = ingest_stream(spark, BATSMEN, landing, store, f"{store.root}/stream", refresh=True)
        query.awaitTermination()
    silver = store.silver(BATSMEN)
    return silver.select(
        *[(numeric_text(c) if c in BATSMEN.numeric else F.col(c)).alias(c) for c in BATSMEN.columns]
    )


def responses_to_silver(spark, sf_dir):
    """Match results from response documents through a landing batch to typed rows."""
    batch = write_landing(responses.results(spark, sf_dir), _run_dir(spark), "20240101")
    typed = to_silver(scan_csv(spark, batch, RESULTS), RESULTS)
    return typed.select(
        *[(numeric_text(c) if c in RESULTS.numeric else F.col(c)).alias(c) for c in RESULTS.columns]
    )


QUERIES = {
    "csv_by_position": csv_by_position,
    "csv_by_name": csv_by_name,
    "csv_free_text": csv_free_text,
    "market_scan": market_scan,
    "bronze_load": bronze_load,
    "reland_batch": reland_batch,
    "stream_reland": stream_reland,
    "stream_versions": stream_versions,
    "silver_refresh": silver_refresh,
    "latest_batch_manifest": latest_batch_manifest,
    "all_layers": all_layers,
    "truncated_tables": truncated_tables,
    "archived_batches": archived_batches,
    "stream_ingest": stream_ingest,
    "responses_to_silver": responses_to_silver,
}

_CELLS = ", ".join(f"nullif(\"{c}\", '') AS \"{c}\"" for c in BATSMEN.landing)
_SILVER = ", ".join(
    f"{plain_number(c)} AS {c}" if c in BATSMEN.numeric else f"{c} AS {c}" for c in BATSMEN.columns
)
_REFRESHED = ", ".join(
    "'1000.5' AS rating"
    if c == "rating"
    else (f"{plain_number(c)} AS {c}" if c in BATSMEN.numeric else f"{c} AS {c}")
    for c in BATSMEN.columns
)


def _csv_line() -> str:
    """SQL text of a landed row as its CSV line; cells with commas or quotes are quoted."""
    cells = [
        f"""CASE WHEN regexp_matches("{c}", '[",\\n]') THEN '"' || replace("{c}", '"', '""') || '"' """
        f"""ELSE coalesce("{c}", '') END"""
        for c in BATSMEN.landing
    ]
    return " || ',' || ".join(cells)


ORACLES = {
    "csv_by_position": f"SELECT {_CELLS} FROM ({landing_sql(BATSMEN.name)})",
    "csv_by_name": f"""
        SELECT * REPLACE (CASE WHEN rating::double >= 0 THEN trend END AS trend,
                          CASE WHEN rating::double >= 0 THEN points END AS points)
        FROM (SELECT {_CELLS} FROM ({landing_sql(BATSMEN.name)}))""",
    "csv_free_text": """
        SELECT cast(doc_id AS varchar) AS "imageId", lang AS gallery_intro,
               source AS gallery_published_time, md5(text) AS text_md5 FROM documents""",
    "market_scan": MARKET_SQL,
    "bronze_load": f"""
        SELECT {_CELLS}, 'ranking_batsmen_20240101' AS file_name, load AS update_timestamp
        FROM ({landing_sql(BATSMEN.name)}), (VALUES ('{FIRST_LOAD}'), ('{SECOND_LOAD}')) AS loads(load)""",
    "reland_batch": f"""
        WITH silver AS ({silver_sql(BATSMEN)})
        SELECT {_REFRESHED}, 'ranking_batsmen_20240101' AS file_name, '{SECOND_LOAD}' AS update_timestamp
        FROM silver WHERE rating >= 0
        UNION ALL
        SELECT {_SILVER}, 'ranking_batsmen_20240102' AS file_name, '{SECOND_LOAD}' AS update_timestamp
        FROM silver WHERE rating < 0""",
    "stream_reland": f"""
        SELECT {_REFRESHED}, 'ranking_batsmen_20240101' AS file_name
        FROM ({silver_sql(BATSMEN)}) WHERE rating >= 0""",
    "stream_versions": f"""
        WITH landed AS (
            SELECT {_CELLS}, 'players_' || (id::bigint // 1000) AS file_name FROM ({landing_sql(BATSMEN.name)}))
        SELECT *, '{FIRST_LOAD}' AS update_timestamp FROM landed
        UNION ALL
        SELECT * REPLACE ('1000.50' AS rating), '{SECOND_LOAD}' FROM landed
        WHERE id::bigint // 1000 % 2 = 0 AND rating::double >= 0""",
    "silver_refresh": f"""
        WITH silver AS ({silver_sql(BATSMEN)}),
        again AS (SELECT * FROM silver WHERE rating >= 0)
        SELECT {_REFRESHED}, file_name, '{SECOND_LOAD}' AS update_timestamp FROM again
        UNION ALL
        SELECT {_SILVER}, file_name, '{FIRST_LOAD}' AS update_timestamp FROM silver
        WHERE file_name NOT IN (SELECT file_name FROM again)""",
    "latest_batch_manifest": f"""
        WITH landed AS ({landing_sql(BATSMEN.name)}),
        again AS (SELECT * REPLACE ('1000.50' AS rating) FROM landed WHERE rating::double >= 0),
        loads AS (
            SELECT * EXCLUDE (update_timestamp), '{FIRST_LOAD}' AS update_timestamp FROM landed
            UNION ALL SELECT * EXCLUDE (update_timestamp), '{SECOND_LOAD}' FROM again)
        SELECT * FROM loads QUALIFY rank() OVER (PARTITION BY file_name ORDER BY update_timestamp DESC) = 1""",
    "all_layers": GOLD_ORACLES["gold_nested"],
    "truncated_tables": """
        SELECT layer, stage, CASE WHEN stage = 'before' THEN n ELSE 0 END AS n
        FROM (SELECT count(*) AS n FROM customer),
             (VALUES ('bronze'), ('silver'), ('gold')) AS layers(layer),
             (VALUES ('before'), ('after')) AS stages(stage)""",
    "archived_batches": f"""
        SELECT 'ranking_allrounders' AS source, '20240101' AS batch, {_csv_line()} AS line,
               NULL::bigint AS moved, NULL::bigint AS failed FROM ({landing_sql('ranking_allrounders')})
        UNION ALL
        SELECT 'ranking_allrounders', '20240102', {_csv_line()}, NULL, NULL
        FROM (SELECT * REPLACE ('1000.5' AS rating) FROM ({landing_sql('ranking_allrounders')}))
        UNION ALL
        SELECT 'ranking_batsmen', '20240101', {_csv_line()}, NULL, NULL
        FROM ({landing_sql('ranking_batsmen')}) WHERE rating::double >= 0
        UNION ALL SELECT 'ranking_allrounders', NULL, NULL, 2, 0
        UNION ALL SELECT 'ranking_batsmen', NULL, NULL, 1, 1""",
    "responses_to_silver": f"""
        SELECT * EXCLUDE (team2_wickets) REPLACE (nullif(series_name, '') AS series_name),
               team2_wickets AS team2_wicket
        FROM ({responses.ORACLES["flatten_results"]})""",
    "stream_ingest": f"SELECT {_SILVER} FROM ({silver_sql(BATSMEN)})",
}

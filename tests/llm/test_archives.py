"""WARC bundles: round trip, seek tables, revisits."""

import base64
import hashlib
import random
import tempfile

import pytest
import zstandard

from tierflow.llm import warc

SCHEMA = "page_id long, url string, html string, record_id string, row string"


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], SCHEMA)


def folder():
    return tempfile.mkdtemp(prefix="tierflow-warc-")


def summary(spark, rows, **options):
    index = warc.write(table(spark, rows), folder(), **options)
    return index, warc.read(index.select("bundle")).collect(), warc.resolved(warc.read(index.select("bundle"))).collect()


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def planted():
    rng = random.Random(3)
    bodies = ["", None, "<p>é\r\n\r\nWARC/1.1\r\n</p>", "x" * 700_000, "short"]
    bodies += ["".join(rng.choice("abcdef <>\n") for _ in range(rng.randint(0, 3_000))) for _ in range(60)]
    rows = [(i, rng.choice([None, "", "http://a/b c\nd", "https://é.example/"]), rng.choice(bodies)) for i in range(300)]
    return rows + [(None, "http://n/", "short"), (None, "http://n/", "short"), (None, None, None), (7, "http://n/", "short"), (400, None, "alone")]


def test_round_trip_and_revisits(spark, monkeypatch):
    rows = planted()
    index, records, resolved = summary(spark, rows)
    least, whole = {}, {}
    for i, _, body in rows:
        key = body or ""
        least[key] = min(least.get(key, warc_last()), warc_last() if i is None else i)
    by_id = {r.record_id: r for r in records}
    assert len(records) == len(by_id) == len(rows) == index.count()
    for r in records:
        if r.record_type == "response":
            text = r.payload.decode()
            assert text not in whole and digest(text) == r.payload_digest and len(r.payload) == r.payload_bytes
            whole[text] = r
            assert (warc_last() if r.page_id is None else r.page_id) == least[text]
        else:
            assert r.payload is None and by_id[r.refers_to].payload_digest == r.payload_digest
    assert set(whole) == {b or "" for _, _, b in rows}
    want = sorted(((i, len((b or "").encode()), digest(b)) for i, _, b in rows), key=str)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest) for r in resolved), key=str) == want
    for r in resolved:
        if r.record_type == "revisit":
            assert (warc_last() if r.refers_to is None else r.refers_to) == min(v for k, v in least.items() if digest(k) == r.payload_digest)
        else:
            assert r.refers_to is None
    uris = {r.uri for r in records}
    assert uris == {None, "http://a/b%20c%0Ad", "https://%C3%A9.example/", "http://n/"}


def warc_last():
    return 2**63 - 1


def test_small_payloads_are_no_revisits(spark):
    _, _, resolved = summary(spark, [(1, None, "ab"), (2, None, "ab"), (3, None, "long enough"), (4, None, "long enough")], min_bytes=5)
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in resolved) == [
        (1, "response", None), (2, "response", None), (3, "response", None), (4, "revisit", 3)
    ]


def test_seek_table_offsets_and_fetch(spark, monkeypatch):
    rows = [(i, f"http://h/{i}", f"text {i} " * (i % 50)) for i in range(500)]
    monkeypatch.setattr(warc, "FRAME_BYTES", 4_000)
    monkeypatch.setattr(warc, "BUNDLE_RECORDS", 90)
    index = warc.write(table(spark, rows), folder())
    entries = index.collect()
    assert len({e.bundle for e in entries}) >= 6 and max(e.frame for e in entries) > 2
    for uri in {e.bundle for e in entries}:
        where, path = warc.located(uri)
        with where.open_input_file(path) as file:
            raw = file.read()
        with where.open_input_file(path) as file:
            frames = warc.seek_table(file)
            # Any frame by itself, and the whole by a plain decompressor that skips the table.
            alone = [warc.frame_bytes(file, *f) for f in frames]
        assert b"".join(alone) == zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
        for e in (x for x in entries if x.bundle == uri):
            at, length, headers, _ = next(warc.parsed(alone[e.frame], e.offset))
            assert headers["WARC-Record-ID"] == e.record_id and (at, length) == (e.offset, e.length)
    wanted = index.filter("page_id % 37 = 5").select("record_id")
    found = warc.fetch(index, wanted.unionAll(wanted)).collect()
    assert sorted((r.page_id, r.payload.decode()) for r in found) == [(i, t) for i, _, t in rows if i % 37 == 5]


def test_damage_is_seen(spark):
    index = warc.write(table(spark, [(1, None, "some text")]), folder())
    uri = index.first().bundle
    where, path = warc.located(uri)
    with where.open_input_file(path) as file:
        raw = bytearray(file.read())
    raw[-12] ^= 1
    with where.open_output_stream(path, compression=None) as out:
        out.write(bytes(raw))
    with pytest.raises(Exception, match="seek table says"):
        warc.read(index.select("bundle")).collect()


def test_no_rows(spark):
    index, records, resolved = summary(spark, [])
    assert index.count() == 0 and records == [] and resolved == []

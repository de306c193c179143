"""Versions of foreign files: each is taken exactly once, also after a failure."""

import datetime as dt
import os

import pytest

from tierflow.specs import BATSMEN
from tierflow.streaming import ingest_versions

LOADS = [dt.datetime(2024, 1, day) for day in range(1, 6)]


def cells(rating, *ids):
    return [{**dict.fromkeys(BATSMEN.landing, "x"), "id": str(i), "rating": str(rating)} for i in ids]


def bronze(store):
    rows = store.bronze(BATSMEN).collect()
    return sorted((r.file_name, r.id, r.rating, r.update_timestamp.day) for r in rows)


def at(path, seconds):
    os.utime(path, (seconds, seconds))


def test_a_rewritten_file_is_taken_again_once(spark, store, land):
    names = list(BATSMEN.landing)
    path = land("b", "one.csv", names, cells(1, 1, 2))
    land("b", "two [x].csv", names, cells(1, 3))
    assert ingest_versions(spark, BATSMEN, path, store, LOADS[0], refresh=True) == 2
    assert ingest_versions(spark, BATSMEN, path, store, LOADS[1], refresh=True) == 0
    # Same size, another time and content.
    land("b", "one.csv", names, cells(7, 1, 2))
    at(f"{path}/one.csv", 2_000_000_000)
    assert ingest_versions(spark, BATSMEN, path, store, LOADS[2], refresh=True) == 1
    assert ingest_versions(spark, BATSMEN, path, store, LOADS[3], refresh=True) == 0
    first = [("one", "1", "1", 1), ("one", "2", "1", 1), ("two [x]", "3", "1", 1)]
    assert bronze(store) == sorted([*first, ("one", "1", "7", 3), ("one", "2", "7", 3)])
    silver = {(r.file_name, float(r.rating)) for r in store.silver(BATSMEN).collect()}
    assert silver == {("one", 7.0), ("two [x]", 1.0)}


@pytest.mark.parametrize("after_write", [False, True])
def test_a_broken_run_is_made_good(spark, store, land, monkeypatch, after_write):
    names = list(BATSMEN.landing)
    path = land("b", "one.csv", names, cells(1, 1))
    land("b", "two.csv", names, cells(1, 2))
    whole = store.append_bronze

    def broken(*args, **options):
        if after_write:
            whole(*args, **options)
        raise RuntimeError("lost")

    monkeypatch.setattr(store, "append_bronze", broken)
    with pytest.raises(RuntimeError):
        ingest_versions(spark, BATSMEN, path, store, LOADS[0])
    monkeypatch.setattr(store, "append_bronze", whole)
    land("b", "two.csv", names, cells(55, 2))
    land("b", "three.csv", names, cells(1, 3))
    # One is taken under the first load's timestamp, the others are new.
    assert ingest_versions(spark, BATSMEN, path, store, LOADS[1]) == 2
    assert bronze(store) == [("one", "1", "1", 1), ("three", "3", "1", 2), ("two", "2", "55", 2)]
    assert ingest_versions(spark, BATSMEN, path, store, LOADS[2]) == 0

"""CSV cells with newlines, read in splits: equal to Spark's unsplit read."""

import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from tierflow.sources.csv_landing import CSV_DIALECT, scan_csv
from tierflow.sources.csv_records import csv_records, split_lines, split_states, still_quoted
from tierflow.specs import PHOTOS, string_schema

NAMES = list(PHOTOS.landing)


@pytest.fixture
def splits_of(spark):
    """Reads files in splits of so many bytes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield use
    for key, value in old.items():
        spark.conf.set(key, value)


def unsplit(spark, path):
    return spark.read.schema(string_schema(NAMES)).options(**CSV_DIALECT, enforceSchema=True, multiLine=True).csv(path)


def in_order(rows):
    return sorted(rows, key=lambda r: [x or "" for x in r])


def write(folder, name, rows, end="\n"):
    os.makedirs(f"{folder}/photos", exist_ok=True)
    with open(f"{folder}/photos/{name}.csv", "w", newline="") as f:
        csv.writer(f, lineterminator=end).writerows([NAMES, *rows])
    return f"{folder}/photos"


def odd_cell(rng):
    parts = ["a", "\n", '"', ",", "\n\n", '""', "é", " ", '",\n"', "word", ""]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(9)))


@pytest.mark.parametrize("size", [150, 700, 100_000])
def test_any_split_gives_the_unsplit_rows(spark, folder, splits_of, size):
    rng = random.Random(size)
    for name in ("one", "two"):
        rows = [[odd_cell(rng), f"intro {k}", odd_cell(rng), str(k)] for k in range(60)]
        path = write(folder, name, rows)
    wanted = in_order(map(tuple, unsplit(spark, path).collect()))
    splits_of(size)
    found = in_order(map(tuple, scan_csv(spark, path, PHOTOS, bind="position").collect()))
    assert found == wanted and len(found) == 120
    assert in_order(map(tuple, scan_csv(spark, path, PHOTOS, bind="name").collect())) == wanted


def test_a_cell_longer_than_many_splits(spark, folder, splits_of):
    cell = "\n".join(f'line {k}, "quoted"' for k in range(200))
    path = write(folder, "long", [["before", "x", "y", "1"], [cell, "x", "y", "2"], ["behind", "x", "y", "3"]])
    splits_of(100)
    assert split_lines(spark, path).select("block_start").distinct().count() > 20
    found = {r.imageId: r.caption for r in scan_csv(spark, path, PHOTOS, bind="position").collect()}
    assert found == {"1": "before", "2": cell, "3": "behind"}


def test_one_file_is_read_by_several_tasks(spark, folder, splits_of):
    path = write(folder, "many", [[f"two\nlines {k}", "x", "y", str(k)] for k in range(300)])
    splits_of(1000)
    tasks = scan_csv(spark, path, PHOTOS, bind="position").select(F.spark_partition_id().alias("p"), "imageId")
    assert tasks.select("p").distinct().count() > 3
    assert tasks.count() == 300


def test_line_ends_of_two_bytes_and_blank_lines(spark, folder, splits_of):
    path = write(folder, "dos", [["a\r\nb\r\n" * 9, "x", "", "1"], ["c", "", "y", "2"]], "\r\n")
    with open(f"{path}/dos.csv", "ab") as f:
        f.write(b"\r\nlast,,,3\r\n\r\n")
    splits_of(16)
    found = in_order(map(tuple, scan_csv(spark, path, PHOTOS, bind="position").collect()))
    assert found == in_order([("a\r\nb\r\n" * 9, "x", None, "1"), ("c", None, "y", "2"), ("last", None, None, "3")])


def test_stray_quotes_and_an_open_end(spark, folder, splits_of):
    os.makedirs(f"{folder}/photos")
    with open(f"{folder}/photos/x.csv", "w") as f:
        f.write(",".join(NAMES) + '\n5" pipe,x,y,1\nplain,x,y,2\n"open\nend')
    splits_of(12)
    records = {r.record for r in csv_records(spark, f"{folder}/photos").filter("not is_header").collect()}
    assert records == {'5" pipe,x,y,1', "plain,x,y,2", '"open\nend'}


def test_states_by_reading_from_the_front(spark, folder, splits_of):
    rng = random.Random(5)
    path = write(folder, "s", [[odd_cell(rng), odd_cell(rng), "y", str(k)] for k in range(80)])
    splits_of(57)
    found = {r.block_start: r.quoted for r in split_states(split_lines(spark, path)).collect()}
    text = open(f"{path}/s.csv", newline="").read().encode()
    quoted, at, states = False, 0, {}
    for line in text.split(b"\n"):
        states[at] = quoted
        quoted, at = still_quoted(line.decode(), quoted), at + len(line) + 1
    # A line that begins just where a split does belongs to the split before.
    for block, state in found.items():
        assert state == states[min(a for a in states if a > block or a == block == 0)]
    assert True in found.values() and False in found.values()


def test_empty_files_and_folders(spark, folder, splits_of):
    path = write(folder, "empty", [])
    open(f"{path}/none.csv", "w").close()
    splits_of(10)
    assert scan_csv(spark, path, PHOTOS, bind="position").collect() == []

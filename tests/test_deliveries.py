"""Files delivered again: a rewritten file is taken again by the stream, everything else once."""

import os

import pytest
from helpers import rows

from fleetmart import schema as S
from fleetmart.plans import ingest as In
from fleetmart.streaming import deliveries as D


def at(path, text, when):
    path.write_text(text)
    os.utime(path, (when, when))


@pytest.fixture
def folder(spark, tmp_path):
    src = tmp_path / "land"
    src.mkdir()
    notes, out, state = (str(tmp_path / n) for n in ("announced", "out", "state"))

    def run(listings=1):
        found = [D.announce(spark, str(src), notes, glob="*.csv") for _ in range(listings)]
        D.ingest(D.deliveries(spark, notes), In.reader(spark, "csv", sep=","), out, state).awaitTermination()
        return found

    return src, notes, out, run


def held(spark, out, part="clean"):
    return rows(spark.read.option("mergeSchema", "true").parquet(f"{out}/{part}").select("a", "b"))


def test_a_rewritten_file_is_taken_again(spark, folder):
    src, notes, out, run = folder
    at(src / "x.csv", "a,b\n1,2\n", 1_700_000_000)
    at(src / "y 1+.csv", "a,b\n3,4\n", 1_700_000_100)
    assert run(listings=2) == [2, 0]
    assert held(spark, out) == [("1", "2"), ("3", "4")]
    assert run() == [0] and held(spark, out) == [("1", "2"), ("3", "4")]
    at(src / "x.csv", "a,b\n5,6\n", 1_700_000_200)  # rewritten
    at(src / "y 1+.csv", "a,b\n9,9\n", 1_700_000_050)  # an older time is no delivery
    at(src / "z.csv", "a,b\n7,8\n", 1_600_000_000)  # a late file with an old time of its own is one
    assert run() == [2]
    assert held(spark, out) == [("1", "2"), ("3", "4"), ("5", "6"), ("7", "8")]
    ledger = spark.read.parquet(f"{out}/ledger")
    assert ledger.count() == 4 and ledger.select("file_path", "file_modified").distinct().count() == 4


def test_overlapping_announcements_count_once(spark, folder):
    """Two listers that saw the same files, and one file at two times: state keeps one row for each delivery."""
    src, notes, out, run = folder
    at(src / "x.csv", "a,b\n1,2\n", 1_700_000_000)
    assert run() == [1]
    spark.read.parquet(notes).write.mode("append").parquet(notes + "-copy")
    spark.read.parquet(notes + "-copy").write.mode("append").parquet(notes)
    older = spark.read.parquet(notes + "-copy").selectExpr("file_path", "file_modified - INTERVAL 1 HOUR AS file_modified", "size")
    older.write.mode("append").parquet(notes)
    run()
    assert held(spark, out) == [("1", "2")]


def test_corrupt_rows_and_empty_folders(spark, folder):
    src, notes, out, run = folder
    assert D.announce(spark, str(src), notes) == 0 and not os.path.exists(notes)
    at(src / "good.csv", "a,b\n1,2\n", 1_700_000_000)
    at(src / "bad.csv", "a,b\n3,4\n5,6,7\n", 1_700_000_000)
    run()
    assert held(spark, out) == [("1", "2")] and len(held(spark, out, "corrupted")) == 2
    assert {os.path.basename(r.file_path): r.status for r in spark.read.parquet(f"{out}/ledger").collect()} == {"good.csv": S.INGESTED, "bad.csv": S.CORRUPTED}
    at(src / "bad.csv", "a,b\n3,4\n", 1_700_000_500)  # mended and delivered anew
    run()
    assert held(spark, out) == [("1", "2"), ("3", "4")]


def test_batches_of_bounded_size(spark, folder, monkeypatch):
    src, notes, out, run = folder
    monkeypatch.setattr(D, "MICRO_BATCH", 3)
    for i in range(8):
        at(src / f"{i}.csv", f"a,b\n{i},0\n", 1_700_000_000 + i)
    assert run() == [8]
    assert len(held(spark, out)) == 8
    assert spark.read.parquet(f"{out}/ledger").groupBy("batch").count().agg({"count": "max"}).first()[0] <= 3

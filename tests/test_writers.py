"""Keyed tables and several writers: what an upsert rewrites, who wins, and that nothing is lost or doubled."""

import json
import os

import pytest
from helpers import rows
from pyspark.sql import functions as F

from fleetmart import schema as S
from fleetmart.plans import ingest as In
from fleetmart.sources import keyed
from fleetmart.sources import sinks as K
from fleetmart.sources import versions as V


def files(path):
    """Data files of a table, below their folder."""
    return {str(p.relative_to(path)) for p in path.rglob("*.parquet") if "data-" in str(p)}


def named(spark, path):
    """Folders that the newest version names."""
    return {r["_folder"] for r in keyed.manifest(spark, str(path), V.newest(spark, str(path))) if r["_part"] >= 0}


def test_one_key_rewrites_one_partition(spark, tmp_path):
    path = tmp_path / "t"
    base = spark.range(2000).selectExpr("id AS k", "id * 2 AS v")
    K.upsert(base, str(path), ["k"])
    before, old = named(spark, path), files(path)
    assert len(before) == 64
    K.upsert(spark.createDataFrame([(77, -1)], "k long, v long"), str(path), ["k"])
    after = named(spark, path)
    assert len(before - after) == 1 == len(after - before)
    assert {f.rsplit("/", 1)[0] for f in files(path) - old} == after - before
    assert rows(K.read_current(spark, str(path))) == rows(base.withColumn("v", F.when(F.col("k") == 77, -1).otherwise(F.col("v"))))


def test_new_keys_are_written_beside_the_old_files(spark, tmp_path):
    path = tmp_path / "t"
    K.upsert(spark.range(1000).selectExpr("id AS k", "id AS v"), str(path), ["k"], 8)
    for n in range(1, keyed.MERGE - 1):
        before = named(spark, path)
        K.upsert(spark.range(n * 10**6, n * 10**6 + 50).selectExpr("id AS k", "0L AS v"), str(path), ["k"])
        assert before < named(spark, path)  # keys beyond all bounds: nothing is read or rewritten
    K.upsert(spark.range(10**7, 10**7 + 500).selectExpr("id AS k", "1L AS v"), str(path), ["k"])
    K.upsert(spark.range(10**8, 10**8 + 500).selectExpr("id AS k", "1L AS v"), str(path), ["k"])
    assert len(named(spark, path)) < 8 * keyed.MERGE  # crowded partitions are put together again
    assert K.read_current(spark, str(path)).count() == 1000 + 50 * (keyed.MERGE - 2) + 1000


def test_null_and_repeated_keys_on_every_write(spark, tmp_path):
    path = str(tmp_path / "t")
    up = spark.createDataFrame([(1, "b"), (1, "a"), (None, "z"), (None, "y"), (2, None)], "k int, v string")
    want = [(1, "a"), (2, None), (None, "y")]
    for _ in range(3):
        K.upsert(up, path, ["k"], 4)
        assert rows(K.read_current(spark, path)) == want
    K.upsert(spark.createDataFrame([(None, "n", 1.5), (3, "c", None)], "k int, v string, extra double"), path, ["k"])
    assert rows(K.read_current(spark, path)) == [(1, "a", None), (2, None, None), (3, "c", None), (None, "n", 1.5)]
    K.upsert(spark.createDataFrame([], "k int, v string"), path, ["k"])
    assert K.read_current(spark, path).count() == 4


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "decimal(12,2)", "double"])
def test_bounds_of_any_key_type(spark, tmp_path, kind):
    path = str(tmp_path / "t")
    key = F.col("id") if kind in ("decimal(12,2)", "double") else F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))
    table = lambda lo, hi, v: spark.range(lo, hi).select(key.cast(kind).alias("k"), F.lit(v).alias("v"))
    K.upsert(table(0, 100, 1), path, ["k"], 4)
    K.upsert(table(90, 120, 2), path, ["k"])
    assert rows(K.read_current(spark, path).groupBy("v").count()) == [(1, 90), (2, 30)]


def test_several_keys_and_a_table_that_was_written_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    V.write_version(spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("b", 1, 1)], "x string, y int, v int"), path)
    K.upsert(spark.createDataFrame([("a", 2, 5), ("c", 9, 5)], "x string, y int, v int"), path, ["x", "y"], 4)
    assert rows(K.read_current(spark, path)) == [("a", 1, 1), ("a", 2, 5), ("b", 1, 1), ("c", 9, 5)]


def test_two_upserts_at_once(spark, tmp_path, monkeypatch):
    """A second writer publishes while the first one writes: same partition or another one, both stay."""
    path = str(tmp_path / "t")
    K.upsert(spark.range(64).selectExpr("id AS k", "0L AS v"), path, ["k"], 8)
    part = {r.k: r.p for r in spark.range(64).select(F.col("id").alias("k")).withColumn("p", keyed.part_of(["k"], 8)).collect()}
    other = next(k for k in part if part[k] != part[0])
    same = next(k for k in part if k and part[k] == part[0])
    write, calls = keyed._written, []
    for rival, mine in ((other, 1), (same, 2)):
        calls.clear()

        def written(*a, rival=rival, mine=mine):
            calls.append(1)
            if len(calls) == 1:
                keyed.upsert(spark.createDataFrame([(rival, 100 + mine)], "k long, v long"), path, ["k"])
            return write(*a)

        monkeypatch.setattr(keyed, "_written", written)
        keyed.upsert(spark.createDataFrame([(0, mine)], "k long, v long"), path, ["k"])
        monkeypatch.setattr(keyed, "_written", write)
        got = {r.k: r.v for r in K.read_current(spark, path).collect()}
        assert len(got) == 64 and got[0] == mine and got[rival] == 100 + mine
        assert len(calls) == (2 if rival == other else 3)  # the rival's write, and a second one only if it changed what was read


def test_vacuum(spark, tmp_path):
    path = tmp_path / "t"
    for v in range(4):
        K.upsert(spark.createDataFrame([(1, v)], "k int, v int"), str(path), ["k"], 2)
    (path / "data-dead").mkdir()
    assert keyed.vacuum(spark, str(path), keep=1) == []  # nothing is old enough
    gone = keyed.vacuum(spark, str(path), keep=1, older_than_s=-5)
    assert "data-dead" in gone and len(gone) == 4
    assert rows(K.read_current(spark, str(path))) == [(1, 3)] and V.versions(spark, str(path)) == [4]


def test_only_one_writer_publishes_a_version(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1,)], "k int")
    assert V.write_version(one, path, 0) == 1
    with pytest.raises(V.Conflict):
        V.write_version(one, path, 0)
    assert V.write_version(one, path, 1) == 2 and sorted(p.name for p in (tmp_path / "t").iterdir()) == ["v00000001", "v00000002"]
    (tmp_path / "a").write_text(json.dumps(1))
    (tmp_path / "b").write_text(json.dumps(2))
    assert not V.rename_new(spark, str(tmp_path / "a"), str(tmp_path / "b")) and (tmp_path / "b").read_text() == "2"
    assert V.rename_new(spark, str(tmp_path / "a"), str(tmp_path / "c"))


def test_change_builds_on_the_newest_version(spark, tmp_path):
    path, seen = str(tmp_path / "t"), []
    V.write_version(spark.createDataFrame([(1,)], "k int"), path)

    def build(df):
        seen.append(df.count())
        if len(seen) == 1:  # somebody else is faster
            V.write_version(df.union(spark.createDataFrame([(2,)], "k int")), path)
        return df.union(spark.createDataFrame([(3,)], "k int"))

    assert V.change(spark, path, build) == 3 and seen == [1, 2]
    assert rows(V.read_version(spark, path, 3)) == [(1,), (2,), (3,)]


# ingest


@pytest.fixture
def landing(spark, tmp_path):
    src = tmp_path / "land"
    src.mkdir()
    for name in "abcd":
        (src / f"{name}.csv").write_text(f"t,v\n{name},1\n")
    led = str(tmp_path / "ledger")
    In.land_files(spark, str(src), led, "csv")
    return src, led, str(tmp_path / "bronze")


def run(spark, led, out, pattern=None, before=None):
    """One ingest; ``before`` is called once, when its files have been chosen. Returns how often files were read."""
    reads, read = [], In.reader(spark, "csv", sep=",")

    def reading(paths):
        reads.append(sorted(os.path.basename(p) for p in paths))
        if before and len(reads) == 1:
            before()
        return read(paths)

    In.ingest(spark, led, "csv", out, "run", "2024-06-01T00:00:00", reading, pattern=pattern)
    return reads


def held(spark, out, led):
    return sorted(r["t"] for r in K.read_loads(spark, out, led).collect())


def test_overlapping_ingests_give_each_file_once(spark, landing):
    src, led, out = landing
    inner = []
    reads = run(spark, led, out, before=lambda: inner.extend(run(spark, led, out, pattern="^[ab]")))
    assert inner == [["a.csv", "b.csv"]] and reads == [["a.csv", "b.csv", "c.csv", "d.csv"], ["c.csv", "d.csv"]]
    assert held(spark, out, led) == ["a", "b", "c", "d"]
    assert spark.read.parquet(out).count() == 4  # the loser's folder is gone
    assert {r["status"] for r in K.read_current(spark, led).collect()} == {S.INGESTED}


def test_everything_taken_by_the_other_run(spark, landing):
    src, led, out = landing
    reads = run(spark, led, out, before=lambda: run(spark, led, out))
    assert len(reads) == 1 and held(spark, out, led) == ["a", "b", "c", "d"] and spark.read.parquet(out).count() == 4


def test_other_files_cost_no_second_reading(spark, landing):
    src, led, out = landing

    def meanwhile():
        run(spark, led, out, pattern="^[cd]")
        (src / "e.csv").write_text("t,v\ne,1\n")
        In.land_files(spark, str(src), led, "csv")

    reads = run(spark, led, out, pattern="^[ab]", before=meanwhile)
    assert reads == [["a.csv", "b.csv"]]
    assert held(spark, out, led) == ["a", "b", "c", "d"]
    assert {r["filename"]: r["status"] for r in K.read_current(spark, led).collect()} == {**{f"{n}.csv": S.INGESTED for n in "abcd"}, "e.csv": S.PENDING}


def test_a_running_load_is_left_alone(spark, landing):
    src, led, out = landing
    ledger = K.read_current(spark, led)
    mine, dead = K.begin_load(1), K.begin_load(1)
    K.end_load(dead)
    foreign = 5
    for load in (mine, dead, foreign):
        spark.range(1).write.parquet(f"{out}/load={load:08d}")
    K.drop_unfinished(spark, out, ledger)
    assert set(K._load_folders(spark, out)) == {mine, foreign}
    K.drop_unfinished(spark, out, ledger, lease_s=-5)
    assert set(K._load_folders(spark, out)) == {mine}


def test_a_lost_executor_is_no_faulty_file(spark, landing):
    src, led, out = landing
    calls = []

    def read(paths):
        calls.append(1)
        raise RuntimeError("Job aborted: ExecutorLostFailure")

    with pytest.raises(RuntimeError):
        In.ingest(spark, led, "csv", out, "run", "2024-06-01T00:00:00", read)
    assert len(calls) == 1 and {r["status"] for r in K.read_current(spark, led).collect()} == {S.PENDING}

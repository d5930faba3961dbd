"""How tables lie on disk: clustering that prunes, bucketed vaults, refreshed copies; and joins of busy pieces."""

import datetime as dt
import glob
import random

import pyarrow.parquet as pq
import pytest
from helpers import rows
from pyspark.sql import functions as F

from fleetmart import schema as S
from fleetmart.operators import cluster as C
from fleetmart.operators import joins as J
from fleetmart.operators import vault as Va
from fleetmart.operators.settle import shared_default
from fleetmart.plans import ingest as In
from fleetmart.sources import sinks as K
from fleetmart.sources import snapshots as Sn
from fleetmart.sources import versions as V


def files_with(path, column, value):
    """Data files that a filter on a value can't pass over, by their footers."""
    hit, names = 0, glob.glob(f"{path}/*.parquet")
    for name in names:
        meta = pq.read_metadata(name)
        at = [i for i in range(meta.num_columns) if meta.schema.column(i).name == column][0]
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        hit += any(s.has_min_max and s.min <= value <= s.max for s in stats)
    return hit, len(names)


def test_filters_on_either_key_skip_files(spark, tmp_path):
    rng = random.Random(1)
    data = [(f"ship-{rng.randrange(300):04d}", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(500_000)), i) for i in range(20_000)]
    df = spark.createDataFrame(data, "ship string, at timestamp, n int").repartition(8)
    C.clustered(df, ["ship", "at"], 32).write.parquet(str(tmp_path / "z"))
    df.sortWithinPartitions("ship", "at").write.parquet(str(tmp_path / "sorted"))
    assert rows(spark.read.parquet(str(tmp_path / "z")).groupBy("n").count().filter("count > 1")) == [] and spark.read.parquet(str(tmp_path / "z")).count() == 20_000
    for column, values in (("ship", ["ship-0007", "ship-0150", "ship-0299"]), ("at", [dt.datetime(2024, 2, 1, tzinfo=dt.UTC), dt.datetime(2024, 11, 30, tzinfo=dt.UTC)])):
        for value in values:
            hit, of = files_with(tmp_path / "z", column, value)
            assert of >= 24 and 0 < hit < of / 3, (column, value, hit, of)
            assert files_with(tmp_path / "sorted", column, value)[0] == 8  # sorted inside tasks only: every file has all values


def test_clustering_keeps_all_rows(spark):
    data = [(None if i % 7 == 0 else i % 3, "x" * (i % 5), None) for i in range(100)]
    df = spark.createDataFrame(data, "a int, b string, c date")
    for keys in (["a"], ["a", "b", "c"], ["c"], ["absent"], []):
        assert rows(C.clustered(df, keys, 4)) == rows(df)
    assert C.clustered(df.limit(0), ["a", "b"]).collect() == []


def test_z_numbers_interleave_bits(spark):
    got = spark.range(8).select(C.z_number([F.col("id"), F.lit(5)], 3).alias("z")).collect()
    want = [sum(((i >> b & 1) << 2 * b + 1) + ((5 >> b & 1) << 2 * b) for b in range(3)) for i in range(8)]
    assert [r.z for r in got] == want
    cuts = [3, 4, 9]
    assert [r[0] for r in spark.range(11).select(C.range_number(F.col("id"), cuts)).collect()] == [sum(c <= i for c in cuts) for i in range(11)]


def test_bucketed_vault_needs_no_exchange(spark, tmp_path):
    ev = spark.range(500).selectExpr("id AS event_id", "concat('k', id % 200) AS event_key", "id % 9 AS origin", "id % 5 AS fuel")
    layout = {"HUB_Flight": ["event_key"], "SAT_Flight_Planned": ["event_key", "event_id", "origin"], "SAT_Flight_Fuel": ["event_key", "event_id", "fuel"]}
    names = K.publish_bucketed(ev, layout, str(tmp_path / "vault"), "event_key", 4)
    plain = K.publish(ev, layout, str(tmp_path / "plain"))
    big = lambda read: Va.one_big_table(read("HUB_Flight"), {n: read(n) for n in layout if n.startswith("SAT")}, "event_key")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = big(lambda n: spark.table(names[n]))
        assert rows(df) == rows(big(lambda n: spark.read.parquet(plain[n]))) and df.count() == 200
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")
        for n in names.values():
            spark.sql(f"DROP TABLE {n}")
        again = K.attach_bucketed(spark, str(tmp_path / "vault"), list(layout), "event_key", 4)
        df = big(lambda n: spark.table(again[n]))
        assert df.count() == 200 and "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for n in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {n}")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_busy_pieces_are_cut_into_days(spark, how):
    """One key holds most facts and spans; open and clipped spans, keys and days that are NULL, repeated facts."""
    r = random.Random(4)
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    facts = [(i, "a" if r.random() < 0.9 else r.choice("bc"), day(r.choice([40, 41, r.randrange(0, 200)]))) for i in range(600)]
    facts += [(1000, None, day(3)), (1001, "a", None), *facts[:5]]
    spans = [(j, "a" if r.random() < 0.8 else "b", day(s := r.randrange(-50, 180)), None if r.random() < 0.3 else day(s + r.randrange(-3, 90))) for j in range(60)]
    f, s = spark.createDataFrame(facts, "id int, imo string, d date"), spark.createDataFrame(spans, "sid int, imo string, lo date, hi date")
    want = [(a[0], b[0]) for a in facts for b in spans if a[1] == b[1] and a[2] and b[2] <= a[2] <= (b[3] or day(150))]
    if how == "left":
        want += [(a[0], None) for a in facts if not any(a[1] == b[1] and a[2] and b[2] <= a[2] <= (b[3] or day(150)) for b in spans)]
    for extra in ({"piece_rows": 20}, {"piece_rows": 1, "salts": 3, "bucket_days": 5}, {"piece_rows": 10**9}, {"piece_rows": 20, "clip": ("2024-01-01", "2024-08-01")}):
        out = J.interval_join(f, s, "imo", "d", "lo", "hi", str(day(150)), how=how, **extra)
        assert sorted(((x["id"], x["sid"]) for x in out.collect()), key=str) == sorted(want, key=str), extra
        assert [c for c in out.columns if c.startswith("_")] == []


def test_refresh_copies_new_loads_only(spark, tmp_path, monkeypatch):
    src, led, table, copy = tmp_path / "land", str(tmp_path / "ledger"), str(tmp_path / "bronze"), str(tmp_path / "copy")
    src.mkdir()

    def load(name, text):
        (src / name).write_text(text)
        In.land_files(spark, str(src), led, "csv")
        In.ingest(spark, led, "csv", table, "run", "2024-06-01T00:00:00", In.reader(spark, "csv", sep=","))

    held = lambda: sorted((r["t"], r["v"]) for r in Sn.read(spark, copy).select("t", "v").collect())
    assert Sn.read(spark, copy) is None
    load("a.csv", "t,v\n1,2\n")
    assert len(Sn.refresh(spark, table, led, copy)) == 1 and held() == [("1", "2")]
    load("b.csv", "t,v,w\n3,4,5\n")
    write, seen = V.write_version, []

    def watched(*a):  # a reader while the refresh runs
        seen.append(held())
        return write(*a)

    monkeypatch.setattr(V, "write_version", watched)
    assert len(Sn.refresh(spark, table, led, copy)) == 1
    assert seen == [[("1", "2")]] and held() == [("1", "2"), ("3", "4")]
    assert Sn.refresh(spark, table, led, copy) == [] and V.versions(spark, copy) == [1, 2] and len(seen) == 1
    assert [r["t"] for r in Sn.read(spark, copy, ["t"], 1).collect()] == ["1"] and S.INGESTED == "ingested"


def test_two_refreshes_at_once(spark, tmp_path, monkeypatch):
    led, table, copy = (str(tmp_path / n) for n in ("ledger", "bronze", "copy"))
    V.write_version(spark.createDataFrame([("f", "f", "csv", S.INGESTED, 7)], "filename string, filepath string, format string, status string, load long"), led)
    spark.range(3).write.parquet(f"{table}/load={7:08d}")
    write, calls = V.write_version, []

    def rival(*a):
        calls.append(1)
        if len(calls) == 1:
            assert Sn.refresh(spark, table, led, copy) == [7]
        return write(*a)

    monkeypatch.setattr(V, "write_version", rival)
    assert Sn.refresh(spark, table, led, copy) == []
    assert Sn.read(spark, copy).count() == 3 and V.versions(spark, copy) == [1]


def test_scratch_folder_of_each_machine_is_refused():
    assert shared_default("file:/w/", "local[8]") == "file:/w/_scratch" and shared_default("/w", "local") == "/w/_scratch"
    assert shared_default("hdfs://n/w", "yarn") == "hdfs://n/w/_scratch"
    for warehouse, master in (("file:/w", "yarn"), ("/w", "spark://h:7077"), ("file:/w", "local-cluster[3,2,3000]")):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_default(warehouse, master)

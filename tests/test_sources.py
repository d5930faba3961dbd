"""File ingest on small files: header line, separators, ragged and corrupt rows, JSON, XML, ZIP, ledger, sinks, stream."""

import zipfile

import pytest
from pyspark.sql import functions as F

from helpers import rows
from fleetmart import schema as S
from fleetmart.operators import ledger as L
from fleetmart.sources import files as Fs
from fleetmart.sources import sinks as K
from fleetmart.streaming import ingest as Str

FAR = ("2000-01-01", "2100-01-01")


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def pick(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_csv_candidates_and_reordered_headers(spark, tmp_path):
    a = put(tmp_path / "a.csv", "time;ship;fuel\n1;A;10\n2;B;20\n")
    b = put(tmp_path / "b.csv", "fuel,time,ship\n30,3,C\n")
    c = put(tmp_path / "c.csv", 'time;fuel;ship\n4;40;"D;x"\n')
    df = Fs.read_csv(spark, [a, b, c], sep=",/;")
    assert pick(df, "time", "ship", "fuel") == [("1", "A", "10"), ("2", "B", "20"), ("3", "C", "30"), ("4", "D;x", "40")]
    assert df.columns == sorted(df.columns)
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}


def test_csv_header_on_later_line_and_skipped_rows(spark, tmp_path):
    text = "report\nmade today\ntime,ship,ship\nunits,-,-\n1,A,x\n2,B,y\n"
    paths = [put(tmp_path / f"h{i}.csv", text) for i in range(3)]
    df = Fs.read_csv(spark, paths, sep=",", header_line=2, skip_rows=4)
    assert pick(df, "time", "ship", "ship_1") == sorted([("1", "A", "x"), ("2", "B", "y")] * 3)
    one = Fs.read_csv(spark, [put(tmp_path / "s.csv", "junk\ntime,ship\n5,E\n")], header_line=1, skip_rows=1)
    assert pick(one, "time", "ship") == [("5", "E")]


def test_csv_edge_files(spark, tmp_path):
    single = put(tmp_path / "one.csv", "name\nx\ny\n")
    assert pick(Fs.read_csv(spark, [single], sep=","), "name") == [("x",), ("y",)]
    with pytest.raises(ValueError, match="no separator"):
        Fs.read_csv(spark, [single], sep=",/;")
    with pytest.raises(ValueError, match="header"):
        Fs.read_csv(spark, [put(tmp_path / "empty.csv", "")], sep=",")
    quoted = Fs.read_csv(spark, [put(tmp_path / "q.csv", '"a, first",b\n"1,5",2\n')], sep=",")
    assert pick(quoted, "a, first", "b") == [("1,5", "2")]
    named = Fs.read_csv(spark, [put(tmp_path / "n.csv", "foo,bar\n1,2\n")], first_column="time")
    assert pick(named, "time", "bar") == [("1", "2")]


def test_one_corrupt_row_quarantines_its_file(spark, tmp_path):
    good = put(tmp_path / "good.csv", "a,b\n1,2\n3,4\n")
    bad = put(tmp_path / "bad file.csv", "a,b\n5,6\n7,8,9\n")
    df = Fs.decorated(Fs.read_csv(spark, [good, bad]), "run-1", "2024-07-07T10:00:00")
    out = str(tmp_path / "out")
    led = Fs.list_files(spark, str(tmp_path)).filter("format = 'csv'")
    new = K.save_ingest(df, out, led, 1)
    K.save_ingest(df, out, led, 1)  # a second attempt takes the place of the first
    assert {r["filename"]: r["status"] for r in new.collect()} == {"good.csv": S.INGESTED, "bad file.csv": S.CORRUPTED}
    assert pick(spark.read.parquet(out), "a", "b", "source_file_name") == [("1", "2", "good.csv"), ("3", "4", "good.csv")]
    kept = spark.read.parquet(out + "_corrupted")
    assert kept.count() == 2 and kept.select("file_path").distinct().first()[0] == bad


def test_json_and_xml(spark, tmp_path):
    j = put(tmp_path / "x.json", '[{"a": 1,\n "b": {"c": 2}}, {"a": 3}]')
    assert pick(Fs.read_json(spark, [j]), "a") == [(1,), (3,)]
    x = put(tmp_path / "x.xml", "<r><FlightPlan><id>1</id><leg><from>A</from><to>B</to></leg></FlightPlan><FlightPlan><id>2</id></FlightPlan></r>")
    df = Fs.read_xml(spark, [x], "FlightPlan")
    assert pick(df, "id") == [(1,), (2,)]
    assert '{"from":"A","to":"B"}' in [r["leg"] for r in df.collect()]


def test_zip_members_of_any_number(spark, tmp_path):
    for name, members in (("two.zip", {"a.csv": "x,y\n1,2\n", "d/b.csv": "x,y\n3,4\n"}), ("none.zip", {})):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for m, text in members.items():
                z.writestr(m, text)
    put(tmp_path / "broken.zip", b"not a zip")
    m = Fs.expand_zips(spark, [str(tmp_path / n) for n in ("two.zip", "none.zip", "broken.zip")])
    new, changes = Fs.member_ledger(m, "2024-07-07 10:00:00")
    assert {r["filename"] for r in new.collect()} == {"a.csv", "b.csv"}
    assert {r["filepath"].rsplit("/", 1)[1]: r["status"] for r in changes.collect()} == {"two.zip": S.INGESTED, "broken.zip": S.UNZIP_FAILED}
    lines = Fs.member_lines(m).filter("pos > 0")
    parsed = Fs.parse_lines(lines, Fs.csv_schema("x,y", ","), ",")
    assert pick(parsed, "x", "y") == [("1", "2"), ("3", "4")]


def test_landing_is_idempotent_and_sees_new_deliveries(spark, tmp_path):
    src, led_path = tmp_path / "landing", str(tmp_path / "ledger")
    put(src / "d1" / "a.csv", "x\n1\n")
    put(src / "d2" / "b.csv", "x\n2\n")
    put(src / "c.txt", "zz")
    empty = spark.createDataFrame([], S.LEDGER)
    first = Fs.land(spark, str(src), empty, "csv", *FAR)
    assert first.schema.names == S.LEDGER.names and first.count() == 2
    import hashlib

    assert {r["etag"] for r in first.collect()} == {hashlib.sha256(t).hexdigest() for t in (b"x\n1\n", b"x\n2\n")}
    K.append(first, led_path)
    assert Fs.land(spark, str(src), spark.read.parquet(led_path), "csv", *FAR).count() == 0
    import os

    os.utime(src / "d1" / "a.csv", (1_900_000_000, 1_900_000_000))
    again = Fs.land(spark, str(src), spark.read.parquet(led_path), "csv", *FAR)
    assert [r["filename"] for r in again.collect()] == ["a.csv"]
    assert Fs.land(spark, str(src), empty, "csv", *FAR, pattern="^b").count() == 1
    assert Fs.land(spark, str(src), empty, "csv", *FAR, min_size=1000).count() == 0


def test_pending_and_status_changes(spark):
    led = spark.createDataFrame([("f1", "/f1", "csv", "pending"), ("f2", "/f2", "csv", "ingested"), ("f3", "/f3", "csv", "glacier_file"), ("f4", "/f4", "csv", "boom")], "filename string, filepath string, format string, status string")
    led = led.withColumns({"etag": F.lit(None).cast("string"), "last_modified": F.lit("2024-01-01").cast("timestamp"), "size": F.lit(1).cast("bigint")})
    assert {r["filename"] for r in L.pending_files(led, "csv", *FAR).collect()} == {"f1", "f4"}
    changes = spark.createDataFrame([("/f1", "x" * 300)], "filepath string, status string")
    out = {r["filename"]: r["status"] for r in L.update_status(led, changes).collect()}
    assert len(out["f1"]) == 255 and out["f4"] == "boom"
    assert K.failed(led, "/f4", "e'rr").filter("filename = 'f4'").first()["status"] == "e'rr"


def test_upsert_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    K.upsert(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path, ["k"])
    up = spark.createDataFrame([(2, "B", 9), (3, "c", 9)], "k int, v string, extra int")
    K.upsert(up, path, ["k"])
    want = [(1, "a", None), (2, "B", 9), (3, "c", 9)]
    assert rows(K.read_current(spark, path)) == want
    K.upsert(up, path, ["k"])
    assert rows(K.read_current(spark, path)) == want and K.versions(spark, path) == [1, 2, 3]
    (tmp_path / "t" / "v00000004").mkdir()  # a run that died before its success marker
    assert rows(K.read_current(spark, path)) == want


def test_append_grows_schema_and_partitions(spark, tmp_path):
    path = str(tmp_path / "a")
    K.append(spark.createDataFrame([(1, "x")], "k int, v string"), path, ["k"])
    K.append(spark.createDataFrame([(2, "y", 3.0)], "k int, v string, w double"), path, ["k"])
    assert rows(spark.read.option("mergeSchema", "true").parquet(path)) == [(1, "x", None), (2, "y", 3.0)]
    days = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (2, "2024-01-02 10:00:00")], "k int, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    K.append_by_day(days, str(tmp_path / "d"), "ts", ["k"])
    assert sorted(p.name for p in (tmp_path / "d").iterdir() if p.is_dir()) == ["event_day=2024-01-01", "event_day=2024-01-02"]
    K.export_single(days, str(tmp_path / "e"), fmt="csv")
    assert len(list((tmp_path / "e").glob("part-*"))) == 1


def test_publish_reads_the_events_once(spark, tmp_path):
    ev = spark.createDataFrame([(1, "k1", "A"), (1, "k1", "A"), (2, "k2", "B")], "event_id int, event_key string, Origin string")
    layout = {"HUB_Flight": ["event_id", "event_key"], "SAT_Flight_Planned": ["event_key", "origin", "absent"], "SAT_Empty": ["nothing"]}
    out = K.publish(ev, layout, str(tmp_path / "vault"))
    assert set(out) == {"HUB_Flight", "SAT_Flight_Planned"}
    assert rows(spark.read.parquet(out["HUB_Flight"])) == [(1, "k1"), (2, "k2")]
    assert spark.read.parquet(out["SAT_Flight_Planned"]).count() == 3


def test_stream_takes_new_files_only(spark, tmp_path):
    from pyspark.sql import types as T

    src, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    put(src / "a.csv", "a,b\n1,2\n")
    put(src / "b.csv", "a,b\n3,4\n5,6,7\n")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    run = lambda: Str.run_available(Str.file_stream(spark, str(src), schema, maxFilesPerTrigger=1), out, cp).awaitTermination()
    run()
    assert pick(spark.read.parquet(out + "/clean"), "a", "b") == [("1", "2")]
    assert spark.read.parquet(out + "/corrupted").count() == 2
    assert {r["file_path"].rsplit("/", 1)[1]: r["status"] for r in spark.read.parquet(out + "/ledger").collect()} == {"a.csv": S.INGESTED, "b.csv": S.CORRUPTED}
    put(src / "c.csv", "a,b\n8,9\n")
    run()
    run()
    assert pick(spark.read.parquet(out + "/clean"), "a", "b") == [("1", "2"), ("8", "9")]


def test_daily_figures_stream(spark, tmp_path):
    src = tmp_path / "hours"
    spark.createDataFrame([("A", f"2024-01-0{d} {h:02d}:00:00", 1.0) for d in (1, 2, 3) for h in (1, 2)], "ship string, ts string, v double").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(src))
    stream = spark.readStream.schema("ship string, ts timestamp, v double").parquet(str(src))
    daily = Str.daily_figures(Str.once_per_delivery(stream, ["ship"], "ts", "6 hours"), "ship", "ts", {"total": F.sum("v")}, lateness=None)
    q = daily.writeStream.format("memory").queryName("daily_figures").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination()
    assert pick(spark.table("daily_figures"), "ship", "total") == [("A", 2.0)]  # the later days may still change

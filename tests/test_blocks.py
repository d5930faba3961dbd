"""Files in blocks: digests and headers of large files, archives larger than a block, broken members, odd names."""

import gzip
import hashlib
import json
import os
import random
import zipfile

import pytest
from helpers import rows
from pyspark.sql import functions as F

from fleetmart import schema as S
from fleetmart.sources import blocks as B
from fleetmart.sources import files as Fs


def test_digests_in_blocks(spark, tmp_path):
    rng = random.Random(1)
    want = {}
    for n in (1, 2, B.BLOCK, B.BLOCK + 1, 3 * B.BLOCK + 7):
        data = rng.randbytes(n)
        (tmp_path / f"f {n}+ä.csv").write_bytes(data)
        want[str(tmp_path / f"f {n}+ä.csv")] = hashlib.sha256(data).hexdigest()
    listed = Fs.list_files(spark, str(tmp_path))
    got = Fs.hashed(spark, listed, str(tmp_path))
    assert got.columns == listed.columns and {r.filepath: r.etag for r in got.collect()} == want
    assert {r.filepath: r.etag for r in Fs.list_files(spark, str(tmp_path), with_etag=True).collect()} == want
    assert {B.digest(f"file:{p}", 100_000) for p in want} == set(want.values())
    (tmp_path / "empty").write_bytes(b"")
    assert B.digest(str(tmp_path / "empty")) == hashlib.sha256().hexdigest()


def test_a_large_file_takes_one_block_of_memory(tmp_path):
    """A sparse file above the 2 GB that a binary value may have."""
    path = tmp_path / "large"
    with open(path, "wb") as f:
        f.truncate((1 << 31) + 5)
    import pyarrow as pa

    before = pa.default_memory_pool().max_memory()
    zeros, found, left = bytes(B.BLOCK), hashlib.sha256(), (1 << 31) + 5
    while left:
        found.update(zeros[: min(left, B.BLOCK)])
        left -= min(left, B.BLOCK)
    assert B.digest(str(path)) == found.hexdigest()
    assert pa.default_memory_pool().max_memory() <= max(before, 8 * B.BLOCK)


def test_headers_read_the_first_blocks_only(spark, tmp_path):
    large = tmp_path / "large.csv"
    with open(large, "wb") as f:
        f.write(b"report\r\ntime,ship\r\n1,A\r\n")
        f.truncate(1 << 30)
    (tmp_path / "small.csv").write_bytes(b"x\ry,z")
    (tmp_path / "short.csv").write_bytes(b"only\n")
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "wide.csv").write_bytes(b"a\n" + b"c," * 200_000 + b"d\ne\n")
    with gzip.open(tmp_path / "packed.csv.gz", "wb") as f:
        f.write(b"first\nsecond  \nthird\n")
    got = {os.path.basename(r.path): r for r in B.heads(spark, [str(tmp_path)], 1).collect()}
    assert {n: r.header for n, r in got.items()} == {"large.csv": "time,ship", "small.csv": "y,z", "wide.csv": "c," * 200_000 + "d", "packed.csv.gz": "second"}
    assert got["large.csv"].bytes <= 1 << 20
    paths = [str(tmp_path / n) for n in ("large.csv", "small.csv", "wide.csv")]
    scan = [r.header for r in Fs.header_lines(spark, paths[1:], 1).collect()]
    assert sorted(scan) == sorted(r.header for n, r in got.items() if n in ("small.csv", "wide.csv"))


@pytest.mark.parametrize("ends", [b"\n", b"\r\n", b"\r"])
def test_first_lines_at_any_block_size(ends):
    import io

    data = ends.join([b"one", b"", b"three " * 9, b"four"]) + ends
    for block in range(1, 70):
        for n in range(1, 6):
            assert B.first_lines(io.BytesIO(data), n, block)[0] == data.splitlines()[:n]


def test_schemes():
    assert B.streamable(["/a/b c", "file:///a", "s3a://x/y"]) and not B.streamable(["viewfs://s/x"]) and not B.streamable(["/a/*.csv"])
    assert B.file_system("file:///a b%20c")[1] == "/a b%20c" == B.file_system("file:/a b%20c")[1] == B.file_system("/a b%20c")[1]


@pytest.fixture
def archives(tmp_path):
    rng = random.Random(2)
    texts = {f"d/{i}.csv": ("x,y\n" + "\n".join(f"{i},{rng.random()}" for _ in range(n))).encode() for i, n in enumerate((0, 3, 5000, 120_000))}
    with zipfile.ZipFile(tmp_path / "good.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.mkdir("empty")
        for name, data in texts.items():
            z.writestr(name, data)
        z.writestr("nothing.txt", b"")
        z.writestr("../../outside.csv", b"x\n1\n")
    with zipfile.ZipFile(tmp_path / "half.zip", "w", zipfile.ZIP_STORED) as z:
        z.writestr("fine.csv", b"a\n1\n")
        z.writestr("broken.csv", b"SPOILED-" * 50)
    data = (tmp_path / "half.zip").read_bytes()
    (tmp_path / "half.zip").write_bytes(data.replace(b"SPOILED-" * 25, b"spoiled-" * 25, 1))
    (tmp_path / "none.zip").write_bytes(b"not an archive")
    return texts | {"nothing.txt": b"", "../../outside.csv": b"x\n1\n"}, [str(tmp_path / n) for n in ("good.zip", "half.zip", "none.zip")]


def test_members_in_blocks(spark, archives):
    texts, paths = archives
    listed = B.members(spark, paths)
    assert {r.member: r.size for r in listed.filter("zip_path LIKE '%good.zip'").collect()} == {m: len(t) for m, t in texts.items()}
    assert [r.error for r in listed.filter("member IS NULL").collect()] == ["File is not a zip file"]
    got: dict = {}
    for r in B.member_blocks(listed, 4096).orderBy("zip_path", "member", "block").collect():
        assert r.content is None or len(r.content) <= 4096
        held = got.setdefault((os.path.basename(r.zip_path), r.member), [b"", 0, None])
        assert r.block == held[1]
        held[:] = [held[0] + (r.content or b""), r.block + 1, r.error]
    assert {m: v[0] for (z, m), v in got.items() if z == "good.zip"} == texts and not any(v[2] for (z, _), v in got.items() if z == "good.zip")
    assert got["half.zip", "fine.csv"][0] == b"a\n1\n" and "CRC" in got["half.zip", "broken.csv"][2] and got["none.zip", None][2]


def test_unpacked_members_are_files(spark, archives, tmp_path):
    texts, paths = archives
    target = tmp_path / "landing"
    for _ in range(2):  # again: the same files
        done = B.unpack(B.members(spark, paths), str(target), 4096)
        held = done.collect()
    assert {r.member: r.etag for r in held if r.zip_path.endswith("good.zip")} == {m: hashlib.sha256(t).hexdigest() for m, t in texts.items()}
    assert all(str(target) in os.path.realpath(r.path) and os.path.getsize(r.path) == r.size for r in held if r.path)
    assert sum(len(names) for _, _, names in os.walk(target)) == len(texts) + 1  # no leftovers, and nothing outside
    new, changes = B.unpacked_ledger(spark.createDataFrame(held, done.schema), "2024-07-07 10:00:00")
    assert new.columns == S.LEDGER.names
    assert {os.path.basename(r.filepath): r.status for r in changes.collect()} == {"good.zip": S.INGESTED, "half.zip": S.UNZIP_FAILED, "none.zip": S.UNZIP_FAILED}
    csvs = [r.filepath for r in new.filter("format = 'csv' AND filepath LIKE '%/d/%' AND size > 10").collect()]
    read = Fs.read_csv(spark, csvs, sep=",")
    assert rows(read.groupBy("x").count()) == [("1", 3), ("2", 5000), ("3", 120000)]


def test_landing_hashes_new_files_only(spark, tmp_path, monkeypatch):
    src = tmp_path / "land"
    src.mkdir()
    for n in "ab":
        (src / f"{n}.csv").write_text(n)
    first = Fs.land(spark, str(src), spark.createDataFrame([], S.LEDGER), "csv", "2000-01-01", "2100-01-01")
    known = spark.createDataFrame(first.collect(), S.LEDGER)
    assert {r.filename: r.etag for r in known.collect()} == {f"{n}.csv": hashlib.sha256(n.encode()).hexdigest() for n in "ab"}
    (src / "c.csv").write_text("c")
    again = Fs.land(spark, str(src), known, "csv", "2000-01-01", "2100-01-01")
    assert [(r.filename, r.etag) for r in again.collect()] == [("c.csv", hashlib.sha256(b"c").hexdigest())]
    assert json.dumps(again.schema.names) == json.dumps(S.LEDGER.names) and again.filter(F.col("etag").isNull()).isEmpty()

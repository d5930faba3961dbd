"""Files read block by block inside tasks: digests, header lines and ZIP members of files of any size.

A task opens a file through Arrow's file systems (local, S3, GCS, ABFS, HDFS) and holds one block of it. Paths of other
schemes are left to Spark's own readers; :func:`streamable` tells which way a set of paths goes.

Defined results: an empty file has the digest of no bytes and no header; a file without so many lines has no header; a
directory stands for the files in it; an archive that can't be opened gives one row with its error, a member that can't be
read only its own.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart import schema as S

BLOCK = 1 << 20
HEAD = 1 << 16  # bytes of a file that a header is looked for in at a time
SCHEMES = ("", "file", "s3", "s3a", "s3n", "gs", "gcs", "abfs", "abfss", "hdfs")


def scheme(path: str) -> str:
    return urlsplit(path).scheme if ":/" in path else ""


def streamable(paths: Sequence[str]) -> bool:
    """Whether tasks can open all of these themselves: plain files or folders in a file system that Arrow knows."""
    return all(scheme(p) in SCHEMES and not any(c in p for c in "*?[{") for p in paths)


def file_system(path: str):
    """Arrow's file system of a path, and the path in it."""
    from pyarrow import fs

    kind = scheme(path)
    if kind in ("", "file"):
        return fs.LocalFileSystem(), path.removeprefix("file:").replace("///", "/", 1) if kind else path
    if kind.startswith("s3"):
        path = "s3" + path[path.index(":") :]
    return fs.FileSystem.from_uri(quote(path, safe="/:@%"))


def _files(path: str) -> Iterator[tuple]:
    """(file system, path in it, path as given) of a file, or of the files of a directory."""
    from pyarrow import fs

    system, own = file_system(path)
    if system.get_file_info(own).type != fs.FileType.Directory:
        yield system, own, path
        return
    for info in system.get_file_info(fs.FileSelector(own, recursive=True)):
        if info.type == fs.FileType.File and not info.base_name.startswith(("_", ".")):
            yield system, info.path, path.rstrip("/") + info.path[len(own.rstrip("/")) :]


def paths_frame(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The paths as rows, dealt over as many tasks as there are cores or files."""
    n = max(1, min(len(paths), spark.sparkContext.defaultParallelism))
    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(n)


# digests ----------------------------------------------------------------------------------------------------------


def digest(path: str, block: int = BLOCK) -> str:
    """The SHA-256 of a file, a block at a time."""
    system, own = file_system(path)
    found = hashlib.sha256()
    with system.open_input_stream(own, compression=None, buffer_size=0) as f:
        while data := f.read(block):
            found.update(data)
    return found.hexdigest()


def with_digests(files: DataFrame, path: str, name: str, block: int = BLOCK) -> DataFrame:
    """``files`` with the SHA-256 of each file as ``name``; memory doesn't grow with the files. Rows go to their own tasks by
    path, so that large files are read side by side."""
    at = files.columns.index(path)
    schema = files.withColumn(name, F.lit("").cast("string")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([*row.columns, pa.array([digest(row.column(at)[0].as_py(), block)])], names=schema.names)

    return files.repartition(F.col(path)).mapInArrow(run, schema)


# header lines -----------------------------------------------------------------------------------------------------


def first_lines(stream, n: int, block: int = HEAD) -> tuple[list[bytes], int]:
    """The first ``n`` lines of a stream of bytes, as far as there are, and the number of bytes read."""
    data, size = b"", 0
    while True:
        more = stream.read(block)
        size += len(more)
        data += more
        lines = data.splitlines()
        # the last line may go on, and a carriage return may be half of a line end
        if not more or len(lines) > n + 1:
            return lines[:n], size


def heads(spark: SparkSession, paths: Sequence[str], line: int) -> DataFrame:
    """(path, header, bytes): line ``line`` (from 0) of every file, and how much of the file was read for it. Compressed
    files are known by their name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for system, own, name in _files(path):
                    with system.open_input_stream(own, compression="detect", buffer_size=0) as f:
                        lines, size = first_lines(f, line + 1)
                    if len(lines) > line:
                        header = lines[line].decode("utf-8", "replace").rstrip(" ")
                        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([header]), pa.array([size], pa.int64())], names=["path", "header", "bytes"])

    return paths_frame(spark, paths).mapInArrow(run, "path string, header string, bytes long")


# ZIP members ------------------------------------------------------------------------------------------------------

MEMBER = "zip_path string, member string, packed long, size long, error string"


class _Seekable(io.RawIOBase):
    """An Arrow file as Python's zipfile wants it."""

    def __init__(self, file) -> None:
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = 0) -> int:
        to = offset + (0, self.file.tell(), self.file.size())[whence]
        if to < 0:
            raise OSError(f"no position {to}")
        return self.file.seek(to)

    def tell(self) -> int:
        return self.file.tell()

    def readinto(self, buffer) -> int:
        data = self.file.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)


def _archive(path: str) -> zipfile.ZipFile:
    system, own = file_system(path)
    return zipfile.ZipFile(io.BufferedReader(_Seekable(system.open_input_file(own)), HEAD))


def members(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The members of archives with their sizes, from the central directories alone; a broken archive has an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                try:
                    with _archive(path) as z:
                        rows += [(path, m.filename, m.compress_size, m.file_size, None) for m in z.infolist() if not m.is_dir()]
                except Exception as e:  # noqa: BLE001 - the error becomes the file's status
                    rows.append((path, None, None, None, str(e)[: S.STATUS_LENGTH] or type(e).__name__))
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)], names=["zip_path", "member", "packed", "size", "error"])

    return paths_frame(spark, paths).mapInArrow(run, MEMBER)


def _apart(listed: DataFrame) -> DataFrame:
    """Members dealt over tasks one by one, in no more than a task for each."""
    return listed.repartition(F.col("zip_path"), F.col("member"))


def member_blocks(listed: DataFrame, block: int = BLOCK) -> DataFrame:
    """(zip_path, member, block, content, error): each member of :func:`members` in blocks, numbered from 0. A task holds one
    block; an empty member has one empty block; a member that can't be read on has a last row with its error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = lambda path, member, n, data, error: pa.RecordBatch.from_arrays(
            [pa.array([path]), pa.array([member], pa.string()), pa.array([n], pa.int64()), pa.array([data], pa.binary()), pa.array([error], pa.string())], names=["zip_path", "member", "block", "content", "error"]
        )
        for batch in batches:
            for path, member, error in zip(*(batch.column(c).to_pylist() for c in ("zip_path", "member", "error")), strict=True):
                n = 0
                try:
                    if error is None:
                        with _archive(path) as z, z.open(member) as f:
                            while (data := f.read(block)) or not n:
                                yield row(path, member, n, data, None)
                                n += 1
                except Exception as e:  # noqa: BLE001 - the error becomes the member's status
                    error = str(e)[: S.STATUS_LENGTH] or type(e).__name__
                if error is not None:
                    yield row(path, member, n, None, error)

    return _apart(listed).mapInArrow(run, "zip_path string, member string, block long, content binary, error string")


def unpack(listed: DataFrame, target: str, block: int = BLOCK) -> DataFrame:
    """Writes each member to ``target``/<digest of the archive's path>/<member> in blocks, under another name until it is whole; (zip_path, member, path, size,
    etag, error). Doing it again writes the same files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, member, error in zip(*(batch.column(c).to_pylist() for c in ("zip_path", "member", "error")), strict=True):
                to, size, etag = None, None, None
                if error is None:
                    try:
                        to, size, etag = _unpacked(path, member, target, block)
                    except Exception as e:  # noqa: BLE001 - the error becomes the member's status
                        error = str(e)[: S.STATUS_LENGTH] or type(e).__name__
                kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((path, member, to, size, etag, error), kinds, strict=True)], names=["zip_path", "member", "path", "size", "etag", "error"])

    return _apart(listed).mapInArrow(run, "zip_path string, member string, path string, size long, etag string, error string")


def _unpacked(path: str, member: str, target: str, block: int) -> tuple[str, int, str]:
    parts = [p for p in member.replace("\\", "/").split("/") if p not in ("", ".", "..")]  # a member stays inside the target
    to = "/".join([target.rstrip("/"), hashlib.sha256(path.encode()).hexdigest()[:16], *parts])
    system, own = file_system(to)
    folder, _, name = own.rpartition("/")
    system.create_dir(folder, recursive=True)
    aside, found, size = f"{folder}/.{name}-{uuid.uuid4().hex}", hashlib.sha256(), 0
    try:
        with _archive(path) as z, z.open(member) as f, system.open_output_stream(aside) as out:
            while data := f.read(block):
                out.write(data)
                found.update(data)
                size += len(data)
    except BaseException:
        system.delete_file(aside)
        raise
    system.move(aside, own)
    return to, size, found.hexdigest()


def unpacked_ledger(done: DataFrame, landed_at: str) -> tuple[DataFrame, DataFrame]:
    """(new ledger rows for the unpacked files, status changes for the archives): an archive has failed if a member of it has."""
    name = F.element_at(F.split("path", "/"), -1)
    rows = done.filter(F.col("path").isNotNull()).select(
        name.alias("filename"), F.col("path").alias("filepath"), F.element_at(F.split(name, r"\."), -1).alias("format"), F.lit(S.PENDING).alias("status"), "etag",
        F.lit(landed_at).cast("timestamp").alias("last_modified"), "size",
    )
    return rows, done.groupBy(F.col("zip_path").alias("filepath")).agg(_status(F.max(F.col("error").isNotNull())).alias("status"))


def _status(failed: Column) -> Column:
    return F.when(failed, F.lit(S.UNZIP_FAILED)).otherwise(F.lit(S.INGESTED))

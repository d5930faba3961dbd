"""Landing and reading raw files: listing, checksums, CSV, JSON, XML and ZIP members.

Files are opened by executors only. The driver sees paths and distinct header lines, never contents. Checksums and
headers are read block by block where tasks can open the files (:mod:`fleetmart.sources.blocks`), else by Spark's readers.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart import schema as S
from fleetmart.functions.strings import decode_path, strip_scheme
from fleetmart.operators.ledger import new_files, select_files
from fleetmart.operators.project import canonical_name, decorate, quoted, unique_names, union_by_name
from fleetmart.sources import blocks as Bl

MICRO_BATCH = 50  # fixed value: files per ingest batch


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(name: Column) -> Column:
    return F.element_at(F.split(name, r"\."), -1)


def list_files(spark: SparkSession, directory: str, with_etag: bool = False, glob: str | None = None) -> DataFrame:
    """Recursive listing as ledger columns. Without the etag no file content is read (column pruning);
    the name glob reaches the scan. The etag comes from a column of whole files here: for files of any size take
    :func:`hashed` of the files that are wanted."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    raw = (reader.option("pathGlobFilter", glob) if glob else reader).load(directory)
    path = strip_scheme(decode_path(F.col("path")))
    return raw.select(
        file_name(path).alias("filename"),
        path.alias("filepath"),
        extension(file_name(path)).alias("format"),
        F.lit(S.PENDING).alias("status"),
        (F.sha2(F.col("content"), 256) if with_etag else F.lit(None).cast("string")).alias("etag"),
        F.col("modificationTime").alias("last_modified"),
        F.col("length").alias("size"),
    )


def hashed(spark: SparkSession, listing: DataFrame, directory: str) -> DataFrame:
    """A listing (without etags) with the SHA-256 of each file, read in blocks: files of any size."""
    if Bl.streamable([directory]):
        return Bl.with_digests(listing.drop("etag"), "filepath", "etag").select(*listing.columns)
    full = list_files(spark, directory, with_etag=True).select("filepath", "last_modified", "etag")
    return listing.drop("etag").join(full, ["filepath", "last_modified"]).select(*listing.columns)


def land(spark: SparkSession, directory: str, ledger: DataFrame, fmt: str, after: str, until: str, pattern: str | None = None, min_size: int = 0) -> DataFrame:
    """Ledger rows for files not seen before, in one lazy plan: listing, filter, anti join, and only then the hashes."""
    listed = list_files(spark, directory, glob=f"*.{fmt}")
    return hashed(spark, new_files(select_files(listed, pattern, min_size, after, until), ledger, fmt, after, until), directory)


def read_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Text lines with their file and block, in file order within a block."""
    return spark.read.text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_name").alias("name"),
    )


def header_lines(spark: SparkSession, paths: Sequence[str], line: int) -> DataFrame:
    """(path, header): line ``line`` (from 0) of every file, from the first blocks of the files. Where tasks can't open them, a
    text scan of all lines does it, each task of which passes on at most line+1 rows per file."""
    if Bl.streamable(paths):
        return Bl.heads(spark, paths, line).select("path", "header")
    first = read_lines(spark, paths).filter(F.col("block") == 0).withColumn("_i", F.monotonically_increasing_id())
    pos = F.row_number().over(Window.partitionBy("path").orderBy("_i"))
    return first.withColumn("_pos", pos).filter(F.col("_pos") <= line + 1).filter(F.col("_pos") == line + 1).select(
        decode_path(F.col("path")).alias("path"), F.rtrim(F.regexp_replace("value", "\r$", "")).alias("header")
    )


def pick_separator(header: Column, candidates: Sequence[str]) -> Column:
    """First candidate that gives more than one column; a single candidate is always accepted."""
    if len(candidates) == 1:
        return F.lit(candidates[0])
    return F.coalesce(*[F.when(F.contains(header, F.lit(c)), F.lit(c)) for c in candidates])


def without_first_lines(lines: DataFrame, n: int) -> DataFrame:
    """Drop the first ``n`` lines of every file. Lines arrive in order within a scan task and a file's first
    block lies in one task, so a running count per file is enough: no shuffle, Arrow batches only."""

    def skip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, int] = {}
        for b in batches:
            head = b["block"] == 0
            pos = b[head].groupby("path").cumcount()
            pos = pos + b.loc[head, "path"].map(lambda p: seen.get(p, 0))
            for p, k in b.loc[head, "path"].value_counts().items():
                seen[p] = seen.get(p, 0) + int(k)
            drop = pos[pos < n].index
            yield b.drop(index=drop)

    return lines.mapInPandas(skip, lines.schema) if n else lines


def csv_schema(header: str, sep: str, first_column: str | None = None) -> T.StructType:
    """All-string schema from a header line; unnamed and repeated columns get distinct names."""
    parts = next(csv.reader([header], delimiter=sep)) if len(sep) == 1 else header.split(sep)  # quoted names may hold the separator
    names = [h.strip().strip('"') for h in parts]
    names = [n or f"column_{i}" for i, n in enumerate(names)]
    if first_column:
        names[0] = first_column
    fields = [T.StructField(n, T.StringType()) for n in unique_names(names)]
    return T.StructType([*fields, T.StructField(S.CORRUPT_COLUMN, T.StringType())])


def parse_lines(lines: DataFrame, schema: T.StructType, sep: str) -> DataFrame:
    """CSV text lines to columns; other columns of ``lines`` are kept behind them."""
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT_COLUMN}
    row = F.from_csv("value", _ddl(schema), options)
    return lines.filter(F.trim("value") != "").withColumn("_row", row).select(
        "_row.*", *[quoted(c) for c in lines.columns if c not in ("value", *schema.names)]
    )


def _ddl(schema: T.StructType) -> str:
    return ", ".join("`" + f.name.replace("`", "``") + "` string" for f in schema)


def read_csv(
    spark: SparkSession, paths: Sequence[str], sep: str = ",", header_line: int = 0, skip_rows: int | None = None,
    first_column: str | None = None, **options,
) -> DataFrame:
    """Header-driven CSV reading, all columns as text, plus the corrupt-record column and the file columns.

    ``sep`` may list candidates (``",/;"``). Files are grouped by (separator, header): each group is read with its
    own header and the groups are united by name, so a column never lands under another one's name. When data
    starts right after a header on line 0, Spark's own reader is used (it can also read quoted line breaks);
    otherwise the first ``skip_rows`` lines are dropped and lines are parsed one by one.
    """
    candidates = sep.split("/") if "/" in sep else [sep]
    skip_rows = header_line + 1 if skip_rows is None else max(skip_rows, header_line + 1)
    heads = header_lines(spark, paths, header_line).withColumn("sep", pick_separator(F.col("header"), candidates))
    # file-list sized: paths have to come to the driver to be handed to the reader
    groups = heads.groupBy("sep", "header").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("sep", "header").collect()
    bad = [p for g in groups if g["sep"] is None for p in g["paths"]]
    if bad:
        raise ValueError(f"no separator of {candidates} splits the header of {bad[:5]}")
    if not groups:
        raise ValueError("no file has a header line")
    frames = []
    for g in groups:
        schema = csv_schema(g["header"], g["sep"], first_column)
        if header_line == 0 and skip_rows == 1:
            df = (
                spark.read.schema(schema)
                .options(header=True, sep=g["sep"], mode="PERMISSIVE", columnNameOfCorruptRecord=S.CORRUPT_COLUMN, enforceSchema=True, **options)
                .csv(list(g["paths"]))
                .withColumns({"_path": F.col("_metadata.file_path"), "_name": F.col("_metadata.file_name")})
            )
        else:
            lines = without_first_lines(read_lines(spark, g["paths"]), skip_rows)
            df = parse_lines(lines.select("value", F.col("path").alias("_path"), F.col("name").alias("_name")), schema, g["sep"])
        frames.append(df)
    return union_by_name(frames, ordered=True)


def read_json(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None, **options) -> DataFrame:
    """JSON documents (several lines each by default). Give a schema where it is known: it saves the inference pass."""
    r = spark.read.options(**{"multiLine": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT_COLUMN, **options})
    df = (r.schema(schema) if schema else r).json(list(paths))
    return _with_file(df)


def read_xml(spark: SparkSession, paths: Sequence[str], row_tag: str, schema: T.StructType | None = None, **options) -> DataFrame:
    """XML rows by tag; nested elements come back as JSON text."""
    r = spark.read.format("xml").options(**{"rowTag": row_tag, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT_COLUMN, **options})
    df = (r.schema(schema) if schema else r).load(list(paths))
    nested = (T.StructType, T.ArrayType)
    flat = [F.to_json(quoted(f.name)).alias(f.name) if isinstance(f.dataType, nested) else quoted(f.name) for f in df.schema]
    return df.select(*flat, F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias("_name"))


def _with_file(df: DataFrame) -> DataFrame:
    out = df.withColumns({"_path": F.col("_metadata.file_path"), "_name": F.col("_metadata.file_name")})
    if S.CORRUPT_COLUMN not in out.columns:
        out = out.withColumn(S.CORRUPT_COLUMN, F.lit(None).cast("string"))
    return out


def decorated(df: DataFrame, run_id: str, ingested_at: str) -> DataFrame:
    """Replace the raw file columns by the published metadata columns."""
    return decorate(df, run_id, ingested_at, name=F.col("_name"), path=F.col("_path")).drop("_name", "_path")


MEMBERS = T.StructType(
    [
        T.StructField("zip_path", T.StringType()),
        T.StructField("member", T.StringType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("error", T.StringType()),
    ]
)


def expand_zips(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Members of small ZIP files, each whole in a row; a broken archive gives one row with its error. For archives and
    members of any size: :func:`fleetmart.sources.blocks.members`, ``member_blocks`` and ``unpack``."""

    def unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for m in z.infolist():
                            if not m.is_dir():
                                yield pd.DataFrame([(path, m.filename, z.read(m), None)], columns=MEMBERS.names)
                except Exception as e:  # noqa: BLE001 - the error becomes the file's status
                    yield pd.DataFrame([(path, None, None, str(e)[: S.STATUS_LENGTH])], columns=MEMBERS.names)

    raw = spark.read.format("binaryFile").load(list(paths)).select(strip_scheme(decode_path(F.col("path"))).alias("path"), "content")
    return raw.mapInPandas(unzip, MEMBERS)


def member_ledger(members: DataFrame, landed_at: str) -> tuple[DataFrame, DataFrame]:
    """(new ledger rows for members, status changes for the archives)."""
    inside = F.concat(F.col("zip_path"), F.lit("!/"), F.col("member"))
    rows = members.filter(F.col("member").isNotNull()).select(
        file_name(F.col("member")).alias("filename"), inside.alias("filepath"), extension(F.col("member")).alias("format"),
        F.lit(S.PENDING).alias("status"), F.sha2("content", 256).alias("etag"), F.lit(landed_at).cast("timestamp").alias("last_modified"),
        F.length("content").cast("long").alias("size"),
    )
    changes = members.groupBy(F.col("zip_path").alias("filepath")).agg(
        F.when(F.max(F.col("error").isNotNull()), F.lit(S.UNZIP_FAILED)).otherwise(F.lit(S.INGESTED)).alias("status")
    )
    return rows, changes


def member_lines(members: DataFrame) -> DataFrame:
    """Text lines of members with their position; whole texts, split by the executors."""
    text = F.decode("content", "UTF-8")
    return members.filter(F.col("member").isNotNull()).select(
        F.concat(F.col("zip_path"), F.lit("!/"), F.col("member")).alias("_path"), file_name(F.col("member")).alias("_name"),
        F.posexplode(F.split(text, r"\r?\n")).alias("pos", "value"),
    )


def clean_names(df: DataFrame) -> DataFrame:
    """Canonical column names for a freshly read table, the file columns left as they are."""
    keep = ("_path", "_name")
    return df.toDF(*unique_names([c if c in keep else canonical_name(c) for c in df.columns]))


def snapshot(spark: SparkSession, path: str, limit: int | None = None, order: Sequence[str] = ()) -> DataFrame:
    """A saved table, or an ordered preview of it."""
    df = spark.read.parquet(path)
    if limit is None:
        return df
    return df.orderBy(*order).limit(limit) if order else df.limit(limit)


def tables(spark: SparkSession, base: str, names: Sequence[str]) -> Mapping[str, DataFrame]:
    """The configured set of source tables."""
    return {n: spark.read.option("mergeSchema", "true").parquet(f"{base}/{n}") for n in names}

r"""WARC archives written and read back as Spark jobs, with boundary-chain verification.

Writing: payloads of at least ``LEAST`` bytes that occur more than once are stored with the smallest id alone; the
other records revisit it. A record is one row of text whose rows end in ``\r\n\r\n``, so Spark's own text writer, with
its commit protocol, makes the archives on any file system.

Reading: a file is split at every occurrence of the magic line, also those inside payloads; the rows that result know
their file and block, and running sums of their lengths give every candidate's offset in the file. A candidate's header
tells where the record after it begins. From the start of the file this chain of successors holds exactly the true
records; it is followed by pointer jumping: within each block of the file first, in one task each, then over the
entry points of blocks, doubling the reach in each round. What the chain doesn't reach is payload, and goes back into
the record around it.

Defined results: page ids are whole numbers; a null payload is empty; pages with the same id get a record each, told apart by a number; empty
tables give empty tables; further columns are ignored; a file that ends within a record gives what is there; bytes
before a file's first record that are no record make the file unreadable and give no rows.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetmart.operators.settle import scratch_dir, settle

MAGIC = "WARC/1.0\r\n"
LEAST = 100


def _header(*lines: tuple[str, Column]) -> Column:
    return F.concat_ws("\r\n", *(F.concat(F.lit(f"{name}: "), value) for name, value in lines))


def records(pages: DataFrame, id: str = "page_id", url: str | None = "url", payload: str = "html", least: int = LEAST) -> DataFrame:
    """One row ``value`` for each page: its WARC record without the closing line breaks."""
    rows = pages.select(
        F.col(id).cast("long").alias("id"), (F.regexp_replace(F.coalesce(F.col(url).cast("string"), F.lit("")), r"[\r\n]", "") if url else F.lit("")).alias("url"),
        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"),
    )
    rows = rows.withColumns({"digest": F.sha2(F.col("payload").cast("binary"), 256), "bytes": F.octet_length("payload")})
    large = rows.filter(F.col("bytes") >= least).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    rows = rows.join(large.withColumnRenamed("digest", "_digest").hint("merge"), F.col("digest") == F.col("_digest"), "left")
    revisit = F.coalesce((F.col("bytes") >= least) & (F.col("id") > F.col("first")), F.lit(False))
    shared = [("WARC-Target-URI", F.col("url")), ("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">"))), ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))), ("X-Payload-Length", F.col("bytes").cast("string"))]
    full = F.concat(_header(("WARC-Type", F.lit("response")), *shared, ("Content-Type", F.lit("text/html")), ("Content-Length", F.col("bytes").cast("string"))), F.lit("\r\n\r\n"), F.col("payload"))
    again = F.concat(_header(("WARC-Type", F.lit("revisit")), *shared, ("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">"))), ("Content-Length", F.lit("0"))), F.lit("\r\n\r\n"))
    return rows.select(F.concat(F.lit(MAGIC), F.when(revisit, again).otherwise(full)).alias("value"))


def write(pages: DataFrame, path: str, id: str = "page_id", url: str | None = "url", payload: str = "html", least: int = LEAST, **options: str) -> None:
    """The pages as WARC archives below ``path``; options go to the writer (``compression="gzip"`` for one)."""
    records(pages, id, url, payload, least).write.options(lineSep="\r\n\r\n", **options).mode("overwrite").text(path)


# reading --------------------------------------------------------------------------------------------------------

SPLIT = len(MAGIC)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every stretch of a file that follows a magic line: its file, block, running number, and bytes. The first row
    of a file is what precedes its first magic line. Block and number depend on how this scan is laid out: they hold in
    one settled copy, and no second scan need agree with them."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"), F.col("value").cast("binary").alias("body")
    )


def parsed(bodies: DataFrame) -> DataFrame:
    """``header``, ``header_bytes`` and ``payload`` of each body, ``payload_bytes`` as the header says (null: it doesn't).
    A header ends at the first empty line, however long its fields are."""
    head = F.substring_index(F.col("body").cast("string"), "\r\n\r\n", 1)
    rows = bodies.withColumn("header", head).withColumn("header_bytes", F.octet_length("header"))
    rows = rows.withColumn("content_length", F.regexp_extract("header", r"(?m)^Content-Length: *(\d{1,15})\r?$", 1).try_cast("long"))
    return rows.withColumn("payload", F.expr("substring(body, header_bytes + 5, cast(least(content_length, 2147483647) as int))"))


def offsets(rows: DataFrame) -> DataFrame:
    """(file, block, n, length, head) with ``at``, the offset of each candidate's magic line in its file: the running
    sum of what lies before it in its block, on top of the sums of the blocks before."""
    in_block = Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("file", "block").agg(F.sum(F.col("length") + SPLIT).alias("whole")).select("file", "block", F.coalesce(F.sum("whole").over(before), F.lit(0)).alias("base"))
    inside = rows.withColumn("inner", F.coalesce(F.sum(F.col("length") + SPLIT).over(in_block), F.lit(0)))
    return inside.join(sums, ["file", "block"]).withColumn("at", F.col("base") + F.col("inner") - SPLIT).drop("base", "inner")


def _exits(key: tuple, rows: pa.Table) -> pa.Table:
    """For the candidates of a block: the first place of their chain outside the block (pointer jumping within)."""
    order = np.argsort(rows.column("at").to_numpy())
    at, to = rows.column("at").to_numpy()[order], rows.column("to").to_numpy()[order]
    while True:
        where = np.minimum(np.searchsorted(at, to), len(at) - 1)
        inside = at[where] == to
        if not inside.any():
            break
        to = np.where(inside, to[where], to)
    return pa.table({"file": pa.array([key[0].as_py()] * len(at)), "block": pa.array([key[1].as_py()] * len(at), pa.int64()), "at": at, "exit": to})


def _reached(key: tuple, rows: pa.Table) -> pa.Table:
    """The candidates of a block that its entry leads to."""
    order = np.argsort(rows.column("at").to_numpy())
    at, to = rows.column("at").to_numpy()[order], rows.column("to").to_numpy()[order]
    good = rows.column("entry").to_numpy()[order] == at
    reach = to.copy()
    for _ in range(max(1, len(at).bit_length())):  # reached so far, and where a doubled number of steps leads
        where = np.minimum(np.searchsorted(at, reach), len(at) - 1)
        inside = at[where] == reach
        good[where[good & inside]] = True
        reach = np.where(inside, reach[where], reach)
    return pa.table({"file": pa.array([key[0].as_py()] * int(good.sum())), "at": at[good]})


def chain(marked: DataFrame) -> DataFrame:
    """From (file, block, at, to) the (file, at) that the chain from offset 0 reaches."""
    exits = settle(marked.groupBy("file", "block").applyInArrow(_exits, "file string, block long, at long, exit long"))
    # entry points: candidates that a chain of another block leads to, and the starts of files
    heads = exits.select("file", F.col("exit").alias("at")).union(exits.filter("at = 0").select("file", "at")).distinct()
    jump = settle(exits.join(heads, ["file", "at"]).select("file", "block", "at", "exit"))
    reached = jump.filter("at = 0").select("file", "at")
    step = jump.select("file", "at", "exit")
    rounds = max(1, (jump.groupBy("file").agg(F.countDistinct("block").alias("n")).agg(F.max("n")).first()[0] or 0).bit_length())
    for _ in range(rounds):
        ahead = step.join(reached, ["file", "at"]).select("file", F.col("exit").alias("at"))
        reached = settle(reached.union(ahead).distinct())
        further = step.select("file", F.col("at").alias("exit"), F.col("exit").alias("beyond"))
        step = settle(step.join(further, ["file", "exit"], "left").select("file", "at", F.coalesce("beyond", "exit").alias("exit")))
    entries = jump.join(reached, ["file", "at"]).select("file", "block", F.col("at").alias("entry"))
    return marked.join(entries, ["file", "block"]).groupBy("file", "block").applyInArrow(_reached, "file string, at long")


def read(spark: SparkSession, path: str, **columns: Column) -> DataFrame:
    """Per record: ``file``, ``at``, ``header`` (text) and ``payload`` (bytes), or instead of the payload what
    ``columns`` make of it, so that it needn't be kept."""
    columns = columns or {"payload": F.col("payload")}
    bodies = candidates(spark, path)
    mark = F.unhex(F.sha2("body", 256))  # names a stretch whatever the layout of the scan that finds it
    rows = parsed(bodies).select("file", "block", "n", F.octet_length("body").cast("long").alias("length"), mark.alias("mark"), "header", "header_bytes", "content_length", *(c.alias(k) for k, c in columns.items()))
    placed = settle(offsets(settle(rows)))
    to = F.coalesce(F.col("at") + SPLIT + F.col("header_bytes") + 4 + F.col("content_length") + 4, F.lit(-1))
    true = chain(placed.filter("at >= 0").select("file", "block", "at", to.alias("to")))
    owners = placed.select("file", "at", "mark").join(true.withColumn("true_at", F.col("at")), ["file", "at"], "left")
    inside = settle(owners.filter("true_at IS NULL AND at >= 0").select("file").distinct())
    kept = placed.join(true, ["file", "at"])
    if inside.isEmpty():
        return kept.select("file", "at", "header", *columns)
    # the magic line occurs inside payloads: in these files each stretch is joined to the record around it
    along = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    mixed = owners.join(inside, "file").withColumn("owner", F.last("true_at", ignorenulls=True).over(along)).filter("owner IS NOT NULL")
    several = mixed.groupBy("file", "owner").agg(F.count(F.lit(1)).alias("parts")).filter("parts > 1").drop("parts")
    parts = settle(mixed.join(several, ["file", "owner"]).select("file", "at", "mark", "owner"))
    found = bodies.select(mark.alias("mark"), "body").join(parts.select("mark"), "mark", "left_semi").dropDuplicates(["mark"])
    held = parts.join(found, "mark").groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("at", "body"))).alias("held"))
    joined = F.expr(f"unhex(array_join(transform(held, x -> hex(x.body)), '{MAGIC.encode().hex().upper()}'))")
    whole = parsed(held.select("file", F.col("owner").alias("at"), joined.alias("body"))).select("file", "at", "header", *(c.alias(k) for k, c in columns.items()))
    return kept.join(parts.select("file", F.col("owner").alias("at")).distinct(), ["file", "at"], "left_anti").select("file", "at", "header", *columns).unionByName(whole)


def field(name: str, pattern: str) -> Column:
    """A header field's value by its pattern; null where there is none."""
    return F.nullif(F.regexp_extract("header", rf"(?m)^{name}: {pattern}\r?$", 1), F.lit(""))


def pages(spark: SparkSession, path: str) -> DataFrame:
    """Per record of the archives: ``page_id``, bytes and digest of the full payload, type, and the page it refers to.
    For a response both are of the payload as read."""
    found = read(spark, path, read_bytes=F.octet_length("payload").cast("long"), read_digest=F.sha2("payload", 256))
    response = field("WARC-Type", r"(\w+)") == "response"
    return found.select(
        field("WARC-Record-ID", "<urn:page:(-?[0-9]*)>").cast("long").alias("page_id"),
        F.when(response, F.col("read_bytes")).otherwise(field("X-Payload-Length", r"(\d+)").cast("long")).alias("payload_bytes"),
        F.when(response, F.col("read_digest")).otherwise(field("WARC-Payload-Digest", "sha256:([0-9a-f]+)")).alias("payload_digest"),
        field("WARC-Type", r"(\w+)").alias("record_type"),
        field("WARC-Refers-To", "<urn:page:(-?[0-9]+)>").cast("long").alias("refers_to"),
    )


def archive(source: DataFrame, **options: str) -> str:
    """Archives of the pages in a new folder of the shared scratch space; its path."""
    path = f"{scratch_dir(source.sparkSession)}/warc-{uuid.uuid4().hex}"
    write(source, path, **options)
    return path

"""Load ledger: which files were landed, which failed and why, and which may be deleted.

A load lists the source folder, leaves out what earlier loads landed, tries the rest, and writes one ledger row
per file. Every step can be repeated: a file's rows replace themselves in the raw zone (``land_files``), a load's
ledger rows replace themselves, and files are deleted only after their ledger rows are written.

Ledger columns: file (path), size, modified, state (loaded, failed, deleted), reason, rows; partition ``load``.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.operators.landing import BATCH_COLUMN, batch_of, land_files
from shoplake.sources.raw import unread_files

LEDGER = "file string, size long, modified timestamp, state string, reason string, rows long, load string"
LOADED, FAILED, DELETED = "loaded", "failed", "deleted"
UNREADABLE, NO_TIME, NO_ROWS = "unreadable", "no time in the first line", "no rows"


def list_files(spark: SparkSession, src: str, glob: str) -> DataFrame:
    """file, size, modified of the files below ``src``, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(src)
    return files.select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"),
                        F.col("modificationTime").alias("modified"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All ledger rows; none if no load was recorded yet."""
    reader = spark.read.schema(LEDGER)
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e.getCondition()):
            raise
        return spark.createDataFrame([], LEDGER)


def pending_files(spark: SparkSession, src: str, ledger: str, glob: str, load_id: str = "") -> DataFrame:
    """Listed files that no load but ``load_id`` has landed as they are now. A failed file is tried again; a file
    with another size or time than the landed one is a new file."""
    done = read_ledger(spark, ledger).where((F.col("state") == LOADED) & (F.col("load") != load_id))
    done = done.select("file", "size", "modified").distinct()
    return list_files(spark, src, glob).join(done, ["file", "size", "modified"], "left_anti")


def load(spark: SparkSession, src: str, dst: str, ledger: str, load_id: str, glob: str = "*.json*",
         delete: bool = False) -> DataFrame:
    """A14 (+ A13): land the pending files of ``src`` and record each one's outcome; the load's ledger rows.

    A file that cannot be read to its end, holds no line, or has no time in its first line fails and the others
    carry on. With ``delete`` the landed files are removed afterwards (``delete_loaded``). Repeating a
    ``load_id`` lands its files again in place and replaces their ledger rows.
    """
    path, listing, staged = f"{ledger}/load={load_id}", f"{ledger}/_listed-{load_id}", f"{ledger}/_staged-{load_id}"
    # The listing is fixed first: what arrives during the load is the next load's.
    pending_files(spark, src, ledger, glob, load_id).write.mode("overwrite").parquet(listing)
    seen = spark.read.schema("file string, size long, modified timestamp").parquet(listing)
    earlier = read_ledger(spark, ledger).where(F.col("load") == load_id).drop("load").join(seen, "file", "left_anti")
    # Spark's reader needs the files' names on the driver, as it would for a folder's listing.
    names = [r["file"] for r in seen.select("file").toLocalIterator()]
    broken = [r["path"] for r in unread_files(spark, [unquote(n) for n in names if n.endswith(".gz")]).toLocalIterator()]
    readable = [unquote(n) for n in sorted(set(names) - set(broken))]
    outcome = _outcomes(spark, readable, dst) if readable else None
    unreadable = spark.createDataFrame([(n,) for n in broken], "file string").select(
        "file", F.lit(FAILED).alias("state"), F.lit(UNREADABLE).alias("reason"), F.lit(0).cast("long").alias("rows"))
    found = unreadable if outcome is None else unreadable.unionByName(outcome)
    rows = (seen.select("file", "size", "modified").join(found, "file", "left")
            .withColumn("reason", F.when(F.col("state").isNull(), NO_ROWS).otherwise(F.col("reason")))
            .withColumn("state", F.coalesce("state", F.lit(FAILED))).withColumn("rows", F.coalesce("rows", F.lit(0).cast("long"))))
    rows.unionByName(earlier).write.mode("overwrite").parquet(staged)
    spark.read.schema(LEDGER).parquet(staged).drop("load").write.mode("overwrite").parquet(path)
    if delete:
        delete_loaded(spark, dst, ledger, load_id)
    return spark.read.schema(LEDGER).parquet(ledger).where(F.col("load") == load_id)


def _outcomes(spark: SparkSession, files: list[str], dst: str) -> DataFrame:
    """file, state, reason, rows of the files that hold lines, from the landing's manifest."""
    try:
        manifest = land_files(spark, files, dst, glob="*", route="file_first", by_path=True)
    except FileNotFoundError:  # no line in any of them
        return spark.createDataFrame([], "file string, state string, reason string, rows long")
    landed = F.col("status") == "landed"
    return manifest.select("file", F.when(landed, LOADED).otherwise(FAILED).alias("state"),
                           F.when(~landed, NO_TIME).alias("reason"), F.when(landed, F.col("rows")).otherwise(0).alias("rows"))


def delete_loaded(spark: SparkSession, dst: str, ledger: str, load_id: str) -> DataFrame:
    """Remove a load's landed files once all their rows can be read from the raw zone; what was removed.

    The rows of each file's folder in the zone are counted and held against the ledger; a file whose rows are
    not all there, or which has changed since it was listed, stays. Tasks remove the files, and a
    file that is gone already counts as removed, so that a retried task or load changes nothing.
    """
    loaded = spark.read.schema(LEDGER).parquet(ledger).where((F.col("load") == load_id) & (F.col("state") == LOADED))
    batch = F.regexp_extract(F.col("_metadata.file_path"), f"/{BATCH_COLUMN}=([^/]*)/", 1)
    readable = spark.read.text(dst).groupBy(batch.alias("batch")).agg(F.count(F.lit(1)).alias("readable"))
    checked = (loaded.withColumn("batch", batch_of(F.col("file"))).join(readable, "batch")
               .where(F.col("readable") == F.col("rows")).select("file", "size", F.unix_millis("modified").alias("modified"), "rows"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [r for r in b.to_pylist() if _removed(r["file"], r["size"], r["modified"])]
            yield pa.RecordBatch.from_pylist([{"file": r["file"], "rows": r["rows"]} for r in rows],
                                             schema=pa.schema([("file", pa.string()), ("rows", pa.int64())]))

    gone = checked.repartition("file").mapInArrow(remove, "file string, rows long")
    path = f"{ledger}/load={load_id}-deleted"
    gone.select("file", F.lit(None).cast("long").alias("size"), F.lit(None).cast("timestamp").alias("modified"),
                F.lit(DELETED).alias("state"), F.lit(None).cast("string").alias("reason"), "rows").write.mode("overwrite").parquet(path)
    return spark.read.schema(LEDGER).parquet(ledger).where(F.col("load") == f"{load_id}-deleted")


def _removed(file: str, size: int, modified: int) -> bool:
    """Remove an unchanged file; whether it is gone."""
    system, path = pafs.FileSystem.from_uri(file)
    info = system.get_file_info(path)
    if info.type == pafs.FileType.NotFound:
        return True
    if info.size != size or (info.mtime_ns is not None and info.mtime_ns // 1_000_000 != modified):
        return False
    try:
        system.delete_file(path)
    except FileNotFoundError:
        pass
    return True

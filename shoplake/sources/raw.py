"""Readers of the raw JSON zone and the curated Parquet zone.

The raw zone holds JSON lines, plain or gzip (the reader picks the codec from the extension), in
Hive-style ``year=/month=/day=/hour=`` directories. It is read with an explicit schema: no inference
pass over the data, keys missing from older files come back as null columns, and a line that is not
valid JSON is kept whole in ``_corrupt_record`` instead of failing the job or being dropped silently.
Partition values stay zero-padded strings (type inference of partition columns is switched off).
"""

from __future__ import annotations

import datetime as dt
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.schema import CORRUPT_COLUMN, CURATED_COLUMNS, CURATED_PARTITIONS, EVENT_COLUMNS, RAW_SCHEMA
from shoplake.session import configure


def _date_range(df: DataFrame, start_date, end_date) -> DataFrame:
    """Inclusive date range as predicates on the padded string partitions (partition pruning)."""
    if start_date is None and end_date is None:
        return df
    date_key = F.concat_ws("-", *[F.col(p) for p in CURATED_PARTITIONS])
    if start_date is not None:
        df = df.where(date_key >= F.lit(str(start_date)))
    if end_date is not None:
        df = df.where(date_key <= F.lit(str(end_date)))
    return df


def read_raw(spark: SparkSession, path: str, glob: str | None = None, start_date: dt.date | str | None = None,
             end_date: dt.date | str | None = None, skip_unreadable_files: bool = False) -> DataFrame:
    """Raw zone -> 12 event columns, ``_corrupt_record`` and the path's partition columns.

    A date range reads only the matching ``year=/month=/day=`` directories (a daily load reads
    one day of the zone, not all of it). A bad line never fails the read (it lands in
    ``_corrupt_record``); a file that cannot be read to its end (a broken gzip stream) does, unless
    ``skip_unreadable_files``: then the load goes on without any row of such files, and
    ``unread_files`` names them. That costs a pass that decompresses the gzip files.
    """
    configure(spark)
    reader = (spark.read.schema(RAW_SCHEMA)
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT_COLUMN))
    if skip_unreadable_files:
        reader = reader.option("ignoreCorruptFiles", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    raw = _date_range(reader.json(path), start_date, end_date)
    if skip_unreadable_files:
        names = raw.columns
        failed = unread_files(spark, path, glob).withColumnRenamed("path", "_file")
        raw = raw.withColumn("_file", F.col("_metadata.file_path")).join(failed, "_file", "left_anti").select(*names)
    return raw


def read_raw_text(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Raw zone as text lines (``value``) plus partition columns and the source file.

    Needed where the difference between an absent key and a null value matters: typed reads map
    both to null.
    """
    configure(spark)
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).withColumn("source_file", F.col("_metadata.file_path"))


def read_curated(spark: SparkSession, path: str, start_date: dt.date | str | None = None,
                 end_date: dt.date | str | None = None, columns: list[str] | None = None,
                 merge_schema: bool = False) -> DataFrame:
    """Curated zone -> the 15 curated columns, optionally limited to an inclusive date range.

    The range turns into predicates on the padded string partition columns, which Spark applies as
    partition filters: directories outside the range are never listed or opened. With
    ``merge_schema`` the footers of all files are merged, for tables whose older files lack
    newer columns (a missing column reads as null either way when ``columns`` names it).
    """
    configure(spark)
    reader = spark.read.option("mergeSchema", "true") if merge_schema else spark.read
    df = _date_range(reader.parquet(path), start_date, end_date)
    return df.select(*(columns or CURATED_COLUMNS))


def parse_events(df: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text records (a message stream's payload, a text column) -> raw event columns.

    Same rules as the file reader: explicit schema, PERMISSIVE mode, and a record that is not valid
    JSON kept whole in ``_corrupt_record``. Other columns of ``df`` are carried along.
    """
    parsed = F.from_json(F.col(value_col).cast("string"), RAW_SCHEMA,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})
    others = [c for c in df.columns if c != value_col]
    return df.select(*others, parsed.alias("_event")).select(*others, "_event.*")


def to_json_events(df: DataFrame, keep_null_fields: bool = True) -> DataFrame:
    """Event columns -> one JSON text per record in ``value`` (null values kept as JSON null)."""
    cols = [c for c in EVENT_COLUMNS if c in df.columns]
    opts = {"ignoreNullFields": "false" if keep_null_fields else "true"}
    return df.select(F.to_json(F.struct(*cols), opts).alias("value"))


def register_views(spark: SparkSession, raw_path: str | None = None, curated_path: str | None = None,
                   quarantine_path: str | None = None) -> list[str]:
    """Expose the zones to Spark SQL as temporary views ``raw``, ``curated`` and ``quarantine``.

    The views are lazy scans with the readers' rules (explicit raw schema, padded partitions), so
    SQL over them gets the same pruning and pushdown as the DataFrame functions.
    """
    names = []
    if raw_path:
        read_raw(spark, raw_path).createOrReplaceTempView("raw")
        names.append("raw")
    if curated_path:
        read_curated(spark, curated_path).createOrReplaceTempView("curated")
        names.append("curated")
    if quarantine_path:
        spark.read.parquet(quarantine_path).createOrReplaceTempView("quarantine")
        names.append("quarantine")
    return names


def unread_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Gzip files under ``path`` (a folder, or a list of files) that do not decompress to their end: ``path``.

    The files are listed, not read, by Spark; each is then decompressed in a task as a stream, piece by piece, so
    its size does not matter.
    """
    def broken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad = [p for p in batch.column(0).to_pylist() if not _whole_gzip(p)]
            yield pa.RecordBatch.from_arrays([pa.array(bad, pa.string())], names=["path"])

    if isinstance(path, list) and not path:
        return spark.createDataFrame([], "path string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob or "*.gz")
    listed = files.load(path).where(F.col("path").endswith(".gz"))
    return listed.select(F.col("_metadata.file_path").alias("path")).mapInArrow(broken, "path string")


def _whole_gzip(file: str, piece: int = 1 << 20) -> bool:
    """Whether the file (URI) holds gzip members that decompress to their end."""
    system, path = pafs.FileSystem.from_uri(file)
    member, ended = zlib.decompressobj(31), False
    try:
        with system.open_input_stream(path, compression=None) as stream:
            while taken := stream.read(piece):
                while taken:
                    if ended:
                        member, ended = zlib.decompressobj(31), False
                    member.decompress(taken, piece)
                    ended = member.eof
                    taken = member.unused_data if ended else member.unconsumed_tail
    except zlib.error:
        return False
    return ended

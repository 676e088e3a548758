"""Batch landing into the raw zone.

Two entry points:

* ``land_batch`` takes event records, cuts them into hour-aligned N-minute event-time batches and
  writes them as JSON lines under ``year=/month=/day=/hour=/batch=``. Windows never cross an hour,
  so a batch's hour is every one of its rows' hours.
* ``land_files`` lands existing JSON-lines files unchanged. With ``route="file_first"`` the hour of
  a file's *first* line decides the partition of the whole file; with ``route="row"`` each line
  goes to its own hour. The first line is found without reading a file into one row: it is the
  smallest row id within the split that starts at byte 0 of the file.

Both return a manifest ``(source, target, rows)`` (``land_files`` adds a ``status``, landed or
failed); with ``dry_run=True`` nothing is written.

Re-runs can be idempotent. Every load (``land_batch``: its ``load_id``; ``land_files``: each file's
name) is its own ``batch=`` directory below the hour, written with dynamic partition overwrite.
Landing the same load again replaces exactly that load, as putting an object under the same key
does, and leaves every other load of the hour in place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.functions import event_time, parse_ts_ntz, partition_key, window_key, window_start
from shoplake.schema import EVENT_COLUMNS, RAW_PARTITIONS
from shoplake.sources.sinks import write_partitioned, write_raw_json

# Partition below the hour naming one landed load or file.
BATCH_COLUMN = "batch"


def _parts(ts) -> list:
    return [F.date_format(ts, "yyyy").alias("year"), F.date_format(ts, "MM").alias("month"),
            F.date_format(ts, "dd").alias("day"), F.date_format(ts, "HH").alias("hour")]


def batch_manifest(df: DataFrame, minutes: int = 5, prefix: str = "raw") -> DataFrame:
    """Per event-time batch: ``source`` file name, ``target`` object key and ``rows``."""
    start = window_start(event_time(df), minutes)
    per_batch = (df.select(start.alias("window_start"))
                 .groupBy("window_start").agg(F.count(F.lit(1)).alias("rows")))
    source = F.concat(F.lit("events_"), window_key("window_start"), F.lit(".jsonl"))
    return per_batch.select(
        source.alias("source"),
        partition_key("window_start", source, prefix).alias("target"),
        "rows",
    )


def land_batch(df: DataFrame, path: str, minutes: int = 5, prefix: str = "raw", dry_run: bool = False,
               compression: str | None = None, keep_null_fields: bool = True,
               load_id: str | None = None) -> DataFrame:
    """A6 + A11: events -> raw JSON zone partitioned by the hour of their batch; returns the manifest.

    Rows land under ``hour=HH/batch=<load_id>``. A stable ``load_id`` makes a re-run replace its
    own earlier output; by default each call gets a fresh id (plain append). The manifest of a real
    load also has ``location``, the folder below ``path`` that holds a batch's rows: all batches of an
    hour share it, and rows without a time are in the default partition, as ``location`` says.
    """
    manifest = batch_manifest(df, minutes, prefix)
    if not dry_run:
        start = window_start(event_time(df), minutes)
        load = load_id or uuid.uuid4().hex[:16]
        hour = F.try_to_timestamp(F.regexp_extract("source", r"(\d{8}_\d{2})", 1), F.lit("yyyyMMdd_HH"))
        parts = [F.concat(F.lit(f"{c}="), F.coalesce(v, F.lit("__HIVE_DEFAULT_PARTITION__")))
                 for c, v in zip(RAW_PARTITIONS, _parts(hour), strict=True)]
        manifest = manifest.withColumn("location", F.concat_ws("/", *parts, F.lit(f"{BATCH_COLUMN}={load}")))
        out = df.select(*EVENT_COLUMNS, *_parts(start), F.lit(load).alias(BATCH_COLUMN))
        # A fresh id matches no existing directory, so a plain append is the same and skips the
        # staging and renames of a dynamic overwrite; a caller's id may repeat, so it overwrites.
        write_raw_json(out, path, [*RAW_PARTITIONS, BATCH_COLUMN], compression=compression,
                       keep_null_fields=keep_null_fields, mode="incremental" if load_id else "append")
    return manifest


def batch_of(file: Column) -> Column:
    """Folder of a file's rows: its name without extension, and a hash of its path."""
    name = F.regexp_replace(F.element_at(F.split(file, "/"), -1), r"\.[^.]*$", "")
    return F.concat(name, F.lit("-"), F.substring(F.sha2(file, 256), 1, 12))


def land_files(spark: SparkSession, src: str | list[str], dst: str, glob: str = "*.jsonl", route: str = "file_first",
               prefix: str = "raw", dry_run: bool = False, by_path: bool = False) -> DataFrame:
    """A6 + A11 + A12 + E3: existing JSON-lines files (a folder, or a list of files) -> raw zone, lines unchanged.

    With ``by_path`` files are told apart by their whole path, also in the name of their folder, and the
    manifest has their path as ``file``.

    Raises if no file matches ``glob`` under ``src`` (the reader refuses an empty input).
    """
    if route not in ("file_first", "row"):
        raise ValueError("route must be 'file_first' or 'row'")
    lines = (spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(src)
             .select("value",
                     F.col("_metadata.file_path").alias("file_path"),
                     F.col("_metadata.file_name").alias("source"),
                     F.col("_metadata.file_block_start").alias("block_start"),
                     F.monotonically_increasing_id().alias("row_id"))
             .where(F.trim("value") != F.lit("")))
    if lines.isEmpty():
        raise FileNotFoundError(f"no non-empty file matching {glob!r} under {src}")
    ts = parse_ts_ntz(F.get_json_object("value", "$.timestamp"))
    if route == "row":
        routed = lines.select("value", "source", "file_path", *_parts(ts))
    else:
        first = (lines.where(F.col("block_start") == 0)
                 .groupBy("file_path")
                 .agg(F.min_by(F.struct(ts.alias("ts")), F.col("row_id")).alias("first")))
        first = first.select("file_path", F.col("first.ts").alias("first_ts"))
        routed = lines.join(first, "file_path", "left").select("value", "source", "file_path", *_parts(F.col("first_ts")))
    # A line (row route) or file (first-line route) without a parseable time cannot be routed: it is
    # reported as failed and not landed, and the other inputs carry on.
    landed = F.col("hour").isNotNull()
    key = F.format_string("%s/year=%s/month=%s/day=%s/hour=%s/%s", F.lit(prefix), "year", "month", "day",
                          "hour", "source")
    file = ["file_path"] if by_path else []
    manifest = (routed.groupBy("source", *file, *RAW_PARTITIONS).agg(F.count(F.lit(1)).alias("rows"))
                .select("source", *[F.col(f).alias("file") for f in file], F.when(landed, key).alias("target"), "rows",
                        F.when(landed, F.lit("landed")).otherwise(F.lit("failed")).alias("status")))
    if not dry_run:
        batch = F.regexp_replace("source", r"\.[^.]*$", "")  # the file name without its extension
        if by_path:
            batch = batch_of(F.col("file_path"))
        write_partitioned(routed.where(landed).select("value", *RAW_PARTITIONS, batch.alias(BATCH_COLUMN)), dst,
                          [*RAW_PARTITIONS, BATCH_COLUMN], "text", "incremental")
    return manifest

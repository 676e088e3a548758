"""Registered queries: name -> (spark, sf_dir) -> DataFrame, each over the whole driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplake.functions import partition_key, window_key, window_start
from shoplake.operators import analytics as A
from shoplake.operators import catalog as C
from shoplake.operators import compaction as K
from shoplake.operators import ops as O
from shoplake.operators import quality as Q
from shoplake.operators import ledger as L
from shoplake.operators.etl import quarantine_by_reason, read_rejected
from shoplake.operators.landing import land_batch, land_files
from shoplake.plans.oracle import AUDIT_AS_OF, NESTED_RULES
from shoplake.plans.zones import build_defective_zones, build_zones, defective_zone, land_raw_zone
from shoplake.schema import (
    CATEGORIES,
    CORRUPT_COLUMN,
    CURATED_COLUMNS,
    CURATED_PARTITIONS,
    EVENT_COLUMNS,
    EVENT_SCHEMA,
    RAW_PARTITIONS,
)
from shoplake.session import configure, scratch_dir
from shoplake.sources.adapter import MARKET_SEGMENTS, curated_events, read_table
from shoplake.sources.raw import read_curated, read_raw, read_raw_text
from shoplake.sources.sinks import write_curated, write_partitioned, write_result_csv
from shoplake.streaming import buffers
from shoplake.streaming import jobs as S

Query = Callable[[SparkSession, str], DataFrame]


def curated(spark: SparkSession, sf_dir: str, with_event_ts: bool = False) -> DataFrame:
    configure(spark)
    return curated_events(spark, sf_dir, with_event_ts)


def _on_curated(fn: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(curated(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _partition_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = curated(spark, sf_dir, with_event_ts=True)
    ts = F.col("event_ts")
    file_name = F.concat(F.lit("events_"), window_key(window_start(ts, 5)), F.lit(".jsonl"))
    return df.select("event_id", partition_key(ts, file_name, "raw").alias("partition_key"))


def _null_sessions(df: DataFrame) -> DataFrame:
    """Every eleventh event, and all events of one category, without a session."""
    gap = (F.col("event_id").cast("bigint") % 11 == 0) | F.coalesce(F.col("category") == CATEGORIES[0], F.lit(False))
    return df.withColumn("session_id", F.when(~gap, F.col("session_id")))


ANALYTICS: dict[str, Query] = {
    "event_type_counts": _on_curated(A.event_type_counts),
    "funnel_by_category": _on_curated(A.funnel_by_category),
    "funnel_overall": _on_curated(A.funnel_overall),
    "revenue_by_country_device": _on_curated(A.revenue_by_country_device),
    "session_stats": _on_curated(A.session_stats),
    "session_engagement": _on_curated(A.session_engagement),
    "revenue_trend": _on_curated(A.revenue_trend),
    "revenue_trend_dated": _on_curated(A.revenue_trend_dated),
    "curated_row_count": _on_curated(A.row_count),
    # A list shorter than the data's: the other segments' revenue is in "other".
    "revenue_pivot": _on_curated(lambda df: A.revenue_pivot(df, MARKET_SEGMENTS[:3])),
    "abandoned_cart_products": _on_curated(A.abandoned_cart_products),
    "abandoned_cart_null_session": _on_curated(lambda df: A.abandoned_cart_products(_null_sessions(df))),
    "funnel_null_session": _on_curated(lambda df: A.funnel_by_category(_null_sessions(df)).select(
        "category", "viewed_sessions", "purchased_sessions")),
    "events_per_5min": _on_curated(lambda df: A.events_per_window(df, 5)),
    # 7 does not divide 60: windows restart every hour (:00, :07, ... :56), unlike epoch-aligned ones.
    "events_per_7min": _on_curated(lambda df: A.events_per_window(df, 7)),
    "partition_key": _partition_key,
}


def _table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


# --- batch path: landing, ETL, sinks, catalog -------------------------------------------------------

def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A3: the landed raw zone read back whole: 12 event fields, corrupt-record column, partitions."""
    zones = land_raw_zone(spark, sf_dir)
    return read_raw(spark, zones.raw).select(*EVENT_COLUMNS, CORRUPT_COLUMN, *RAW_PARTITIONS)


def raw_landing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A6: land the events by hour, read the zone back, count rows per hour partition."""
    zones = land_raw_zone(spark, sf_dir)
    return read_raw(spark, zones.raw).groupBy(*RAW_PARTITIONS).agg(F.count(F.lit(1)).alias("event_count"))


def file_landing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 + A12 + E3: JSON files of six hours each, landed whole by the hour of their first line; rows per hour."""
    files, landed = scratch_dir(spark, "six-hours"), scratch_dir(spark, "raw-files")
    df = curated(spark, sf_dir, with_event_ts=True)
    block = F.concat(F.date_format("event_ts", "yyyyMMdd"), F.lit("-"), F.floor(F.hour("event_ts") / 6))
    # A block's rows are one file, in time order: what a generator's batch would hand over.
    (df.withColumn("block", block).repartition("block").sortWithinPartitions("block", "event_ts")
     .select("block", *EVENT_COLUMNS).write.partitionBy("block").json(files))
    land_files(spark, files, landed, glob="*.json", route="file_first")
    return read_raw(spark, landed).groupBy(*RAW_PARTITIONS).agg(F.count(F.lit(1)).alias("event_count"))


def _hour_files(spark: SparkSession, sf_dir: str, path: str, cut: bool | None) -> None:
    """Gzip JSON files of six hours each, in time order. Every fifth file is broken (its lines are cut) unless
    ``cut`` is False; then only those are written anew, whole, in place of the broken ones."""
    ts = F.col("event_ts")
    block = F.concat(F.date_format(ts, "yyyyMMdd"), F.lit("-"), F.floor(F.hour(ts) / 6))
    fifth = (F.dayofmonth(ts) * 4 + F.floor(F.hour(ts) / 6)) % 5 == 0
    line = F.to_json(F.struct(*EVENT_COLUMNS), {"ignoreNullFields": "false"})
    events = curated(spark, sf_dir, with_event_ts=True).select(
        block.alias("block"), "event_ts", fifth.alias("fifth"), F.when(fifth & F.lit(cut), F.left(line, F.lit(20))).otherwise(line).alias("value"))
    events = events if cut else events.where("fifth")
    (events.repartition("block").sortWithinPartitions("block", "event_ts").select("block", "value")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip").partitionBy("block").text(path))


def _loaded_twice(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Raw zone and ledger after a load of all files, of which some are broken, and one after these were mended."""
    files, landed, ledger = (scratch_dir(spark, x) for x in ("arrivals", "raw-ledger", "ledger"))
    _hour_files(spark, sf_dir, files, cut=True)
    L.load(spark, files, landed, ledger, "first", "*.gz")
    _hour_files(spark, sf_dir, files, cut=False)
    L.load(spark, files, landed, ledger, "second", "*.gz")
    return landed, ledger


def load_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and rows by load and state: the second load takes only what the first could not."""
    configure(spark)
    _, ledger = _loaded_twice(spark, sf_dir)
    return (L.read_ledger(spark, ledger).groupBy("load", "state")
            .agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows")))


def resumed_landing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per hour after both loads: every row once."""
    configure(spark)
    landed, _ = _loaded_twice(spark, sf_dir)
    return read_raw(spark, landed).groupBy(*RAW_PARTITIONS).agg(F.count(F.lit(1)).alias("event_count"))


def delete_after_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files by outcome of a load that deletes what it landed, and how many of them are still there."""
    configure(spark)
    files, landed, ledger = (scratch_dir(spark, x) for x in ("arrivals", "raw-ledger", "ledger"))
    _hour_files(spark, sf_dir, files, cut=True)
    outcomes = L.load(spark, files, landed, ledger, "only", "*.gz", delete=True)
    left = L.list_files(spark, files, "*.gz").select("file", F.lit(True).alias("there"))
    return outcomes.join(left, "file", "left").groupBy("state").agg(
        F.count(F.lit(1)).alias("files"), F.count("there").alias("files_left"), F.sum("rows").alias("rows"))


def landing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dry run of the batch landing: target key and rows per 5-minute batch, nothing written."""
    return land_batch(curated(spark, sf_dir), "unused", minutes=5, dry_run=True)


def landing_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 + A11: per folder, rows by the load's manifest and rows read back from there."""
    path = scratch_dir(spark, "raw")
    manifest = land_batch(curated(spark, sf_dir), path, load_id="all")
    said = manifest.groupBy("location").agg(F.sum("rows").alias("manifest_rows"))
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"(year=[^/]*/month=[^/]*/day=[^/]*/hour=[^/]*/batch=[^/]*)/", 1)
    found = spark.read.text(path).groupBy(folder.alias("location")).agg(F.count(F.lit(1)).alias("landed_rows"))
    return said.join(found, "location", "full")


def partition_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: hour partitions discovered on storage after landing, values kept zero-padded."""
    zones = land_raw_zone(spark, sf_dir)
    return C.storage_partitions(spark, zones.raw, RAW_PARTITIONS)


def etl_clean_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 + B10 + J9: ETL of the zone with defects; the reconciliation row observed in the write pass."""
    return build_defective_zones(spark, sf_dir).reconciliation


def etl_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B6 + A5: rows per curated day partition, read back from storage."""
    zones = build_zones(spark, sf_dir)
    return (read_curated(spark, zones.curated).groupBy(*CURATED_PARTITIONS)
            .agg(F.count(F.lit(1)).alias("event_count")))


def curated_write_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 + A5 + B8: the curated table as written, all 15 columns."""
    return read_curated(spark, build_zones(spark, sf_dir).curated)


def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 + B2: rejected records per reason (every reason listed), read back from the written quarantine."""
    zones = build_defective_zones(spark, sf_dir)
    return quarantine_by_reason(read_rejected(spark, zones.outcomes))


def defective_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ETL keeps of the zone with defects, with the discount code that older records lack."""
    zones = build_defective_zones(spark, sf_dir)
    return read_curated(spark, zones.curated).select("event_id", "user_id", "timestamp", "discount_code", *CURATED_PARTITIONS)


def result_csv_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by country and device written as CSV with a header and read back typed."""
    result = A.revenue_by_country_device(curated(spark, sf_dir))
    path = scratch_dir(spark, "results")
    write_result_csv(result, path)
    return spark.read.schema(result.schema).option("header", "true").csv(path)


def catalog_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: register the curated zone as a partitioned table and add its partitions."""
    zones = build_zones(spark, sf_dir)
    return C.refresh_table(spark, _table_name("curated"), zones.curated, EVENT_SCHEMA, CURATED_PARTITIONS)


def catalog_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 + A10: the curated zone published as a version behind a view; rows per day read through it."""
    zones = build_zones(spark, sf_dir)
    view = _table_name("curated_live")
    C.publish_version(spark, view, zones.curated, EVENT_SCHEMA, CURATED_PARTITIONS)
    return spark.table(view).groupBy(*CURATED_PARTITIONS).agg(F.count(F.lit(1)).alias("event_count"))


def outcome_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 + A10: kept and rejected rows published together; rows per view and reason read through them."""
    view = _table_name("outcomes_live")
    C.publish_outcomes(spark, view, build_defective_zones(spark, sf_dir).outcomes)
    kept = spark.table(f"{view}_curated").agg(F.count("*").alias("rows")).select(F.lit("kept").alias("outcome"), "rows")
    return kept.unionByName(spark.table(f"{view}_quarantine").groupBy(F.col("error_type").alias("outcome"))
                            .agg(F.count(F.lit(1)).alias("rows")))


def catalog_snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 + J8: the partitions that differ from the last listing snapshot, and whether the catalog has them: the last
    day arrives, and the first day's rows come in once more, after the first refresh."""
    df = curated(spark, sf_dir)
    date_key = F.concat_ws("-", *CURATED_PARTITIONS)
    first, last = df.agg(F.min(date_key), F.max(date_key)).first()
    path, snapshots, name = scratch_dir(spark, "curated"), scratch_dir(spark, "snapshots"), _table_name("curated")
    write_curated(df.where(date_key < last), path)
    C.register_table(spark, name, path, EVENT_SCHEMA, CURATED_PARTITIONS)
    C.refresh_from_snapshots(spark, name, path, CURATED_PARTITIONS, snapshots)
    write_curated(df.where(date_key.isin(first, last)), path, mode="append")
    changes = C.refresh_from_snapshots(spark, name, path, CURATED_PARTITIONS, snapshots)
    known = C.catalog_partitions(spark, name).withColumn("registered", F.lit(True))
    return changes.join(known, "partition", "left").select("partition", "change", F.coalesce("registered", F.lit(False)).alias("registered"))


def catalog_schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: a raw table registered before the discount code existed, with whole prices, brought up to the keys and
    types that the zone with defects holds."""
    raw = defective_zone(spark, sf_dir).raw
    old = T.StructType([T.StructField(f.name, T.LongType() if f.name == "price" else f.dataType)
                        for f in EVENT_SCHEMA.fields if f.name != "discount_code"])
    name = _table_name("raw")
    C.refresh_table(spark, name, raw, old, RAW_PARTITIONS, "json")
    merged = C.merge_schema(spark, name, raw, RAW_PARTITIONS, C.discover_schema(read_raw_text(spark, raw)))
    columns = spark.createDataFrame(spark.table(name).dtypes, "column_name string, table_type string")
    return merged.join(columns, "column_name").select("column_name", "table_type", "change", "rows")


def dq_missing_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog is refreshed before the last day arrives; that day is on storage, not in the catalog."""
    df = curated(spark, sf_dir)
    date_key = F.concat_ws("-", *CURATED_PARTITIONS)
    last_day = df.select(F.max(date_key)).scalar()
    path = scratch_dir(spark, "curated")
    write_curated(df.where(date_key < last_day), path, mode="full")
    name = _table_name("curated")
    C.refresh_table(spark, name, path, EVENT_SCHEMA, CURATED_PARTITIONS)
    write_curated(df.where(date_key >= last_day), path, mode="incremental")
    return C.missing_partitions(spark, name, path, CURATED_PARTITIONS)


BATCH: dict[str, Query] = {
    "raw_scan": raw_scan,
    "raw_landing_counts": raw_landing_counts,
    "file_landing_counts": file_landing_counts,
    "load_ledger": load_ledger,
    "resumed_landing_counts": resumed_landing_counts,
    "delete_after_load": delete_after_load,
    "landing_manifest": landing_manifest,
    "landing_agreement": landing_agreement,
    "partition_listing": partition_listing,
    "etl_clean_counts": etl_clean_counts,
    "etl_partition_counts": etl_partition_counts,
    "curated_write_readback": curated_write_readback,
    "quarantine_by_reason": quarantine_counts,
    "defective_curated": defective_curated,
    "result_csv_readback": result_csv_readback,
    "catalog_refresh": catalog_refresh,
    "catalog_publish": catalog_publish,
    "outcome_publish": outcome_publish,
    "catalog_snapshot_changes": catalog_snapshot_changes,
    "catalog_schema_merge": catalog_schema_merge,
    "dq_missing_partitions": dq_missing_partitions,
}


# --- data quality ---------------------------------------------------------------------------------

def _on_raw_text(fn: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(read_raw_text(spark, defective_zone(spark, sf_dir).raw))
    return run


def dq_partition_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.check_partitions(read_raw(spark, defective_zone(spark, sf_dir).raw))


def dq_duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that the curated table of the zone with defects holds more than once."""
    return Q.check_duplicate_ids(read_curated(spark, build_defective_zones(spark, sf_dir).curated))


QUALITY: dict[str, Query] = {
    "dq_funnel_shape": _on_curated(Q.check_funnel),
    "dq_stage_rates": _on_curated(Q.check_stage_rates),
    "dq_duplicate_ids": dq_duplicate_ids,
    "dq_domain_violations": _on_curated(Q.check_domains),
    "dq_product_presence": _on_curated(Q.check_product_presence),
    "dq_unexpected_keys": _on_raw_text(Q.check_keys),
    "schema_evolution_profile": _on_raw_text(lambda raw: Q.schema_profile(raw, 60)),
    "dq_partition_mismatch": dq_partition_mismatch,
}


# --- streaming -------------------------------------------------------------------------------------

def _run(query) -> None:
    """Wait for an ``availableNow`` query to drain its input, however long that takes; surface its failure."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def _stream_landed(spark: SparkSession, sf_dir: str, partition_time: str) -> str:
    path, ckpt = scratch_dir(spark, "stream-raw"), scratch_dir(spark, "ckpt")
    _run(S.land_stream(S.driver_event_stream(spark, sf_dir), path, ckpt, partition_time=partition_time,
                       available_now=True))
    return path


def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 + I1 + I3: stream into gzip JSON under ingest-time hour partitions; rows landed, and rows without an
    hour. (Which hours depends on the clock.)"""
    path = _stream_landed(spark, sf_dir, "ingest")
    return read_raw(spark, path).agg(F.count(F.lit(1)).alias("event_count"),
                                     F.count(F.when(F.col("hour").isNull(), F.lit(1))).alias("without_hour"))


def stream_landing_by_event_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4: the same stream partitioned by each record's own event hour."""
    path = _stream_landed(spark, sf_dir, "event")
    return read_raw(spark, path).groupBy(*RAW_PARTITIONS).agg(F.count(F.lit(1)).alias("event_count"))


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I6 + A8: a raw JSON stream split into kept records and a quarantine by reason; rows per outcome."""
    zones = defective_zone(spark, sf_dir)
    good_path, bad_path = scratch_dir(spark, "stream-good"), scratch_dir(spark, "stream-bad")

    def good_sink(batch: DataFrame, batch_id: int) -> None:
        S.write_batch(batch, good_path, batch_id)

    _run(S.split_stream(S.json_stream(spark, zones.raw), good_sink, bad_path, scratch_dir(spark, "ckpt"),
                        available_now=True))
    bad = spark.read.schema("error_type string, batch_id int").parquet(bad_path)
    kept = spark.read.parquet(good_path).agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("kept").alias("outcome"), "rows")
    reasons = quarantine_by_reason(bad).select(F.col("error_type").alias("outcome"), "rows")
    return kept.unionByName(reasons)


def _event_files(spark: SparkSession, sf_dir: str) -> str:
    """The events in several files, each with rows of all times, so that every micro-batch but the first has
    rows older than some that came before."""
    path = scratch_dir(spark, "event-files")
    read_table(spark, sf_dir, "events").repartition(6, "event_id").write.parquet(path)
    return path


def _shuffled_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return S.driver_event_stream(spark, sf_dir, files=_event_files(spark, sf_dir), max_files=2)


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events deduplicated on event_id per micro-batch and against earlier batches, exactly once.

    Each file of events comes twice, so every row has a copy in a later batch."""
    configure(spark)
    files, path = _event_files(spark, sf_dir), scratch_dir(spark, "stream-dedup")
    spark.read.parquet(files).write.mode("append").parquet(files)
    stream = S.driver_event_stream(spark, sf_dir, files=files, max_files=3)
    _run(S.dedup_into(stream, path, scratch_dir(spark, "ckpt"), available_now=True, fold_every=2))
    return spark.read.parquet(f"{path}/data").select(*CURATED_COLUMNS)


def stream_session_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I8: furthest funnel stage per session, from micro-batches out of time order."""
    path = scratch_dir(spark, "stream-stage")
    _run(S.write_partials(_shuffled_stream(spark, sf_dir), S.session_stage, path, scratch_dir(spark, "ckpt"),
                          available_now=True))
    return S.fold(spark, path, ["session_id"], "stage_rank", "max")


def stream_session_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I8: every session's steps along the funnel and its state, from micro-batches out of time order; sessions count
    as dropped after a day without events."""
    path = scratch_dir(spark, "stream-firsts")
    _run(S.write_partials(_shuffled_stream(spark, sf_dir), S.session_firsts, path, scratch_dir(spark, "ckpt"),
                          available_now=True))
    return S.session_transitions(spark.read.parquet(path), gap_minutes=24 * 60)


FLUSH_BUFFERS, FLUSH_BYTES = 8, 4096


def stream_flushes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flush of every event in eight delivery buffers that go at 4 KB (or after an hour, which this stream
    does not last), from micro-batches in the order of the event ids."""
    configure(spark)
    files, out = scratch_dir(spark, "id-files"), scratch_dir(spark, "flushes")
    events = read_table(spark, sf_dir, "events").select("event_id", F.octet_length("props").alias("size"))
    events.withColumn("buffer", F.col("event_id") % FLUSH_BUFFERS).repartitionByRange(4, "event_id").write.parquet(files)
    records = spark.readStream.schema("event_id long, size int, buffer long").parquet(files)
    flushed = buffers.flushes(records, "event_id", FLUSH_BYTES, 3600)
    _run(flushed.writeStream.format("parquet").outputMode("append").option("checkpointLocation", scratch_dir(spark, "ckpt"))
         .trigger(availableNow=True).start(out))
    return spark.read.parquet(out)


def _stream_windows(minutes: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_dir(spark, "stream-windows")
        _run(S.write_partials(_shuffled_stream(spark, sf_dir), lambda b: S.window_counts(b, minutes), path,
                              scratch_dir(spark, "ckpt"), available_now=True))
        return S.windowed_result(spark, path)
    run.__doc__ = f"I9: events per {minutes}-minute window, from micro-batches out of time order."
    return run


def batch_stream_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: history landed in batch, the last day streamed (without discount_code); read as one zone."""
    df = curated(spark, sf_dir)
    date_key = F.concat_ws("-", *CURATED_PARTITIONS)
    last_day = df.select(F.max(date_key)).scalar()
    batch_path = scratch_dir(spark, "raw")
    land_batch(df.where(date_key < last_day), batch_path)
    stream_path = scratch_dir(spark, "stream-raw")
    live = S.driver_event_stream(spark, sf_dir)
    live = live.where(F.concat_ws("-", *CURATED_PARTITIONS) >= last_day)
    stream_cols = [c for c in EVENT_COLUMNS if c != "discount_code"]
    _run(S.land_stream(live, stream_path, scratch_dir(spark, "ckpt"), partition_time="event",
                       available_now=True, columns=stream_cols))
    return A.union_zones(read_raw(spark, batch_path), read_raw(spark, stream_path))


STREAMING: dict[str, Query] = {
    "stream_landing": stream_landing,
    "stream_landing_by_event_date": stream_landing_by_event_date,
    "stream_quarantine": stream_quarantine,
    "stream_dedup": stream_dedup,
    "stream_session_stage": stream_session_stage,
    "stream_session_transitions": stream_session_transitions,
    "stream_flushes": stream_flushes,
    "stream_events_per_5min": _stream_windows(5),
    "stream_events_per_7min": _stream_windows(7),
    "batch_stream_union": batch_stream_union,
}


# --- operations ----------------------------------------------------------------------------------

def _lake_root(spark: SparkSession, sf_dir: str) -> str:
    """A lake with raw/, curated/ and results/ folders built from the driver tables."""
    root = scratch_dir(spark, "lake")
    df = curated(spark, sf_dir)
    land_batch(df, f"{root}/raw")
    write_curated(df, f"{root}/curated")
    write_result_csv(A.revenue_by_country_device(read_curated(spark, f"{root}/curated")), f"{root}/athena-results")
    return root


def tier_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: per folder and tier of a lake built from the tables, the days whose objects belong there."""
    root = _lake_root(spark, sf_dir)
    tiers = O.object_tiers(O.list_objects(spark, root), O.lifecycle_rules(spark), AUDIT_AS_OF)
    day = F.when(F.col("key").contains("year="), F.col("last_modified").cast("date"))
    return tiers.groupBy("prefix", "tier").agg(F.count_distinct(day).alias("days"))


def _inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of a lake as the events would fill it: a raw file for each five minutes, a curated file and a query
    result for each day; sizes from the events' properties."""
    df = read_table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp_ntz").alias("ts"), F.octet_length("props").alias("size"))
    start = window_start(F.col("ts"), 5)
    raw = partition_key(start, F.concat(F.lit("events_"), window_key(start), F.lit(".jsonl")), "raw")
    day = F.date_format("ts", "yyyy-MM-dd")
    kinds = [(raw, 400), (F.concat(F.lit("curated/day="), day, F.lit(".parquet")), 20), (F.concat(F.lit("athena-results/"), day, F.lit(".csv")), 1)]
    objects = F.array(*[F.struct(key.alias("key"), (F.col("size") * times).alias("bytes")) for key, times in kinds])
    return (df.select(F.explode(objects).alias("o"), F.col("ts").cast("date").alias("day")).groupBy(F.col("o.key").alias("key"))
            .agg(F.sum("o.bytes").alias("size_bytes"), F.max("day").cast("timestamp").alias("last_modified")))


def tier_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: objects, bytes and billable bytes by governing prefix and tier, under rules of which one is nested."""
    configure(spark)
    rules = O.lifecycle_rules(spark, [*O.LIFECYCLE_RULES, *NESTED_RULES])
    return O.tier_audit(_inventory(spark, sf_dir), rules, AUDIT_AS_OF)


def scan_cost_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 + H13: bytes, dollars and saving by query and format, from a log with one run per event type, day and
    format: JSON runs read all of the day's rows, Parquet runs three columns of the type's rows."""
    configure(spark)
    df = read_table(spark, sf_dir, "events").select(F.col("event_type").alias("query_name"), F.to_date("ts").alias("day"), F.octet_length("props").alias("size"))
    days = df.groupBy("day").agg(F.sum(F.col("size") + 64).alias("all_bytes"))
    runs = df.groupBy("query_name", "day").agg((F.count(F.lit(1)) * 24).alias("own_bytes")).join(days, "day")
    log = runs.select("query_name", F.inline(F.array(*[F.struct(F.lit(f).alias("source_format"), F.col(c).alias("bytes_scanned"))
                                                       for f, c in (("json", "all_bytes"), ("parquet", "own_bytes"))])))
    return O.scan_cost(log)


def compaction_effect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: a curated zone written the naive way (one file per task and day), then compacted."""
    df = curated(spark, sf_dir)
    src, dst = scratch_dir(spark, "curated-small"), scratch_dir(spark, "curated-compact")
    # The naive write: no shuffle by day, so every task writes a file into every day it touches.
    df.repartition(16).write.mode("overwrite").partitionBy(*CURATED_PARTITIONS).parquet(src)
    report = O.compact(spark, src, dst, CURATED_PARTITIONS)
    return report.select("partition", "rows_before", "rows_after",
                         (F.col("files_after") <= F.col("files_before")).alias("not_more_files"))


def compaction_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: days with an even number written four times over, each time a fourth of the events, the others once; then
    packed through the catalog. Files per day before and after, and whether the day moved."""
    path, runs, name = scratch_dir(spark, "scattered"), scratch_dir(spark, "packed"), _table_name("scattered")
    rows = read_curated(spark, build_zones(spark, sf_dir).curated)
    even, fourth = F.col("day").cast("int") % 2 == 0, F.col("event_id").cast("bigint") % 4
    write_partitioned(rows.where(~even), path, CURATED_PARTITIONS)
    for part in range(4):
        write_partitioned(rows.where(even & (fourth == part)), path, CURATED_PARTITIONS, mode="append")
    C.refresh_table(spark, name, path, EVENT_SCHEMA, CURATED_PARTITIONS)
    moves = K.compact_table(spark, name, path, runs, CURATED_PARTITIONS)
    label = F.concat_ws("/", *[F.concat(F.lit(f"{p}="), F.col(p)) for p in CURATED_PARTITIONS])
    files = spark.table(name).groupBy(label.alias("partition"), F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    now = files.groupBy("partition").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("files_after"))
    return now.join(moves.select("partition", "files_before"), "partition", "left").select(
        "partition", "rows", F.coalesce("files_before", "files_after").alias("files_before"), "files_after",
        F.col("files_before").isNotNull().alias("moved"))


def scan_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: bytes and cost of the revenue query over the raw JSON zone and over curated Parquet."""
    root = _lake_root(spark, sf_dir)
    needed = ["event_type", "country", "device_type", "price"]
    json_scan = O.scan_bytes(spark, f"{root}/raw", "json").select(
        F.lit("revenue_by_country_device").alias("query_name"), F.lit("json").alias("source_format"),
        "bytes_scanned")
    parquet_scan = O.scan_bytes(spark, f"{root}/curated", "parquet", needed).select(
        F.lit("revenue_by_country_device").alias("query_name"), F.lit("parquet").alias("source_format"),
        "bytes_scanned")
    cost = O.scan_cost(json_scan.unionByName(parquet_scan))
    return cost.select("query_name", "source_format", (F.col("reduction_pct") > 0).alias("saves"))


OPS: dict[str, Query] = {
    "tier_audit": tier_audit,
    "tier_bytes": tier_bytes,
    "scan_cost_log": scan_cost_log,
    "compaction_effect": compaction_effect,
    "compaction_moves": compaction_moves,
    "scan_cost": scan_cost,
}


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(ANALYTICS)
    out.update(BATCH)
    out.update(QUALITY)
    out.update(STREAMING)
    out.update(OPS)
    return out

"""Structured Streaming jobs.

Design rules used throughout:

* Sources carry an explicit schema; file sources can cap a micro-batch by bytes or files and clean up
  processed inputs (``cleanSource``).
* Delivery buffers (``streaming.buffers``) are the one job with state per key: a counter and a timer per buffer.
* Every query has its own checkpoint below the shared scratch folder, so a restarted driver or a
  lost executor resumes from the last committed batch (file sinks are exactly-once).
* Counts per window and stages per session keep no state: every micro-batch is aggregated like a
  batch and written under its own batch id (``write_partials``), and ``fold`` adds up or takes the
  maximum of what all batches wrote. A late row is counted by the batch it comes in, so the folded
  table equals a batch run whatever the order of arrival. Only ``dedup_stream`` uses a watermark,
  and says so.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shoplake.functions import event_time, parse_ts, window_key, window_start
from shoplake.operators.etl import error_type, rejected_rows
from shoplake.schema import (
    CORRUPT_COLUMN,
    EVENT_COLUMNS,
    FUNNEL_STAGES,
    RAW_PARTITIONS,
    RAW_SCHEMA,
)
from shoplake.session import configure, delete_folder, folder_exists
from shoplake.sources.adapter import conform_events, user_dimension
from shoplake.sources.sinks import write_partitioned


def _trigger(writer, interval: str | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval or "60 seconds")


def driver_event_stream(spark: SparkSession, sf_dir: str, files: str | None = None,
                        max_files: int | None = None) -> DataFrame:
    """The driver's ``events`` table as a file stream, conformed to curated columns plus ``event_ts``.

    ``files``: a folder that holds the same rows in several Parquet files, taken ``max_files`` at a time.
    The user dimension is joined as a static side (stream-static left join).
    """
    configure(spark)
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    events = reader.parquet(files) if files else reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    conformed = conform_events(events, user_dimension(spark, sf_dir), with_event_ts=True)
    return conformed.withColumn("event_ts", F.col("event_ts").cast("timestamp"))


def json_stream(spark: SparkSession, path: str, glob: str | None = None, clean: str = "off",
                archive_dir: str | None = None, max_bytes_per_trigger: int | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """I1 + I2 + A13: raw JSON lines as a stream, with the raw schema and a corrupt-record column.

    ``clean`` is ``off``, ``archive`` (needs ``archive_dir``) or ``delete``; a source file is cleaned
    one batch after it was processed. ``max_bytes_per_trigger`` is a plain byte count.
    """
    configure(spark)
    reader = (spark.readStream.schema(RAW_SCHEMA).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT_COLUMN).option("cleanSource", clean))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if archive_dir:
        reader = reader.option("sourceArchiveDir", archive_dir)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(int(max_bytes_per_trigger)))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    return reader.json(path)


def land_stream(stream: DataFrame, path: str, checkpoint: str, partition_time: str = "ingest",
                interval: str | None = "60 seconds", compression: str | None = "gzip",
                available_now: bool = False, columns: list[str] | None = None,
                files_per_batch: int | None = None) -> StreamingQuery:
    """A7 + I1 + I3 + I4: stream -> raw JSON zone under ``year=/month=/day=/hour=``.

    ``partition_time="ingest"`` partitions by the micro-batch's processing time (one value per
    batch: records near an hour boundary may land in the neighbouring hour); ``"event"`` partitions
    by the record's own timestamp. Files are gzip JSON lines by default.

    File count: by default each source task writes its own files, so a wide stream with a short
    trigger makes many small files. ``files_per_batch`` spreads every micro-batch round-robin over
    that many writers (the rows of an ingest-time batch all share one hour, so shuffling by the
    partition columns would put them in one task). Size it to about one trigger's bytes / 128 MB;
    the compaction job merges what remains small.
    """
    if partition_time == "ingest":
        ts = F.current_timestamp()
    elif partition_time == "event":
        ts = parse_ts("timestamp")
    else:
        raise ValueError("partition_time must be 'ingest' or 'event'")
    cols = columns or [c for c in EVENT_COLUMNS if c in stream.columns]
    out = stream.select(*cols, F.date_format(ts, "yyyy").alias("year"), F.date_format(ts, "MM").alias("month"),
                        F.date_format(ts, "dd").alias("day"), F.date_format(ts, "HH").alias("hour"))
    if files_per_batch:
        out = out.repartition(int(files_per_batch))
    writer = (out.writeStream.format("json").outputMode("append").partitionBy(*RAW_PARTITIONS)
              .option("checkpointLocation", checkpoint).option("ignoreNullFields", "false"))
    if compression:
        writer = writer.option("compression", compression)
    return _trigger(writer, interval, available_now).start(path)


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet",
                partition_cols: tuple[str, ...] = ()) -> None:
    """Write one micro-batch idempotently: it replaces the folder of its own batch id.

    A micro-batch that is replayed after a failure (same id, same input) overwrites its earlier
    partial output instead of appending a second copy, so ``foreachBatch`` sinks stay exactly-once.
    Readers see the batch id as a ``batch_id`` partition column.
    """
    writer = df.write.mode("overwrite").format(fmt)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.save(f"{path.rstrip('/')}/batch_id={int(batch_id)}")


def split_stream(stream: DataFrame, good_sink: Callable[[DataFrame, int], None],
                 bad_path: str, checkpoint: str, strict: bool = True, interval: str | None = None,
                 available_now: bool = False) -> StreamingQuery:
    """I6 + A8: route each micro-batch's rejected records to the quarantine and the rest to ``good_sink``.

    ``good_sink(batch, batch_id)`` should be idempotent per batch id (see ``write_batch``).

    Counts of input and rejected rows per reason are observed in the stream's progress
    (``observedMetrics['stream_counts']``) instead of being lost. The batch is parsed once and kept
    (memory, then disk) for the two writes, so it is also counted once.
    """
    tagged = stream.withColumn("error_type", error_type(stream, strict))
    metrics = [F.count(F.lit(1)).alias("input_rows"),
               F.count(F.when(F.col("error_type").isNull(), F.lit(1))).alias("kept_rows")]
    observed = tagged.observe("stream_counts", *metrics)

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Rejected rows as in the batch ETL: raw fields, reason, and the raw partition's date (or
        # the load date when the source has no date partitions).
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch(rejected_rows(batch), bad_path, batch_id, partition_cols=("error_type", "year", "month", "day"))
            good_sink(batch.where(F.col("error_type").isNull()).drop("error_type"), batch_id)
        finally:
            batch.unpersist()

    writer = observed.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _trigger(writer, interval, available_now).start()


def dedup_stream(stream: DataFrame, event_time: str = "event_ts", delay: str = "1 hour",
                 keys: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """Drop repeated events (same ``keys``) arriving within ``delay`` of each other.

    Spark's built-in stateful dedup. State per key is kept only until the watermark passes it, so
    memory is bounded by the delay. All copies of a key meet in one state partition: where one
    event's copies can be a large share of the stream, use ``dedup_into``.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def dedup_into(stream: DataFrame, path: str, checkpoint: str, key: str = "event_id", event_time: str = "event_ts",
               horizon_days: int = 1, interval: str | None = None, available_now: bool = False,
               fold_every: int = 16, keep_days: int | None = None) -> StreamingQuery:
    """I7 for streams where one event's copies may be a large share of all rows.

    Spark's stateful dedup sends every copy of a key to one state partition without any map-side
    step. Here each micro-batch is deduplicated as a batch (a partial aggregate: copies collapse
    inside every task before the shuffle), then anti-joined with the keys already seen. Seen keys
    are a Parquet table partitioned by event day (``none`` without a time); only days within
    ``horizon_days`` of the batch's earliest event, and ``none``, are read, so the lookup stays
    bounded, and of these only the batch's own keys go into the anti join: a semi join, broadcast while the
    batch is small. Only rows without a time look through all days, as nothing bounds their copies. Rows
    without a key can't be copies of anything and are all kept. Output lands in ``<path>/data``.

    The keys of ``fold_every`` batches are folded into one run, so many runs into a larger one, and so on
    (``seen_runs``): a batch reads a number of runs that grows with the logarithm of the batch number, and a key is
    rewritten as often. With ``keep_days`` a fold drops days further than that before its latest one; a copy that
    comes later still then counts as new, and so does one without a time (None keeps all days).

    Output and seen keys are written per batch id, the runs follow from the batch id alone, and a batch only
    consults earlier batches, so a replayed batch yields the same rows again: exactly-once. Folded runs are
    deleted once the run that holds them is complete.
    """
    if keep_days is not None and keep_days < horizon_days:
        raise ValueError("keep_days must cover horizon_days")
    data_path, seen_path = f"{path.rstrip('/')}/data", f"{path.rstrip('/')}/seen"
    day = F.coalesce(F.date_format(F.col(event_time), "yyyy-MM-dd"), F.lit("none"))
    key_type = dict(stream.dtypes)[key]

    def seen_in(spark: SparkSession, runs: list[tuple[int, int]]) -> DataFrame:
        schema = f"`{key}` {key_type}, day string"
        if not runs:
            return spark.createDataFrame([], schema)
        folders = [_run_folder(seen_path, *run) for run in runs]
        return spark.read.schema(schema).option("basePath", seen_path).parquet(*folders).select(key, "day")

    def fold_seen(spark: SparkSession, batch_id: int) -> None:
        level = 1
        while batch_id and batch_id % fold_every ** level == 0:
            width = fold_every ** (level - 1)
            parts = [(level - 1, batch_id - i * width) for i in range(fold_every, 0, -1)]
            keys = seen_in(spark, parts)
            if keep_days is not None:
                latest = keys.where(F.col("day") != "none").select(F.max("day")).first()[0]
                if latest is not None:
                    keys = keys.where(F.col("day") >= _days_before(latest, keep_days))  # "none" sorts after all dates
            write_partitioned(keys, _run_folder(seen_path, level, batch_id - fold_every * width), ["day"])
            for part in parts:
                delete_folder(spark, _run_folder(seen_path, *part))
            level += 1

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not folder_exists(spark, f"{_run_folder(seen_path, 0, batch_id)}/_SUCCESS"):
            fold_seen(spark, batch_id)
        # The source is read once: the batch is kept (memory, then disk) for the steps below.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # One row of each key, a timed one if there is any.
            order = F.struct(F.col(event_time).isNull(), F.col(event_time))
            keyed = batch.where(F.col(key).isNotNull()).groupBy(key).agg(
                F.min_by(F.struct(*batch.columns), order).alias("row")).select("row.*")
            timed = F.col(event_time).isNotNull()
            first_day = keyed.where(timed).select(F.min(day)).first()[0]
            seen = seen_in(spark, seen_runs(batch_id, fold_every))

            def unseen(rows: DataFrame, among: DataFrame) -> DataFrame:
                return rows.join(among.select(key).join(rows.select(key), key, "left_semi"), key, "left_anti")

            new = unseen(keyed.where(~timed), seen)
            if first_day is not None:
                new = new.unionByName(unseen(keyed.where(timed), seen.where(F.col("day") >= _days_before(first_day, horizon_days))))
            write_batch(new.select(*batch.columns).unionByName(batch.where(F.col(key).isNull())), data_path, batch_id)
        finally:
            batch.unpersist()
        written = spark.read.parquet(f"{data_path}/batch_id={int(batch_id)}")
        write_partitioned(written.where(F.col(key).isNotNull()).select(key, day.alias("day")),
                          _run_folder(seen_path, 0, batch_id), ["day"])

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _trigger(writer, interval, available_now).start()


def seen_runs(batch_id: int, fold_every: int) -> list[tuple[int, int]]:
    """(level, first batch) of the runs that hold the keys of all batches before ``batch_id``: a run of a level holds
    ``fold_every`` to that power batches, as the digits of the batch number in that base say."""
    runs, at = [], 0
    for level in range(batch_id.bit_length(), -1, -1):
        width = fold_every ** level
        while at + width <= batch_id:
            runs.append((level, at))
            at += width
    return runs


def _run_folder(seen_path: str, level: int, start: int) -> str:
    return f"{seen_path}/level={level}/start={start}"


def _days_before(day: str, days: int) -> F.Column:
    return F.lit((dt.date.fromisoformat(day) - dt.timedelta(days=days)).isoformat())


def stage_rank() -> F.Column:
    """Rank of an event type along the funnel (page_view 0 ... purchase 4); null for other types."""
    rank = F.lit(None).cast("int")
    for i, stage in reversed(list(enumerate(FUNNEL_STAGES))):
        rank = F.when(F.col("event_type") == F.lit(stage), F.lit(i)).otherwise(rank)
    return rank


def session_stage(events: DataFrame) -> DataFrame:
    """I8: per session, the furthest funnel stage reached (``session_id, stage_rank``) by these events."""
    ranked = events.select("session_id", stage_rank().alias("rank")).where(F.col("rank").isNotNull())
    return ranked.groupBy("session_id").agg(F.max("rank").alias("stage_rank"))


def session_firsts(events: DataFrame) -> DataFrame:
    """I8: per session and funnel stage, the first and last time among these events: ``session_id, stage_rank,
    first_ts, last_ts``. At most one row per stage, however many events a session has; events of other types have
    no rank and only prolong the session."""
    ranked = events.select("session_id", stage_rank().alias("stage_rank"), event_time(events).alias("ts"))
    return (ranked.where(F.col("session_id").isNotNull() & F.col("ts").isNotNull()).groupBy("session_id", "stage_rank")
            .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")))


def session_transitions(log: DataFrame, as_of=None, gap_minutes: int | None = None) -> DataFrame:
    """I8: the stage transitions of every session in a log of ``session_firsts``: ``session_id, step, from_stage,
    to_stage, reached_at, state``.

    A session starts in the stage of its first ranked event and advances whenever an event is of a later stage than
    all before it (of events at one time, the furthest stage counts). It is ``completed`` by the last stage; else
    ``dropped`` once ``gap_minutes`` have passed without any event at ``as_of`` (the log's last event by default),
    and ``open`` until then. Rows may arrive in any order: the log is folded before the steps are read.
    """
    seen = (log.groupBy("session_id", "stage_rank").agg(F.min("first_ts").alias("at"), F.max("last_ts").alias("last_ts")))
    by_time = Window.partitionBy("session_id").orderBy("at", F.desc("stage_rank"))  # at most one row per stage
    whole = Window.partitionBy("session_id")
    last_stage = len(FUNNEL_STAGES) - 1
    before = F.max("stage_rank").over(by_time.rowsBetween(Window.unboundedPreceding, -1))
    steps = (seen.withColumn("last", F.max("last_ts").over(whole)).withColumn("furthest", F.max("stage_rank").over(whole))
             .withColumn("before", before)
             .where(F.col("stage_rank").isNotNull() & (F.col("before").isNull() | (F.col("stage_rank") > F.col("before")))))
    now = F.lit(as_of).cast("timestamp_ntz") if as_of is not None else F.lit(seen.agg(F.max("last_ts")).first()[0])
    idle = F.lit(False) if gap_minutes is None else F.timestamp_diff("MINUTE", F.col("last"), now) >= gap_minutes
    state = F.when(F.col("furthest") == last_stage, "completed").when(idle, "dropped").otherwise("open")
    names = F.array(*[F.lit(x) for x in FUNNEL_STAGES])
    stage = lambda c: F.get(names, F.col(c))
    return steps.select("session_id", F.row_number().over(by_time).alias("step"), stage("before").alias("from_stage"),
                        stage("stage_rank").alias("to_stage"), F.col("at").alias("reached_at"), state.alias("state"))


def expire_sessions(spark: SparkSession, src: str, dst: str, upto_batch: int, before) -> DataFrame:
    """I8: fold a log of ``session_firsts`` up to a batch and leave out the sessions whose last event is older than
    ``before``, so that what is kept is bounded by the sessions still alive. Returns the log at ``dst``."""
    log = spark.read.parquet(src)
    folded = (log.where(F.col("batch_id") <= upto_batch).groupBy("session_id", "stage_rank")
              .agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")).withColumn("batch_id", F.lit(int(upto_batch))))
    kept = folded.unionByName(log.where(F.col("batch_id") > upto_batch))
    alive = kept.groupBy("session_id").agg(F.max("last_ts").alias("last")).where(F.col("last") >= F.lit(before).cast("timestamp_ntz"))
    kept.join(alive.select("session_id"), "session_id", "left_semi").write.mode("overwrite").partitionBy("batch_id").parquet(dst)
    return spark.read.parquet(dst)


def window_counts(events: DataFrame, minutes: int = 5) -> DataFrame:
    """Events per hour-aligned N-minute window (``window_start, event_count``), for any N up to 60."""
    return (events.select(window_start(event_time(events), minutes).alias("window_start"))
            .groupBy("window_start").agg(F.count(F.lit(1)).alias("event_count")))


def write_partials(stream: DataFrame, aggregate: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
                   interval: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Write ``aggregate`` of each micro-batch to a Parquet table, one folder per batch id."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(aggregate(batch), path, batch_id)

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _trigger(writer, interval, available_now).start()


def fold(spark: SparkSession, path: str, keys: list[str], value: str, how: str) -> DataFrame:
    """The table that a log of partial results stands for: ``how`` is ``sum`` or ``max`` over all batches."""
    return _folded(spark.read.parquet(path), keys, value, how)


def _folded(log: DataFrame, keys: list[str], value: str, how: str) -> DataFrame:
    merge = {"sum": F.sum, "max": F.max}[how]
    return log.groupBy(*keys).agg(merge(value).alias(value))


def compact_partials(spark: SparkSession, src: str, dst: str, keys: list[str], value: str, how: str,
                     upto_batch: int) -> DataFrame:
    """Fold the batches of a log up to ``upto_batch`` into one folder of ``dst`` and copy the later ones, so that
    a long-running log stays about as large as its result. Returns the log at ``dst``."""
    log = spark.read.parquet(src)
    value_type = dict(log.dtypes)[value]
    old = _folded(log.where(F.col("batch_id") <= upto_batch), keys, value, how)
    old = old.withColumn(value, F.col(value).cast(value_type)).withColumn("batch_id", F.lit(int(upto_batch)))
    later = log.where(F.col("batch_id") > upto_batch)
    old.unionByName(later).write.mode("overwrite").partitionBy("batch_id").parquet(dst)
    return spark.read.parquet(dst)


def windowed_result(spark: SparkSession, path: str) -> DataFrame:
    folded = fold(spark, path, ["window_start"], "event_count", "sum")
    return folded.select("window_start", window_key("window_start").alias("window_key"), "event_count")

"""Raw -> curated ETL (B1-B10, J9): quarantine bad records, conform, write, reconcile.

Counting is done with ``DataFrame.observe`` inside the write's own pass: the input, kept and
per-reason dropped counts come out of the same scan that writes the curated table, instead of
separate ``count()`` jobs that each rescan the raw zone. ``etl_outcomes`` writes kept and rejected rows
in one job, side by side below one folder, so that the raw zone is scanned and parsed once whatever is
in it. ``etl`` writes to two unrelated folders, for which Spark needs two jobs: its quarantine write is a
second pass that runs only when there are rejected rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplake.functions import is_blank, parse_ts
from shoplake.functions.tables import constant_table
from shoplake.schema import (
    CORRUPT_COLUMN,
    CURATED_COLUMNS,
    CURATED_PARTITIONS,
    ERROR_TYPES,
    EVENT_COLUMNS,
    EVENT_SCHEMA,
    RAW_SCHEMA,
)
from shoplake.sources.sinks import write_curated, write_partitioned, write_quarantine

EVENT_TYPES_OF = {f.name: f.dataType for f in EVENT_SCHEMA.fields}


def error_type(df: DataFrame, strict: bool = True) -> Column:
    """Reason a raw record is rejected, or null when it is kept.

    Tested in order: malformed JSON, missing or empty ``event_id``, missing ``timestamp`` and, when
    ``strict``, a timestamp that does not parse. With ``strict=False`` an unparseable timestamp is
    kept and lands with null date partitions, as a plain not-null filter would do.
    """
    corrupt = F.col(CORRUPT_COLUMN).isNotNull() if CORRUPT_COLUMN in df.columns else F.lit(False)
    reason = (F.when(corrupt, F.lit("malformed_json"))
              .when(is_blank("event_id"), F.lit("missing_event_id"))
              .when(F.col("timestamp").isNull(), F.lit("missing_timestamp")))
    if strict:
        reason = reason.when(parse_ts("timestamp").isNull(), F.lit("unparseable_timestamp"))
    return reason


def split_bad(df: DataFrame, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """A8 + B1 + B2: ``(good, bad)``; ``bad`` keeps the raw fields plus ``error_type`` and raw date."""
    tagged = df.withColumn("error_type", error_type(df, strict))
    good = tagged.where(F.col("error_type").isNull()).drop("error_type")
    bad = rejected_rows(tagged)
    return good, bad


def rejected_rows(tagged: DataFrame) -> DataFrame:
    """Rejected rows with their reason, dated by the raw partition they came from.

    Dating by the source partition (not the load date) makes quarantine writes replaceable: a
    re-run of the same raw days replaces exactly their rejected rows. Input without raw date
    partitions is dated by the load.
    """
    raw_cols = [c for c in EVENT_COLUMNS + [CORRUPT_COLUMN] if c in tagged.columns]
    today = F.current_date()
    if all(c in tagged.columns for c in ("year", "month", "day")):
        dates = [F.col("year"), F.col("month"), F.col("day")]
    else:
        dates = [F.date_format(today, "yyyy").alias("year"), F.date_format(today, "MM").alias("month"),
                 F.date_format(today, "dd").alias("day")]
    return tagged.where(F.col("error_type").isNotNull()).select(*raw_cols, "error_type", *dates)


def to_curated(good: DataFrame, with_event_ts: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """B6 + B7 + B8: derive the event time and its zero-padded date parts, fix the 15 columns.

    Date parts come from the event's own time in UTC, never from the raw path. A missing
    ``discount_code`` column is added as a null string.
    """
    ts = parse_ts("timestamp")
    df = good
    for name in EVENT_COLUMNS:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    df = df.withColumn("discount_code", F.col("discount_code").cast("string")).withColumn("event_ts", ts)
    df = (df.withColumn("year", F.date_format("event_ts", "yyyy"))
          .withColumn("month", F.date_format("event_ts", "MM"))
          .withColumn("day", F.date_format("event_ts", "dd")))
    cols = CURATED_COLUMNS + (["event_ts"] if with_event_ts else []) + [k for k in keep if k in df.columns]
    return df.select(*cols)


KEPT = "kept"
OUTCOME_PARTITIONS = ["outcome", *CURATED_PARTITIONS]


def conform_outcomes(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Every raw row once: the 12 event columns, the corrupt record, its ``outcome`` (kept or the reason it is
    rejected) and its date, the event's for kept rows and the raw partition's (or the load's) for others."""
    tagged = raw.withColumn("error_type", error_type(raw, strict)).withColumn("_ts", parse_ts("timestamp"))
    if CORRUPT_COLUMN not in raw.columns:
        tagged = tagged.withColumn(CORRUPT_COLUMN, F.lit(None).cast("string"))
    good = F.col("error_type").isNull()
    dated = all(c in raw.columns for c in CURATED_PARTITIONS)
    parts = [F.when(good, F.date_format("_ts", form)).otherwise(F.col(c) if dated else F.date_format(F.current_date(), form)).alias(c)
             for c, form in zip(CURATED_PARTITIONS, ("yyyy", "MM", "dd"), strict=True)]
    events = [(F.col(c) if c in raw.columns else F.lit(None)).cast(t).alias(c) for c, t in EVENT_TYPES_OF.items()]
    return tagged.select(*events, CORRUPT_COLUMN, F.coalesce("error_type", F.lit(KEPT)).alias("outcome"), *parts)


def etl_outcomes(raw: DataFrame, path: str, mode: str = "full", strict: bool = True) -> DataFrame:
    """A8 + B1-B10 + J9 in one pass: kept and rejected rows to ``path`` by outcome and date; the reconciliation row.

    One job scans the raw rows once, tags them, rebalances by outcome and date, counts (``observe``, after
    the shuffle, so once per row even under retries) and writes ``outcome=/year=/month=/day=``. Both sides
    become visible with that job's commit; a full load replaces both, an incremental one the outcomes and
    days it holds. ``kept_path`` is the curated table, ``read_rejected`` the quarantine.
    """
    obs = Observation(f"etl_outcomes_{uuid.uuid4().hex[:8]}")
    outcome = F.col("outcome")
    metrics = [F.count(F.lit(1)).alias("input_rows"), F.count(F.when(outcome == KEPT, F.lit(1))).alias("kept_rows")]
    metrics += [F.count(F.when(outcome == F.lit(r), F.lit(1))).alias(r) for r in ERROR_TYPES]
    rows = conform_outcomes(raw, strict).hint("rebalance", *OUTCOME_PARTITIONS).observe(obs, *metrics)
    write_partitioned(rows, path, OUTCOME_PARTITIONS, "parquet", mode, {"compression": "snappy"}, rebalance=False)
    counts = obs.get
    if counts["input_rows"] != counts["kept_rows"] + sum(counts[r] for r in ERROR_TYPES):
        raise AssertionError(f"reconciliation failed: {counts}")
    return reconciliation(raw.sparkSession, counts)


def kept_path(path: str) -> str:
    """The curated table below the folder of ``etl_outcomes``."""
    return f"{path}/outcome={KEPT}"


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """The quarantine below the folder of ``etl_outcomes``: raw fields, ``error_type`` and date; kept rows are not read."""
    schema = T.StructType([*RAW_SCHEMA.fields, *[T.StructField(c, T.StringType()) for c in OUTCOME_PARTITIONS]])
    rows = spark.read.schema(schema).parquet(path).where(F.col("outcome") != KEPT)
    return rows.withColumnRenamed("outcome", "error_type")


def reconciliation(spark: SparkSession, counts: dict) -> DataFrame:
    """One row: input, kept and dropped rows and the dropped rows per reason."""
    row = {"input_rows": int(counts.get("input_rows", 0) or 0), "kept_rows": int(counts.get("kept_rows", 0) or 0)}
    row["dropped_rows"] = row["input_rows"] - row["kept_rows"]
    for reason in ERROR_TYPES:
        row[reason] = int(counts.get(reason, 0) or 0)
    cols = ["input_rows", "kept_rows", "dropped_rows", *ERROR_TYPES]
    return constant_table(spark, [tuple(row[c] for c in cols)], [(c, "bigint") for c in cols])


def etl(raw: DataFrame, curated_path: str, quarantine_path: str | None = None, mode: str = "full",
        strict: bool = True, with_event_ts: bool = False) -> DataFrame:
    """B1-B10 + J9: clean, conform and write ``raw``; return the reconciliation row.

    Plan: tag each raw row with its rejection reason and conformed columns, rebalance by the date
    partitions, count (``observe``), keep the good rows, write. The counters sit *after* the shuffle,
    in the write's result stage, where Spark applies each task's update exactly once even when
    tasks are retried or lost executors force map stages to re-run.
    ``input_rows = kept_rows + dropped_rows`` holds by construction and is checked.
    """
    spark = raw.sparkSession
    tagged = raw.withColumn("error_type", error_type(raw, strict))
    conformed = to_curated(tagged, with_event_ts, keep=("error_type",))
    obs = Observation(f"etl_counts_{uuid.uuid4().hex[:8]}")  # unique: concurrent loads in one session
    metrics = [F.count(F.lit(1)).alias("input_rows"),
               F.count(F.when(F.col("error_type").isNull(), F.lit(1))).alias("kept_rows")]
    metrics += [F.count(F.when(F.col("error_type") == F.lit(r), F.lit(1))).alias(r) for r in ERROR_TYPES]
    balanced = conformed.hint("rebalance", *CURATED_PARTITIONS).observe(obs, *metrics)
    good = balanced.where(F.col("error_type").isNull()).drop("error_type")
    extra = ["event_ts"] if with_event_ts else []
    write_curated(good, curated_path, mode, extra, rebalance=False)
    counts = obs.get
    if quarantine_path is not None:
        # Same replacement rule as the curated table: a full load replaces the quarantine (an
        # empty one clears stale rows; ``limit(0)`` plans no scan), an incremental load replaces
        # the raw days it read. Only rejected rows cost a second pass over the input.
        any_bad = counts.get("input_rows", 0) != counts.get("kept_rows", 0)
        bad = rejected_rows(tagged) if any_bad else rejected_rows(tagged).limit(0)
        if any_bad or mode == "full":
            write_quarantine(bad, quarantine_path, "full" if mode == "full" else "incremental")
    result = reconciliation(spark, counts)
    dropped = sum(int(counts.get(r, 0) or 0) for r in ERROR_TYPES)
    if int(counts.get("input_rows", 0)) != int(counts.get("kept_rows", 0)) + dropped:
        raise AssertionError(f"reconciliation failed: {counts}")
    return result


def quarantine_by_reason(bad: DataFrame) -> DataFrame:
    """Rows per rejection reason, every reason listed (0 when none): one conditional-count pass."""
    counts = bad.agg(*[F.count(F.when(F.col("error_type") == F.lit(r), F.lit(1))).alias(f"c{i}")
                       for i, r in enumerate(ERROR_TYPES)])
    rows = [F.struct(F.lit(r).alias("error_type"), F.col(f"c{i}").cast("bigint").alias("rows"))
            for i, r in enumerate(ERROR_TYPES)]
    return counts.select(F.inline(F.array(*rows)))

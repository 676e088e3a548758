"""Writers: curated Parquet, quarantine, raw JSON zone and result CSV.

Partitioned writes go through a ``rebalance`` on the partition columns rather than a plain
``repartition``: the shuffle groups each date's rows into few files (no small-files problem), and
adaptive execution splits a date that holds an outsized share of the rows across several tasks and
merges tiny ones, so one hot day never ends up in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from shoplake.schema import CURATED_COLUMNS, CURATED_PARTITIONS


def _balanced(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *cols)


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str], fmt: str = "parquet",
                      mode: str = "full", options: dict[str, str] | None = None, rebalance: bool = True) -> None:
    """Write ``df`` partitioned by ``partition_cols``.

    ``mode="full"`` replaces the whole target (a static overwrite drops partitions absent from
    ``df``); ``mode="incremental"`` replaces only the partitions present in ``df`` (dynamic
    partition overwrite); ``mode="append"`` adds files.
    ``rebalance=False`` is for frames that were already rebalanced by the caller.
    """
    source = _balanced(df, partition_cols) if rebalance else df
    writer = source.write.partitionBy(*partition_cols).format(fmt)
    if mode == "full":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "static")
    elif mode == "incremental":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode == "append":
        writer = writer.mode("append")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    writer.save(path)


def write_curated(df: DataFrame, path: str, mode: str = "full", extra_columns: Sequence[str] = (),
                  rebalance: bool = True) -> None:
    """A5: curated columns to Snappy Parquet partitioned by year/month/day.

    ``mode="incremental"`` replaces each curated day present in ``df`` as a whole, so ``df`` must
    hold every row of those event days. With event-time landing a raw day is an event day; with
    ingest-time (stream) landing, late events of a day sit in later raw partitions: load the
    neighbouring raw day too, or use ``mode="append"`` for late data.
    """
    cols = CURATED_COLUMNS + [c for c in extra_columns if c not in CURATED_COLUMNS]
    write_partitioned(df.select(*cols), path, CURATED_PARTITIONS, "parquet", mode,
                      {"compression": "snappy"}, rebalance)


def write_quarantine(bad: DataFrame, path: str, mode: str = "append") -> None:
    """Rejected records, partitioned by error type and date (see ``etl``)."""
    write_partitioned(bad, path, ["error_type", "year", "month", "day"], "parquet", mode)


def write_raw_json(df: DataFrame, path: str, partition_cols: Sequence[str], compression: str | None = None,
                   keep_null_fields: bool = True, mode: str = "append") -> None:
    """Event records as JSON lines under Hive-style partition directories.

    ``keep_null_fields`` writes ``"key": null`` for null values, so every record carries every key;
    otherwise null keys are omitted (the record then looks like one from before the key existed).
    """
    options = {"ignoreNullFields": "false" if keep_null_fields else "true"}
    if compression:
        options["compression"] = compression
    write_partitioned(df, path, partition_cols, "json", mode, options)


def write_result_csv(df: DataFrame, path: str) -> None:
    """A query result as CSV with a header row."""
    df.write.mode("overwrite").option("header", "true").csv(path)

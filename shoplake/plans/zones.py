"""Build the lake's zones from the driver tables in the shared scratch folder.

raw zone       <- conformed events landed as JSON lines by hour (``land_batch``), plain and gzip
defective zone <- the same events with defects (``plans.defects``), plain and gzip
curated zone   <- ETL of a raw zone into Parquet by outcome and day, in one pass (``etl_outcomes``)

Every registered query that needs a zone works on the whole input. A zone is built once for each session
and input and then shared. The scratch folder is read from the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.operators.etl import etl_outcomes, kept_path
from shoplake.operators.landing import land_batch
from shoplake.plans.defects import defective_lines
from shoplake.schema import RAW_PARTITIONS
from shoplake.session import configure, scratch_dir
from shoplake.sources.adapter import curated_events
from shoplake.sources.raw import read_raw
from shoplake.sources.sinks import write_partitioned


@dataclass
class Zones:
    raw: str
    curated: str | None = None
    outcomes: str | None = None  # folder of kept and rejected rows
    reconciliation: DataFrame | None = None


_built: dict[tuple[str, str, str], Zones] = {}


def _shared(spark: SparkSession, sf_dir: str, kind: str, build: Callable[[], Zones]) -> Zones:
    """The session's zone of this kind and input, built on first use."""
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def land_raw_zone(spark: SparkSession, sf_dir: str) -> Zones:
    """Events with an even id as plain files, the others as gzip, in one zone."""
    def build() -> Zones:
        path, events = scratch_dir(spark, "raw"), curated_events(spark, sf_dir)
        even = F.col("event_id").cast("bigint") % 2 == 0
        land_batch(events.where(even), path, minutes=5)
        land_batch(events.where(~even), path, minutes=5, compression="gzip")
        return Zones(raw=path)

    return _shared(spark, sf_dir, "raw", build)


def defective_zone(spark: SparkSession, sf_dir: str) -> Zones:
    """Raw lines with defects, half of them gzip."""
    def build() -> Zones:
        path = scratch_dir(spark, "raw-defects")
        lines = defective_lines(curated_events(spark, sf_dir, with_event_ts=True))
        for rest, options in ((0, {}), (1, {"compression": "gzip"})):
            part = lines.where(F.col("event_no") % 2 == rest).drop("event_no")
            write_partitioned(part, path, RAW_PARTITIONS, "text", "append", options)
        return Zones(raw=path)

    return _shared(spark, sf_dir, "defects", build)


def _with_curated(spark: SparkSession, sf_dir: str, kind: str, raw: Callable[..., Zones]) -> Zones:
    def build() -> Zones:
        path = scratch_dir(spark, "outcomes")
        zones = Zones(raw=raw(spark, sf_dir).raw, curated=kept_path(path), outcomes=path)
        zones.reconciliation = etl_outcomes(read_raw(spark, zones.raw), path)
        return zones

    return _shared(spark, sf_dir, kind, build)


def build_zones(spark: SparkSession, sf_dir: str) -> Zones:
    return _with_curated(spark, sf_dir, "curated", land_raw_zone)


def build_defective_zones(spark: SparkSession, sf_dir: str) -> Zones:
    return _with_curated(spark, sf_dir, "curated-defects", defective_zone)

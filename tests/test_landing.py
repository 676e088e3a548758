import json
import os

from pyspark.sql import functions as F

from conftest import edf, event
from shoplake.functions import partition_key, window_key, window_start
from shoplake.operators.landing import batch_manifest, land_batch, land_files
from shoplake.sources.raw import read_raw


def test_t3_five_minute_batches(spark):
    df = edf(spark, [event("1", ts="2026-09-06T14:02:00"), event("2", ts="2026-09-06T14:04:00"),
                                event("3", ts="2026-09-06T14:07:00")])
    man = {r["source"]: r["rows"] for r in batch_manifest(df, 5).collect()}
    assert man == {"events_20260906_1400.jsonl": 2, "events_20260906_1405.jsonl": 1}


def test_windows_are_hour_aligned_for_any_n(spark):
    df = spark.createDataFrame([("2026-09-06T14:59:00",), ("2026-09-06T15:03:00",)], "t string")
    ts = F.to_timestamp("t")
    rows = df.select(window_key(window_start(ts, 7)).alias("k")).collect()
    assert [r.k for r in rows] == ["20260906_1456", "20260906_1500"]


def test_t4_t5_partition_key(spark):
    df = spark.createDataFrame([("2026-01-05T03:00:00", "2026-09-06T14:30:00")], "a string, b string")
    row = df.select(partition_key(F.to_timestamp("a"), "events_20260105_0300.jsonl").alias("k1"),
                    partition_key(F.to_timestamp("b"), "events.jsonl", prefix="curated").alias("k2")).first()
    assert row.k1 == "raw/year=2026/month=01/day=05/hour=03/events_20260105_0300.jsonl"
    assert row.k2 == "curated/year=2026/month=09/day=06/hour=14/events.jsonl"


def _src_file(tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    lines = [json.dumps(event("1", ts="2026-09-06T14:30:00")), json.dumps(event("2", ts="2026-09-06T23:59:59"))]
    (src / "events_20260906_1430.jsonl").write_text("\n".join(lines) + "\n")
    return src


def test_t6_first_line_decides_partition(spark, tmp_path):
    src = _src_file(tmp_path)
    first = land_files(spark, str(src), str(tmp_path / "a"), route="file_first", dry_run=True).collect()
    assert [(r.target, r.rows) for r in first] == [
        ("raw/year=2026/month=09/day=06/hour=14/events_20260906_1430.jsonl", 2)]
    per_row = {r.target for r in land_files(spark, str(src), str(tmp_path / "b"), route="row",
                                            dry_run=True).collect()}
    assert per_row == {"raw/year=2026/month=09/day=06/hour=14/events_20260906_1430.jsonl",
                       "raw/year=2026/month=09/day=06/hour=23/events_20260906_1430.jsonl"}


def test_t7_dry_run_writes_nothing(spark, tmp_path):
    src = _src_file(tmp_path)
    land_files(spark, str(src), str(tmp_path / "dst"), dry_run=True).collect()
    assert not os.path.exists(tmp_path / "dst")
    df = edf(spark, [event("1")])
    land_batch(df, str(tmp_path / "dst2"), dry_run=True).collect()
    assert not os.path.exists(tmp_path / "dst2")


def test_t8_round_trip_and_file_first_write(spark, tmp_path):
    src = _src_file(tmp_path)
    land_files(spark, str(src), str(tmp_path / "zone"), route="file_first").collect()
    raw = read_raw(spark, str(tmp_path / "zone"))
    assert raw.count() == 2
    assert {r.hour for r in raw.select("hour").collect()} == {"14"}


def test_t15_gzip_and_plain_in_one_zone(spark, tmp_path):
    df = edf(spark, [event("1", ts="2026-09-06T14:30:00")])
    zone = str(tmp_path / "zone")
    land_batch(df, zone)
    land_batch(edf(spark, [event("2", ts="2026-09-06T15:30:00")]), zone, compression="gzip")
    names = [n for _, _, files in os.walk(zone) for n in files if not n.startswith((".", "_"))]
    assert any(n.endswith(".gz") for n in names) and any(not n.endswith(".gz") for n in names)
    assert sorted(r.event_id for r in read_raw(spark, zone).collect()) == ["1", "2"]


def test_no_matching_file_fails(spark, tmp_path):
    import pytest
    src = _src_file(tmp_path)
    with pytest.raises(FileNotFoundError):
        land_files(spark, str(src), str(tmp_path / "x"), glob="*.csv", dry_run=True)


def test_unroutable_file_fails_others_land(spark, tmp_path):
    src = _src_file(tmp_path)
    (src / "events_bad.jsonl").write_text('{"event_id": "x", "timestamp": "not a time"}\n'
                                          + json.dumps(event("9", ts="2026-09-06T15:00:00")) + "\n")
    man = {(r.source, r.status): (r.target, r.rows) for r in
           land_files(spark, str(src), str(tmp_path / "zone")).collect()}
    assert man[("events_bad.jsonl", "failed")] == (None, 2)
    assert man[("events_20260906_1430.jsonl", "landed")][1] == 2
    assert read_raw(spark, str(tmp_path / "zone")).count() == 2


def test_read_raw_date_range_prunes(spark, tmp_path):
    zone = str(tmp_path / "zone")
    land_batch(edf(spark, [event("1", ts="2026-09-06T14:30:00"), event("2", ts="2026-09-07T10:00:00")]), zone)
    df = read_raw(spark, zone, start_date="2026-09-07", end_date="2026-09-07")
    assert [r.event_id for r in df.collect()] == ["2"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_landing_reruns_are_idempotent(spark, tmp_path):
    zone = str(tmp_path / "zone")
    first = edf(spark, [event("1", ts="2026-09-06T14:30:00"), event("2", ts="2026-09-06T14:40:00")])
    land_batch(first, zone, load_id="load-1")
    land_batch(first, zone, load_id="load-1")  # the same load again, e.g. a retried job
    land_batch(edf(spark, [event("3", ts="2026-09-06T14:50:00")]), zone, load_id="load-2")
    assert sorted(r.event_id for r in read_raw(spark, zone).collect()) == ["1", "2", "3"]
    src = _src_file(tmp_path)
    files_zone = str(tmp_path / "files")
    land_files(spark, str(src), files_zone).collect()
    land_files(spark, str(src), files_zone).collect()  # re-landing a file replaces it
    assert read_raw(spark, files_zone).count() == 2

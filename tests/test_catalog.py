import json
import shutil
import uuid

from pyspark.sql import types as T

from conftest import edf, event
from shoplake.operators import catalog as C
from shoplake.operators.etl import conform_outcomes, etl_outcomes, kept_path, read_rejected, to_curated
from shoplake.schema import CURATED_COLUMNS, CURATED_PARTITIONS, EVENT_SCHEMA
from shoplake.sources.raw import read_curated, read_raw
from shoplake.sources.sinks import write_curated


def name():
    return f"t_{uuid.uuid4().hex[:8]}"


def day(spark, d, n=1):
    return to_curated(edf(spark, [event(f"{d}-{i}", ts=f"2026-09-{d:02d}T10:00:00") for i in range(n)]))


def changes(df):
    return {r["partition"].rsplit("=", 1)[1]: r["change"] for r in df.collect()}


def test_snapshots_report_added_changed_and_vanished(spark, tmp_path):
    path, snaps, table = str(tmp_path / "curated"), str(tmp_path / "snaps"), name()
    for d in (1, 2, 3):
        write_curated(day(spark, d), path, mode="append")
    C.register_table(spark, table, path, EVENT_SCHEMA, CURATED_PARTITIONS)
    refresh = lambda: C.refresh_from_snapshots(spark, table, path, CURATED_PARTITIONS, snaps)
    assert changes(refresh()) == {"01": "added", "02": "added", "03": "added"}
    assert changes(refresh()) == {}
    write_curated(day(spark, 4), path, mode="append")
    write_curated(day(spark, 2, 5), path, mode="append")
    shutil.rmtree(tmp_path / "curated" / "year=2026" / "month=09" / "day=03")
    assert changes(refresh()) == {"04": "added", "02": "changed", "03": "vanished"}
    assert spark.table(table).count() == 1 + 6 + 1
    assert changes(refresh()) == {}


def test_refresh_lists_only_the_folders_asked_for(spark, tmp_path):
    path, table = str(tmp_path / "curated"), name()
    for d in (1, 2):
        write_curated(day(spark, d), path, mode="append")
    found = C.refresh_table(spark, table, path, EVENT_SCHEMA, CURATED_PARTITIONS, below=["year=2026/month=09/day=02"])
    assert [r[0] for r in found.collect()] == ["year=2026/month=09/day=02"]
    assert C.missing_partitions(spark, table, path, CURATED_PARTITIONS).first()[0] == "year=2026/month=09/day=01"
    assert C.refresh_table(spark, table, path, EVENT_SCHEMA, CURATED_PARTITIONS).count() == 2


def test_schema_is_discovered_merged_and_widened(spark, tmp_path):
    part = tmp_path / "raw" / "day=01"
    part.mkdir(parents=True)
    rows = [{"a": 1, "b": "x", "n": None}, {"a": 2.5, "late": True, "mixed": 1}, {"a": 3, "mixed": "y", "deep": {"k": [1, 2]}}]
    (part / "f.json").write_text("".join(json.dumps(r) + "\n" for r in rows) + "not json\n[1]\n\n")
    path, table = str(tmp_path / "raw"), name()
    lines = spark.read.text(path)
    found = {r["key"]: (r["data_type"], r["rows"]) for r in C.discover_schema(lines).collect()}
    assert found == {"a": ("double", 3), "b": ("string", 1), "n": ("string", 1), "late": ("boolean", 1), "mixed": ("string", 2),
                     "deep": ("struct<k:array<bigint>>", 1)}
    old = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("gone", T.StringType())])
    C.refresh_table(spark, table, path, old, ["day"], "json")
    merged = {r["column_name"]: (r["change"], r["data_type"]) for r in
              C.merge_schema(spark, table, path, ["day"], C.discover_schema(lines)).collect()}
    assert merged["a"] == ("widened", "double") and merged["gone"] == ("kept", "string") and merged["late"] == ("added", "boolean")
    assert sorted(r["a"] for r in spark.table(table).where("a is not null").collect()) == [1.0, 2.5, 3.0]
    assert spark.table(table).where("late").count() == 1
    again = C.merge_schema(spark, table, path, ["day"], C.discover_schema(lines))
    assert {r["change"] for r in again.collect()} == {"kept"}
    assert C.discover_schema(lines.where("value = 'not json'")).count() == 0


def test_types_widen_to_what_holds_both():
    assert [C.widened(a, b) for a, b in (("bigint", "bigint"), ("bigint", "double"), ("double", "bigint"), ("string", "bigint"),
                                         ("bigint", "string"), ("boolean", "bigint"))] == [
        "bigint", "double", "double", "string", "string", "string"]


def test_outcomes_are_written_by_one_scan_and_published_together(spark, tmp_path):
    raw_dir = tmp_path / "raw" / "year=2026" / "month=09" / "day=10" / "hour=10"
    raw_dir.mkdir(parents=True)
    good = [json.dumps(event(f"g{i}", ts=f"2026-09-{10 + i}T10:00:00")) for i in range(3)]
    bad = [json.dumps(event("", ts="2026-09-10T10:00:00")), '{"event_id": "cut', json.dumps(event("t", ts="garbage"))]
    (raw_dir / "f.jsonl").write_text("\n".join(good + bad) + "\n")
    raw, path = read_raw(spark, str(tmp_path / "raw")), str(tmp_path / "outcomes")
    plan = conform_outcomes(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1  # all that is written comes from this one scan
    recon = etl_outcomes(raw, path).first().asDict()
    assert (recon["input_rows"], recon["kept_rows"], recon["dropped_rows"]) == (6, 3, 3)
    kept = read_curated(spark, kept_path(path))
    assert kept.columns == CURATED_COLUMNS and {r["day"] for r in kept.collect()} == {"10", "11", "12"}
    rejected = {r["error_type"]: r for r in read_rejected(spark, path).collect()}
    assert set(rejected) == {"missing_event_id", "malformed_json", "unparseable_timestamp"}
    assert rejected["malformed_json"]["_corrupt_record"] == '{"event_id": "cut' and rejected["malformed_json"]["day"] == "10"
    # An incremental load replaces the outcomes and days it holds.
    etl_outcomes(raw.where("event_id = 'g1'"), path, mode="incremental")
    assert read_curated(spark, kept_path(path)).count() == 3 and read_rejected(spark, path).count() == 3
    view = C.publish_outcomes(spark, name(), path)
    assert spark.table(f"{view}_curated").columns == CURATED_COLUMNS
    assert (spark.table(f"{view}_curated").count(), spark.table(f"{view}_quarantine").count()) == (3, 3)
    second = str(tmp_path / "outcomes2")
    etl_outcomes(raw.where("event_id like 'g%'"), second)
    C.publish_outcomes(spark, view, second)
    assert (spark.table(f"{view}_curated").count(), spark.table(f"{view}_quarantine").count()) == (3, 0)

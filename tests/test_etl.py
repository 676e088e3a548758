import json

from pyspark.sql import functions as F

from conftest import edf, event
from shoplake.operators.etl import etl, split_bad, to_curated
from shoplake.schema import CURATED_COLUMNS
from shoplake.sources.raw import read_curated, read_raw


def _write_lines(path, lines):
    path.mkdir(parents=True, exist_ok=True)
    (path / "events_20260910_1000.jsonl").write_text("\n".join(lines) + "\n")


def _sample_lines():
    valid = [
        json.dumps(event("a1", "page_view", "2026-09-10T10:00:00")),
        json.dumps(event("a2", "product_view", "2026-09-10T10:01:00", product="p1", category="books", price=9.99)),
        json.dumps(event("a3", "add_to_cart", "2026-09-10T10:02:00", product="p1", category="books", price=9.99,
                         discount_code=None)),
        json.dumps(event("a4", "purchase", "2026-09-10T10:03:00.123456+00:00", product="p1", category="books",
                         price=9.99, discount_code="SAVE10")),
    ]
    bad = [
        json.dumps(event("", "page_view", "2026-09-10T10:04:00")),
        json.dumps(event("b2", "page_view", None)),
        '{"event_id": "b3", "event_type": "page_view", "timestamp": "2026-09-10T1',
    ]
    return valid + bad


def test_t1_etl_sample_keeps_four_drops_three(spark, tmp_path):
    raw_dir = tmp_path / "raw" / "year=2026" / "month=09" / "day=10" / "hour=10"
    _write_lines(raw_dir, _sample_lines())
    raw = read_raw(spark, str(tmp_path / "raw"))
    assert raw.select("month").first()[0] == "09"  # partition values stay padded strings
    recon = etl(raw, str(tmp_path / "curated"), str(tmp_path / "quarantine")).first().asDict()
    assert recon["input_rows"] == 7 and recon["kept_rows"] == 4 and recon["dropped_rows"] == 3
    assert recon["malformed_json"] == 1 and recon["missing_event_id"] == 1 and recon["missing_timestamp"] == 1
    cur = read_curated(spark, str(tmp_path / "curated"))
    assert cur.columns == CURATED_COLUMNS
    assert cur.count() == 4
    parts = {tuple(r) for r in cur.select("year", "month", "day").distinct().collect()}
    assert parts == {("2026", "09", "10")}
    assert dict(cur.select("event_id", "discount_code").collect())["a4"] == "SAVE10"
    q = spark.read.parquet(str(tmp_path / "quarantine"))
    assert q.count() == 3
    assert {r[0] for r in q.select("error_type").collect()} == {"malformed_json", "missing_event_id",
                                                               "missing_timestamp"}


def test_t2_unparseable_time_strict_vs_literal(spark):
    df = edf(spark, [event("g1", ts="garbage")])
    good, bad = split_bad(df, strict=True)
    assert good.count() == 0
    assert bad.select("error_type").first()[0] == "unparseable_timestamp"
    good, bad = split_bad(df, strict=False)
    assert bad.count() == 0
    row = to_curated(good).first()
    assert row["year"] is None and row["month"] is None


def test_missing_discount_code_column_is_added(spark):
    df = edf(spark, [event("x1")], drop=("discount_code",))
    assert "discount_code" not in df.columns
    out = to_curated(df)
    assert out.columns == CURATED_COLUMNS
    assert dict(out.dtypes)["discount_code"] == "string"


def test_offset_timestamps_fall_on_utc_day(spark):
    df = edf(spark, [event("z1", ts="2026-09-10T23:30:00-05:00")])
    row = to_curated(df).first()
    assert (row["year"], row["month"], row["day"]) == ("2026", "09", "11")


def test_incremental_mode_keeps_other_days(spark, tmp_path):
    from shoplake.sources.sinks import write_curated
    d1 = to_curated(edf(spark, [event("d1", ts="2026-09-10T10:00:00")]))
    d2 = to_curated(edf(spark, [event("d2", ts="2026-09-11T10:00:00")]))
    path = str(tmp_path / "cur")
    write_curated(d1, path, mode="full")
    write_curated(d2, path, mode="incremental")
    assert read_curated(spark, path).count() == 2
    write_curated(d2, path, mode="full")
    assert read_curated(spark, path).count() == 1


def test_read_curated_date_range_prunes_partitions(spark, tmp_path):
    from shoplake.sources.sinks import write_curated
    rows = [event(f"r{i}", ts=f"2026-09-{10 + i:02d}T10:00:00") for i in range(3)]
    path = str(tmp_path / "cur")
    write_curated(to_curated(edf(spark, rows)), path)
    df = read_curated(spark, path, start_date="2026-09-11", end_date="2026-09-11")
    assert [r[0] for r in df.select("event_id").collect()] == ["r1"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert F is not None


def test_merge_schema_reads_old_and_new_files(spark, tmp_path):
    path = tmp_path / "cur"
    old = to_curated(edf(spark, [event("o1", ts="2026-09-10T10:00:00")])).drop("discount_code")
    old.write.partitionBy("year", "month", "day").parquet(str(path))
    new = to_curated(edf(spark, [event("n1", ts="2026-09-11T10:00:00", discount_code="VIP20")]))
    new.write.mode("append").partitionBy("year", "month", "day").parquet(str(path))
    rows = {r.event_id: r.discount_code for r in read_curated(spark, str(path), merge_schema=True).collect()}
    assert rows == {"o1": None, "n1": "VIP20"}


def test_revenue_scan_is_pruned_and_pushed(spark, tmp_path):
    from shoplake.operators.analytics import revenue_by_country_device
    from shoplake.sources.sinks import write_curated
    path = str(tmp_path / "cur")
    write_curated(to_curated(edf(spark, [event("p1", "purchase", product="p", category="b", price=1.0)])), path)
    plan = revenue_by_country_device(read_curated(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,purchase)" in plan
    assert "ReadSchema: struct<event_type:string,price:double,device_type:string,country:string>" in plan


def test_parse_and_serialise_json_text(spark):
    from shoplake.sources.raw import parse_events, to_json_events
    good = json.dumps(event("j1", "purchase", product="p", category="books", price=3.5))
    text = spark.createDataFrame([(1, good), (2, '{"event_id": "j2", "timest')], "offset int, value string")
    rows = {r.offset: r for r in parse_events(text).collect()}
    assert rows[1].event_id == "j1" and rows[1].price == 3.5 and rows[1]._corrupt_record is None
    assert rows[2]._corrupt_record is not None
    back = json.loads(to_json_events(parse_events(text).where("offset = 1")).first().value)
    assert back["event_id"] == "j1" and "discount_code" in back and back["discount_code"] is None


def test_sql_over_registered_views(spark, tmp_path):
    from shoplake.sources.raw import register_views
    from shoplake.sources.sinks import write_curated
    rows = [event("v1", "purchase", "2026-09-10T10:00:00", product="p", category="b", price=2.5),
            event("v2", "page_view", "2026-09-11T10:00:00")]
    write_curated(to_curated(edf(spark, rows)), str(tmp_path / "cur"))
    assert register_views(spark, curated_path=str(tmp_path / "cur")) == ["curated"]
    df = spark.sql("SELECT day, count(*) AS n FROM curated WHERE day = '11' GROUP BY day")
    assert [tuple(r) for r in df.collect()] == [("11", 1)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_etl_rerun_does_not_duplicate_quarantine(spark, tmp_path):
    raw_dir = tmp_path / "raw" / "year=2026" / "month=09" / "day=10" / "hour=10"
    _write_lines(raw_dir, _sample_lines())
    for _ in range(2):  # the same load twice
        etl(read_raw(spark, str(tmp_path / "raw")), str(tmp_path / "curated"), str(tmp_path / "quarantine"))
    q = spark.read.parquet(str(tmp_path / "quarantine"))
    assert q.count() == 3
    assert {tuple(r) for r in q.select("year", "month", "day").distinct().collect()} == {("2026", "09", "10")}
    assert read_curated(spark, str(tmp_path / "curated")).count() == 4


def test_full_load_clears_stale_quarantine(spark, tmp_path):
    raw_dir = tmp_path / "raw" / "year=2026" / "month=09" / "day=10" / "hour=10"
    _write_lines(raw_dir, _sample_lines())
    etl(read_raw(spark, str(tmp_path / "raw")), str(tmp_path / "curated"), str(tmp_path / "quarantine"))
    clean = tmp_path / "raw2" / "year=2026" / "month=09" / "day=10" / "hour=10"
    _write_lines(clean, _sample_lines()[:4])
    etl(read_raw(spark, str(tmp_path / "raw2")), str(tmp_path / "curated"), str(tmp_path / "quarantine"))
    assert spark.read.schema("event_id string, error_type string").parquet(str(tmp_path / "quarantine")).count() == 0


def test_unreadable_file_is_skipped_and_reported(spark, tmp_path):
    import gzip

    from shoplake.sources.raw import unread_files
    hour = tmp_path / "raw" / "year=2026" / "month=09" / "day=10" / "hour=10"
    _write_lines(hour, _sample_lines()[:4])
    good_gz = gzip.compress((json.dumps(event("g1", ts="2026-09-10T10:30:00")) + chr(10)).encode())
    (hour / "good one.jsonl.gz").write_bytes(good_gz + good_gz)  # two members, a blank in the name
    many = gzip.compress("".join(json.dumps(event(f"m{i}", ts="2026-09-10T10:30:00")) + chr(10) for i in range(5000)).encode())
    (hour / "broken.jsonl.gz").write_bytes(many[: len(many) // 2])  # cut in the middle, after many good lines
    raw = read_raw(spark, str(tmp_path / "raw"), skip_unreadable_files=True)
    assert raw.count() == 6  # the four lines of the plain file and the good gzip lines, none of the cut file
    missed = [r.path.rsplit("/", 1)[-1] for r in unread_files(spark, str(tmp_path / "raw")).collect()]
    assert missed == ["broken.jsonl.gz"]

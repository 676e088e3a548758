import json

from pyspark.sql import functions as F

from conftest import SF_SMALL, event
from shoplake.operators import analytics as A
from shoplake.plans import registry as R
from shoplake.streaming import jobs as S


def _write_json(path, records):
    path.mkdir(parents=True, exist_ok=True)
    (path / "part.jsonl").write_text("\n".join(json.dumps(r) for r in records) + "\n")


def _run(q):
    q.awaitTermination(300)
    assert q.exception() is None


def test_dedup_within_watermark(spark, tmp_path):
    recs = [event("1", ts="2026-09-10T10:00:00"), event("1", ts="2026-09-10T10:00:30"),
            event("2", ts="2026-09-10T10:01:00")]
    _write_json(tmp_path / "in", recs)
    stream = S.json_stream(spark, str(tmp_path / "in")).withColumn("event_ts", F.to_timestamp("timestamp"))
    out = str(tmp_path / "out")
    q = (S.dedup_stream(stream, delay="1 hour").drop("_corrupt_record").writeStream.format("parquet")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(out))
    _run(q)
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["1", "2"]


def test_split_stream_quarantines_bad_lines(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.jsonl").write_text(json.dumps(event("1")) + "\n" + '{"event_id": "x", "timest' + "\n"
                                 + json.dumps(event("", ts="2026-09-10T10:00:00")) + "\n")
    good = str(tmp_path / "good")

    def sink(batch, batch_id):
        S.write_batch(batch, good, batch_id)

    q = S.split_stream(S.json_stream(spark, str(src)), sink, str(tmp_path / "bad"), str(tmp_path / "ck"),
                       available_now=True)
    _run(q)
    assert spark.read.parquet(good).count() == 1
    bad = {r.error_type for r in spark.read.parquet(str(tmp_path / "bad")).select("error_type").collect()}
    assert bad == {"malformed_json", "missing_event_id"}


def test_stream_windows_equal_batch(spark):
    streamed = {tuple(r) for r in R.queries()["stream_events_per_5min"](spark, SF_SMALL).collect()}
    batch = {tuple(r) for r in A.events_per_window(R.curated(spark, SF_SMALL), 5).collect()}
    assert streamed == batch


def test_stream_session_stage_equals_batch(spark):
    streamed = {tuple(r) for r in R.queries()["stream_session_stage"](spark, SF_SMALL).collect()}
    df = R.curated(spark, SF_SMALL).select("session_id", S.stage_rank().alias("r")).where("r is not null")
    batch = {tuple(r) for r in df.groupBy("session_id").agg(F.max("r")).collect()}
    assert streamed == batch and len(batch) > 0


def test_event_time_landing_equals_batch_landing(spark):
    a = {tuple(r) for r in R.queries()["stream_landing_by_event_date"](spark, SF_SMALL).collect()}
    b = {tuple(r) for r in R.queries()["raw_landing_counts"](spark, SF_SMALL).collect()}
    assert a == b


def test_replayed_batch_is_not_duplicated(spark, tmp_path):
    df = spark.range(3)
    path = str(tmp_path / "t")
    S.write_batch(df, path, 0)
    S.write_batch(df, path, 0)  # the same micro-batch again, as after a failure
    S.write_batch(spark.range(2), path, 1)
    assert spark.read.parquet(path).count() == 5


def test_clean_source_and_trigger_caps(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for i in range(3):
        (src / f"f{i}.jsonl").write_text(json.dumps(event(str(i), ts=f"2026-09-10T10:0{i}:00")) + "\n")
    archive = tmp_path / "archive"
    stream = S.json_stream(spark, str(src), clean="archive", archive_dir=str(archive), max_files_per_trigger=1)
    out = str(tmp_path / "out")
    q = (stream.drop("_corrupt_record").writeStream.format("parquet")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(out))
    _run(q)
    assert spark.read.parquet(out).count() == 3
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3  # one file per micro-batch
    archived = [p for p in archive.rglob("*.jsonl")]
    assert len(archived) >= 1  # files are moved one batch after they were processed
    src2 = tmp_path / "in2"
    src2.mkdir()
    for i in range(2):
        (src2 / f"g{i}.jsonl").write_text(json.dumps(event(f"g{i}", ts="2026-09-10T10:00:00")) + "\n")
    size = (src2 / "g0.jsonl").stat().st_size
    capped = S.json_stream(spark, str(src2), max_bytes_per_trigger=size + 1).drop("_corrupt_record")
    q2 = (capped.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck2"))
          .trigger(availableNow=True).start(str(tmp_path / "out2")))
    _run(q2)
    assert [p["numInputRows"] for p in q2.recentProgress if p["numInputRows"] > 0] == [1, 1]  # byte cap per batch


def test_failed_runs_on_a_run_log_stream(spark, tmp_path):
    from shoplake.operators.ops import failed_runs
    src = tmp_path / "runs"
    src.mkdir()
    rows = [{"detail_type": "Glue Crawler State Change", "name": "c1", "state": "Failed", "at": "2026-09-20T10:00:00"},
            {"detail_type": "Glue Job State Change", "name": "j1", "state": "FAILED", "at": "2026-09-20T10:01:00"},
            {"detail_type": "Glue Crawler State Change", "name": "c2", "state": "FAILED", "at": "2026-09-20T10:02:00"}]
    (src / "a.json").write_text("\n".join(json.dumps(r) for r in rows) + "\n")
    stream = spark.readStream.schema("detail_type string, name string, state string, at timestamp").json(str(src))
    out = str(tmp_path / "alerts")
    q = (failed_runs(stream).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start(out))
    _run(q)
    assert sorted(r.name for r in spark.read.parquet(out).collect()) == ["c1", "j1"]


def test_dedup_into_hot_copies_and_across_batches(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    hot = [event("hot", ts="2026-09-10T10:00:00")] * 3000  # one event's copies dominate the stream
    (src / "f1.jsonl").write_text("\n".join(json.dumps(r) for r in hot + [event("a", ts="2026-09-10T10:01:00")]) + "\n")
    (src / "f2.jsonl").write_text("\n".join(json.dumps(r) for r in [event("hot", ts="2026-09-10T10:00:00"),
                                                                     event("b", ts="2026-09-11T09:00:00")]) + "\n")
    stream = (S.json_stream(spark, str(src), max_files_per_trigger=1).drop("_corrupt_record")
              .withColumn("event_ts", F.to_timestamp("timestamp")))
    out = str(tmp_path / "dedup")
    q = S.dedup_into(stream, out, str(tmp_path / "ck"), available_now=True)
    _run(q)
    rows = spark.read.parquet(f"{out}/data").select("event_id", "batch_id").collect()
    assert sorted(r.event_id for r in rows) == ["a", "b", "hot"]  # the copy in the second batch is dropped
    assert len({r.batch_id for r in rows}) == 2


def _stream_of(spark, src, batches):
    """One micro-batch per list of records."""
    import os
    src.mkdir()
    for i, recs in enumerate(batches):
        f = src / f"f{i}.jsonl"
        f.write_text("\n".join(json.dumps(r) for r in recs) + "\n")
        os.utime(f, (1_700_000_000 + 60 * i, 1_700_000_000 + 60 * i))
    return (S.json_stream(spark, str(src), max_files_per_trigger=1).drop("_corrupt_record")
            .withColumn("event_ts", F.try_to_timestamp("timestamp")))


def test_dedup_into_keeps_rows_without_time_or_key(spark, tmp_path):
    stream = _stream_of(spark, tmp_path / "in", [
        [event("a", ts=None), event("b", ts="2026-09-10T10:00:00")],  # a batch that starts with no time at all
        [event("c", ts="garbage"), event("c", ts=None)],  # only rows without a time
        [event("a", ts="2026-09-12T10:00:00"), event("b", ts=None), event(None, ts="2026-09-12T10:00:00"),
         event(None, ts=None), event("d", ts="2026-09-12T10:00:00")]])
    out = str(tmp_path / "dedup")
    _run(S.dedup_into(stream, out, str(tmp_path / "ck"), available_now=True))
    got = [r.event_id for r in spark.read.parquet(f"{out}/data").collect()]
    assert sorted(x or "" for x in got) == ["", "", "a", "b", "c", "d"]


def test_seen_runs_cover_all_earlier_batches():
    for k in (2, 3, 16):
        for b in range(200):
            runs = S.seen_runs(b, k)
            assert [x for level, start in runs for x in range(start, start + k ** level)] == list(range(b))
            assert len(runs) <= (k - 1) * (b.bit_length() + 1)


def test_dedup_into_folds_seen_keys(spark, tmp_path):
    days = [f"2026-09-{10 + i:02}" for i in range(9)]
    # Each batch: a new event of its day, a copy of the day before's, one of the first day's and one without a time.
    stream = _stream_of(spark, tmp_path / "in", [
        [event(f"e{i}", ts=f"{d}T10:00:00"), event(f"e{max(i - 1, 0)}", ts=f"{days[max(i - 1, 0)]}T10:00:00"), event("none", ts=None)]
        for i, d in enumerate(days)])
    out = tmp_path / "dedup"
    _run(S.dedup_into(stream, str(out), str(tmp_path / "ck"), available_now=True, fold_every=2, keep_days=3))
    got = sorted(r.event_id for r in spark.read.parquet(f"{out}/data").collect())
    assert got == sorted([f"e{i}" for i in range(9)] + ["none"])
    left = sorted(str(p.relative_to(out / "seen")) for p in (out / "seen").glob("level=*/start=*"))
    assert left == ["level=0/start=8", "level=3/start=0"]  # eight batches are one run
    kept = sorted(p.name for p in (out / "seen/level=3/start=0").glob("day=*"))
    assert kept == ["day=2026-09-14", "day=2026-09-15", "day=2026-09-16", "day=2026-09-17", "day=none"]


def test_late_rows_are_counted(spark, tmp_path):
    hours = [12, 13, 10]
    stream = _stream_of(spark, tmp_path / "in", [[event(f"{h}-{i}", ts=f"2026-09-10T{h}:0{i}:00", session=f"s{h}")
                                                  for i in range(4)] for h in hours])
    for minutes, path in ((5, str(tmp_path / "w5")), (7, str(tmp_path / "w7"))):
        _run(S.write_partials(stream, lambda b, m=minutes: S.window_counts(b, m), path, path + "-ck", available_now=True))
        assert sum(r.event_count for r in S.windowed_result(spark, path).collect()) == 12
        kept = S.compact_partials(spark, path, path + "-small", ["window_start"], "event_count", "sum", 1)
        assert kept.select("batch_id").distinct().count() == 2
        same = {tuple(r) for r in S.windowed_result(spark, path).collect()}
        assert {tuple(r) for r in S.windowed_result(spark, path + "-small").collect()} == same
    path = str(tmp_path / "stage")
    _run(S.write_partials(stream, S.session_stage, path, path + "-ck", available_now=True))
    assert {r.session_id for r in S.fold(spark, path, ["session_id"], "stage_rank", "max").collect()} == {"s10", "s12", "s13"}


def test_stream_counts_equal_the_outputs(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.jsonl").write_text(json.dumps(event("1")) + "\n" + json.dumps(event("2")) + "\n" + '{"event_id": "x", "ti\n')
    good = str(tmp_path / "good")
    q = S.split_stream(S.json_stream(spark, str(src)), lambda b, i: S.write_batch(b, good, i), str(tmp_path / "bad"),
                       str(tmp_path / "ck"), available_now=True)
    _run(q)
    counts = [p["observedMetrics"]["stream_counts"] for p in q.recentProgress if p["numInputRows"]]
    assert [(c["input_rows"], c["kept_rows"]) for c in counts] == [(3, 2)]
    assert spark.read.parquet(good).count() == 2


def test_stream_landing_files_per_batch(spark, tmp_path):
    import os
    src = tmp_path / "in"
    src.mkdir()
    for i in range(6):
        (src / f"f{i}.jsonl").write_text(json.dumps(event(str(i), ts="2026-09-10T10:00:00")) + "\n")
    out = str(tmp_path / "zone")
    q = S.land_stream(S.json_stream(spark, str(src)), out, str(tmp_path / "ck"), partition_time="event",
                      available_now=True, files_per_batch=2)
    _run(q)
    hour = os.path.join(out, "year=2026", "month=09", "day=10", "hour=10")
    files = [f for f in os.listdir(hour) if f.endswith(".gz")]
    assert 1 <= len(files) <= 2
    from shoplake.sources.raw import read_raw
    assert read_raw(spark, out).count() == 6


def test_parse_events_on_a_text_stream(spark, tmp_path):
    from shoplake.sources.raw import parse_events
    src = tmp_path / "msgs"
    src.mkdir()
    (src / "m.txt").write_text(json.dumps(event("m1", "purchase", product="p", category="toys", price=2.0)) + "\n"
                               + '{"event_id": "m2", "timest' + "\n")
    parsed = parse_events(spark.readStream.text(str(src)))
    out = str(tmp_path / "out")
    q = (parsed.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start(out))
    _run(q)
    rows = {r.event_id: r for r in spark.read.parquet(out).collect()}
    assert rows["m1"].price == 2.0 and rows["m1"]._corrupt_record is None
    assert any(r._corrupt_record is not None for r in rows.values())


def test_session_transitions_by_any_arrival(spark):
    from shoplake.streaming import jobs as S

    rows = [("a", "page_view", 1), ("a", "product_view", 2), ("a", "page_view", 3), ("a", "add_to_cart", 4), ("a", "purchase", 9),
            ("b", "add_to_cart", 1), ("b", "product_view", 5), ("b", "search", 50), ("c", "page_view", 58), (None, "purchase", 1), ("d", "search", 1)]
    df = spark.createDataFrame([(s, t, f"2026-09-10T10:{m:02d}:00") for s, t, m in rows], "session_id string, event_type string, timestamp string")
    log = S.session_firsts(df.where("event_type <> 'page_view'")).unionByName(S.session_firsts(df.where("event_type = 'page_view'")))
    got = {(r["session_id"], r["step"]): (r["from_stage"], r["to_stage"], r["reached_at"].minute, r["state"])
           for r in S.session_transitions(log, gap_minutes=5).collect()}
    assert got == {("a", 1): (None, "page_view", 1, "completed"), ("a", 2): ("page_view", "product_view", 2, "completed"),
                   ("a", 3): ("product_view", "add_to_cart", 4, "completed"), ("a", 4): ("add_to_cart", "purchase", 9, "completed"),
                   ("b", 1): (None, "add_to_cart", 1, "dropped"), ("c", 1): (None, "page_view", 58, "open")}


def test_expired_sessions_leave_the_log(spark, tmp_path):
    from shoplake.streaming import jobs as S

    rows = [("old", "page_view", 1), ("new", "page_view", 2), ("new", "purchase", 30)]
    df = spark.createDataFrame([(s, t, f"2026-09-10T10:{m:02d}:00") for s, t, m in rows], "session_id string, event_type string, timestamp string")
    for batch in (0, 1):
        S.write_batch(S.session_firsts(df), str(tmp_path / "log"), batch)
    before = S.session_transitions(spark.read.parquet(str(tmp_path / "log"))).where("session_id = 'new'").collect()
    kept = S.expire_sessions(spark, str(tmp_path / "log"), str(tmp_path / "kept"), 0, "2026-09-10 10:10:00")
    assert {r["session_id"] for r in kept.collect()} == {"new"}
    assert sorted(map(str, S.session_transitions(kept).collect())) == sorted(map(str, before))


def test_buffers_flush_by_size_or_time():
    import pandas as pd

    from shoplake.streaming.buffers import Buffers

    class Value:
        value = None
        exists = lambda self: self.value is not None
        get = lambda self: self.value

        def update(self, value):
            self.value = value

    class Handle:
        def getValueState(self, name, schema):
            return Value()

    buffers = Buffers("at", 100, 60)
    buffers.init(Handle())

    def send(sizes, second, first=0):
        rows = pd.DataFrame({"at": range(first, first + len(sizes)), "size": sizes, "arrived": second * 1000}).sample(frac=1, random_state=1)
        out = pd.concat(buffers.handleInputRows((3,), iter([rows[:1], rows[1:]]), None))
        return out.sort_values("at")["flush"].tolist()

    assert send([40, 40, 40, 40, 200, 10], 0) == [0, 0, 0, 1, 1, 2]  # the filling record closes its flush
    assert send([10, 10], 59, 10) == [2, 2]
    assert send([10], 60, 20) == [3]  # the open one was due a minute after its first record
    assert send([10], 119, 30) == [3] and send([10], 120, 40) == [4]

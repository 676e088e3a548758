import datetime as dt
import decimal

from shoplake.operators import ops as O


def test_t16_scan_cost(spark):
    log = spark.createDataFrame([("revenue", "json", 4350579), ("revenue", "parquet", 121131)],
                                "query_name string, source_format string, bytes_scanned bigint")
    rows = {r.source_format: r for r in O.scan_cost(log).collect()}
    assert round(rows["json"].cost_usd, 7) == 0.0000198
    assert round(rows["parquet"].cost_usd, 8) == 0.00000055
    assert rows["parquet"].reduction_pct == 97.22 and rows["json"].reduction_pct == 0.0


def test_t17_failed_runs_case_sensitive(spark):
    t = dt.datetime(2026, 9, 20)
    log = spark.createDataFrame([("Glue Crawler State Change", "c1", "Failed", t),
                                 ("Glue Job State Change", "j1", "FAILED", t),
                                 ("Glue Crawler State Change", "c2", "FAILED", t),
                                 ("Glue Job State Change", "j2", "SUCCEEDED", t)],
                                "detail_type string, name string, state string, at timestamp")
    assert sorted(r.name for r in O.failed_runs(log).collect()) == ["c1", "j1"]


def test_tier_audit(spark):
    inv = spark.createDataFrame([
        ("raw/a.json", 20_000, dt.datetime(2026, 1, 1)),     # 100 days -> glacier
        ("raw/b.json", 300_000, dt.datetime(2026, 3, 1)),    # 41 days -> IA
        ("raw/c.json", 1_000, dt.datetime(2026, 4, 1)),      # 10 days -> standard
        ("curated/d.parquet", 5_000, dt.datetime(2025, 1, 1)),
        ("athena-results/e.csv", 10, dt.datetime(2026, 4, 1)),
        ("athena-results/f.csv", 10, dt.datetime(2026, 4, 9)),
    ], "key string, size_bytes bigint, last_modified timestamp")
    rows = {(r.prefix, r.tier): (r.objects, r.bytes, r.billable_bytes)
            for r in O.tier_audit(inv, O.lifecycle_rules(spark), "2026-04-11").collect()}
    assert rows[("raw/", "GLACIER_IR")] == (1, 20_000, 128 * 1024)
    assert rows[("raw/", "STANDARD_IA")] == (1, 300_000, 300_000)
    assert rows[("raw/", "STANDARD")] == (1, 1_000, 1_000)
    assert rows[("curated/", "STANDARD")] == (1, 5_000, 5_000)
    assert rows[("athena-results/", "EXPIRED")][0] == 1
    assert rows[("athena-results/", "STANDARD")][0] == 1


def test_budget_status_and_spend(spark):
    d = decimal.Decimal
    bill = spark.createDataFrame([
        (dt.date(2026, 9, 1), "S3", "shop-lake", d("100.000000000")),
        (dt.date(2026, 9, 2), "Glue", "shop-lake", d("30.500000000")),
        (dt.date(2026, 9, 2), "EC2", "other", d("500.000000000")),
    ], "usage_date date, service string, project_tag string, cost_usd decimal(18,9)")
    rows = {(r.budget, r.threshold_pct): r.crossed
            for r in O.budget_status(bill, O.budgets(spark, "shop-lake")).collect()}
    assert rows == {("soft-limit", 80): True, ("soft-limit", 100): False, ("hard-stop", 100): False}
    spend = {r.service: r.pct_of_month for r in O.spend_by_service(bill).collect()}
    assert spend["EC2"] == 79.3


def test_compaction(spark, tmp_path):
    from conftest import edf, event
    from shoplake.operators.etl import to_curated
    rows = [event(str(i), ts=f"2026-09-1{i % 2}T10:00:00") for i in range(40)]
    df = to_curated(edf(spark, rows)).repartition(8)
    src = str(tmp_path / "small")
    df.write.partitionBy("year", "month", "day").parquet(src)
    out = O.compact(spark, src, str(tmp_path / "big"), ["year", "month", "day"]).collect()
    res = {r.partition: (r.files_before, r.files_after) for r in out}
    assert set(res) == {"year=2026/month=09/day=10", "year=2026/month=09/day=11"}
    assert all(before > after == 1 for before, after in res.values())
    assert all(r.rows_before == r.rows_after == 20 for r in out)
    assert spark.read.parquet(str(tmp_path / "big")).count() == 40


def test_constant_table_types_and_quotes(spark):
    from shoplake.functions.tables import constant_table
    df = constant_table(spark, [("it's", 1, 2.5, None), ("b\\c", 2, 0.0, True)],
                        [("s", "string"), ("i", "int"), ("d", "double"), ("f", "boolean")])
    assert df.dtypes == [("s", "string"), ("i", "int"), ("d", "double"), ("f", "boolean")]
    assert [tuple(r) for r in df.collect()] == [("it's", 1, 2.5, None), ("b\\c", 2, 0.0, True)]
    empty = constant_table(spark, [], [("s", "string")])
    assert empty.count() == 0 and empty.dtypes == [("s", "string")]
    assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()


def test_list_objects_dates_by_partition_and_tiers(spark, tmp_path):
    from conftest import edf, event
    from shoplake.operators.landing import land_batch
    root = str(tmp_path / "lake")
    land_batch(edf(spark, [event("1", ts="2026-01-05T10:00:00")]), f"{root}/raw")
    inv = O.list_objects(spark, root)
    keys = [r.key for r in inv.collect()]
    assert keys and all(k.startswith("raw/year=2026/month=01/day=05/hour=10/") for k in keys)
    assert {str(r.last_modified.date()) for r in inv.collect()} == {"2026-01-05"}
    rows = {(r.prefix, r.tier): r.objects for r in O.tier_audit(inv, O.lifecycle_rules(spark), "2026-04-20").collect()}
    assert rows == {("raw/", "GLACIER_IR"): len(keys)}  # 105 days old


def test_compaction_labels_ignore_folders_above_the_table(spark, tmp_path):
    from conftest import edf, event
    from shoplake.operators.etl import to_curated
    df = to_curated(edf(spark, [event(str(i), ts="2026-09-10T10:00:00") for i in range(10)])).repartition(4)
    src = str(tmp_path / "v=1" / "cur")
    df.write.partitionBy("year", "month", "day").parquet(src)
    out = O.compact(spark, src, str(tmp_path / "v=2" / "cur"), ["year", "month", "day"]).collect()
    assert [(r.partition, r.files_after, r.rows_before, r.rows_after) for r in out] == [
        ("year=2026/month=09/day=10", 1, 10, 10)]


def test_the_longest_prefix_governs(spark):
    rules = O.lifecycle_rules(spark, [("raw/", 30, "STANDARD_IA"), ("raw/", 90, "GLACIER_IR"), ("raw/keep/", 400, "EXPIRE"),
                                      ("raw/keep/x", 5, "STANDARD_IA"), ("results/", 7, "EXPIRE")])
    inv = spark.sql("""SELECT * FROM VALUES ('raw/a', 10L, TIMESTAMP '2026-01-01'), ('raw/keep/b', 10L, TIMESTAMP '2026-01-01'),
                       ('raw/keep/xy', 10L, TIMESTAMP '2026-04-01'), ('rawer/c', 10L, TIMESTAMP '2020-01-01'), ('top', 10L, TIMESTAMP '2020-01-01'),
                       ('results/d', 10L, TIMESTAMP '2026-04-09'), ('results/e', 10L, TIMESTAMP '2026-04-01'), (NULL, 10L, NULL)
                       AS t(key, size_bytes, last_modified)""")
    got = {r.key: (r.prefix, r.tier) for r in O.object_tiers(inv, rules, "2026-04-11").collect()}
    assert got == {"raw/a": ("raw/", "GLACIER_IR"), "raw/keep/b": ("raw/keep/", "STANDARD"), "raw/keep/xy": ("raw/keep/x", "STANDARD_IA"),
                   "rawer/c": ("rawer/", "STANDARD"), "top": ("top/", "STANDARD"), "results/d": ("results/", "STANDARD"),
                   "results/e": ("results/", "EXPIRED"), None: (None, "STANDARD")}


def test_row_groups_outside_the_filter_are_not_scanned(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    (tmp_path / "t").mkdir()
    pq.write_table(pa.table({"k": list(range(4000)), "v": [f"{i:040d}" for i in range(4000)]}), tmp_path / "t" / "f.parquet", row_group_size=1000)
    whole, part, none = (O.scan_bytes(spark, str(tmp_path / "t"), "parquet", ["v"], r).first()["bytes_scanned"]
                         for r in (None, {"k": (500, 1500)}, {"k": (-5, -1)}))
    assert none < part < 0.6 * whole

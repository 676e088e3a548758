import json

from conftest import edf, event
from shoplake.operators import quality as Q
from shoplake.operators.catalog import missing_partitions, refresh_table
from shoplake.operators.etl import to_curated
from shoplake.schema import CURATED_PARTITIONS, EVENT_COLUMNS, EVENT_SCHEMA
from shoplake.sources.sinks import write_curated


def _funnel_rows(counts):
    rows, i = [], 0
    for stage, n in counts.items():
        for _ in range(n):
            i += 1
            rows.append(event(str(i), stage))
    return rows


def test_t10_funnel_shape(spark):
    good = edf(spark, _funnel_rows({"page_view": 100, "product_view": 40, "add_to_cart": 15,
                                               "checkout_start": 10, "purchase": 7}))
    assert all(r.passed for r in Q.check_funnel(good).collect())
    bad = edf(spark, _funnel_rows({"page_view": 10, "product_view": 12, "purchase": 5}))
    res = {r.rule: r.passed for r in Q.check_funnel(bad).collect()}
    assert res["stage_positive:add_to_cart"] is False
    assert res["falls:page_view>product_view"] is False
    assert res["purchase_rate"] is False


def test_stage_rates(spark):
    df = edf(spark, _funnel_rows({"page_view": 100, "product_view": 40, "add_to_cart": 15,
                                             "checkout_start": 10, "purchase": 7}))
    rows = {(r.from_stage, r.to_stage): r.observed_rate for r in Q.check_stage_rates(df).collect()}
    assert rows[("page_view", "product_view")] == 0.4 and rows[("checkout_start", "purchase")] == 0.7


def test_t11_key_set(spark):
    full = {c: None for c in EVENT_COLUMNS}
    full.update(event_id="1", timestamp="2026-09-10T10:00:00")
    extra = dict(full, surprise=1)
    short = {k: v for k, v in full.items() if k != "discount_code"}
    text = spark.createDataFrame([(json.dumps(full),), (json.dumps(extra),), (json.dumps(short),)], "value string")
    rows = {(r.key, r.problem): r.rows for r in Q.check_keys(text).collect()}
    assert rows == {("surprise", "unexpected"): 1, ("discount_code", "missing"): 1}


def test_t9_absent_vs_null_profile(spark):
    early = json.dumps({"event_id": "1", "timestamp": "2026-09-10T10:00:00"})
    late_null = json.dumps({"event_id": "2", "timestamp": "2026-09-10T11:00:00", "discount_code": None})
    late_code = json.dumps({"event_id": "3", "timestamp": "2026-09-10T11:10:00", "discount_code": "VIP20"})
    text = spark.createDataFrame([(early,), (late_null,), (late_code,)], "value string")
    rows = {r.window_start.hour: (r.rows, r.present_rows, r.null_rows) for r in Q.schema_profile(text, 60).collect()}
    assert rows == {10: (1, 0, 1), 11: (2, 2, 1)}


def test_duplicates_domains_and_product_rule(spark):
    df = edf(spark, [event("1", "page_view"), event("1", "purchase", product=None, country="XX"),
                                event("2", "search", product="p9")])
    assert [(r.event_id, r.occurrences) for r in Q.check_duplicate_ids(df).collect()] == [("1", 2)]
    viol = {(r.column_name, r.value): r.rows for r in Q.check_domains(df).collect()}
    assert viol == {("country", "XX"): 1}
    pres = {r.event_type: r.violations for r in Q.check_product_presence(df).collect()}
    assert pres == {"page_view": 0, "purchase": 1, "search": 1}


def test_partition_mismatch(spark):
    rows = [dict(event("1", ts="2026-09-10T10:00:00"), year="2026", month="09", day="10", hour="10"),
            dict(event("2", ts="2026-09-10T10:00:00"), year="2026", month="9", day="10", hour="10")]
    res = Q.check_partitions(edf(spark, rows)).collect()
    assert len(res) == 1 and res[0].month == "9" and res[0].event_month == "09"


def test_t18_missing_partition_found(spark, tmp_path):
    days = [event(str(i), ts=f"2026-09-{10 + i:02d}T10:00:00") for i in range(3)]
    df = to_curated(edf(spark, days))
    path = str(tmp_path / "cur")
    write_curated(df.where("day < '12'"), path)
    refresh_table(spark, "t18_curated", path, EVENT_SCHEMA, CURATED_PARTITIONS)
    write_curated(df.where("day = '12'"), path, mode="incremental")
    missing = [r.partition for r in missing_partitions(spark, "t18_curated", path, CURATED_PARTITIONS).collect()]
    assert missing == ["year=2026/month=09/day=12"]
    assert spark.table("t18_curated").count() == 2  # the catalog silently skips the new day
    refresh_table(spark, "t18_curated", path, EVENT_SCHEMA, CURATED_PARTITIONS)
    assert spark.table("t18_curated").count() == 3


def test_catalog_add_columns(spark, tmp_path):
    from pyspark.sql import types as T

    from shoplake.operators.catalog import add_columns
    from shoplake.schema import RAW_FIELDS
    df = to_curated(edf(spark, [event("c1", ts="2026-09-10T10:00:00")]))
    path = str(tmp_path / "cur")
    write_curated(df, path)
    old = T.StructType([T.StructField(n, t) for n, t in RAW_FIELDS if n != "discount_code"])
    refresh_table(spark, "evolving_curated", path, old, CURATED_PARTITIONS)
    assert "discount_code" not in spark.table("evolving_curated").columns
    add_columns(spark, "evolving_curated", [T.StructField("discount_code", T.StringType())])
    assert "discount_code" in spark.table("evolving_curated").columns
    assert spark.table("evolving_curated").count() == 1


def test_publish_version_swaps_readers_atomically(spark, tmp_path):
    from shoplake.operators.catalog import publish_version
    v1 = to_curated(edf(spark, [event("a", ts="2026-09-10T10:00:00")]))
    v2 = to_curated(edf(spark, [event("b", ts="2026-09-10T10:00:00"), event("c", ts="2026-09-11T10:00:00")]))
    write_curated(v1, str(tmp_path / "v=1"))
    publish_version(spark, "curated_live", str(tmp_path / "v=1"), EVENT_SCHEMA, CURATED_PARTITIONS)
    assert [r.event_id for r in spark.table("curated_live").collect()] == ["a"]
    write_curated(v2, str(tmp_path / "v=2"))  # readers still see version 1 while this is written
    assert spark.table("curated_live").count() == 1
    publish_version(spark, "curated_live", str(tmp_path / "v=2"), EVENT_SCHEMA, CURATED_PARTITIONS)
    assert sorted(r.event_id for r in spark.table("curated_live").collect()) == ["b", "c"]

"""A user owning a third of all events must not end up in one join task."""

from pyspark.sql import functions as F

from shoplake.operators import analytics as A
from shoplake.sources.adapter import conform_events

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_user_join_is_split_and_results_whole(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        n = 300000
        events = spark.range(n).select(
            F.col("id").alias("event_id"),
            (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                                                    F.col("id") % 86400)).alias("ts"),
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).cast("bigint").alias("user_id"),
            F.element_at(F.array(*[F.lit(t) for t in ["view", "click", "purchase"]]),
                         (F.col("id") % 3 + 1).cast("int")).alias("event_type"),
            F.lit(1.0).alias("value"),
            F.format_string('{"k": %d}', F.col("id") % 100).alias("props"))
        users = spark.range(500).select(F.col("id").alias("user_key"), F.lit("SEG").alias("device_type"),
                                        F.lit("NATION").alias("country"))
        conformed = conform_events(events, users)
        total = sum(r.event_count for r in A.event_type_counts(conformed).collect())
        assert total == n  # nothing dropped or capped
        # Rows with distinct payload cross the join here (the shuffle sizes of the identical rows of
        # the hot user compress to nearly nothing otherwise, which hides the skew).
        stats = A.session_stats(conformed)
        rows = stats.collect()
        assert sum(1 for r in rows if r.session_id.startswith("7-")) == 1
        plan = stats._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan
        assert "SortMergeJoin" in plan and "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_day_is_split_across_write_tasks(spark, tmp_path):
    import os

    from shoplake.schema import CURATED_COLUMNS
    from shoplake.sources.sinks import write_curated

    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.coalescePartitions.enabled": "true"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 200000
        day = F.when(F.col("id") % 10 < 9, F.lit("01")).otherwise(F.lpad(((F.col("id") % 28) + 1).cast("string"), 2, "0"))
        df = spark.range(n).select(
            F.col("id").cast("string").alias("event_id"), F.lit("page_view").alias("event_type"),
            F.lit("u").alias("user_id"), F.col("id").cast("string").alias("session_id"),
            F.lit("2026-09-01T00:00:00").alias("timestamp"), F.lit(None).cast("string").alias("product_id"),
            F.lit(None).cast("string").alias("category"), F.lit(None).cast("double").alias("price"),
            F.lit("mobile").alias("device_type"), F.lit("direct").alias("referrer"), F.lit("US").alias("country"),
            F.lit(None).cast("string").alias("discount_code"), F.lit("2026").alias("year"), F.lit("09").alias("month"),
            day.alias("day"))
        path = str(tmp_path / "cur")
        write_curated(df.select(*CURATED_COLUMNS), path)
        hot = os.path.join(path, "year=2026", "month=09", "day=01")
        files = [f for f in os.listdir(hot) if f.endswith(".parquet")]
        assert len(files) > 1  # the hot day was split across tasks
        assert spark.read.parquet(path).count() == n
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

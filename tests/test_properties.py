"""Property tests: Spark expressions against plain Python on many generated cases per job."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoplake.functions import money_mean, window_key, window_start

cents_lists = st.lists(st.integers(min_value=0, max_value=10_000_000), min_size=1, max_size=40)


@settings(max_examples=5, deadline=None)
@given(st.lists(cents_lists, min_size=1, max_size=60))
def test_money_mean_is_exact_half_up(spark, groups):
    rows = [(g, c / 100.0) for g, cents in enumerate(groups) for c in cents]
    df = spark.createDataFrame(rows, "g int, price double")
    got = {r.g: r.m for r in df.groupBy("g").agg(
        money_mean(F.sum((F.col("price").cast("decimal(18,2)") * 100).cast("bigint")), F.count("price")).alias("m"))
        .collect()}
    for g, cents in enumerate(groups):
        want = (Decimal(sum(cents)) / Decimal(len(cents)) / 100).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert got[g] == float(want), (g, cents)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2100, 1, 1)),
                min_size=1, max_size=80),
       st.integers(min_value=1, max_value=60))
def test_window_start_is_hour_aligned(spark, stamps, minutes):
    df = spark.createDataFrame([(s,) for s in stamps], "ts timestamp_ntz")
    got = [(r.ts, r.w, r.k) for r in df.select("ts", window_start("ts", minutes).alias("w"),
                                               window_key(window_start("ts", minutes)).alias("k")).collect()]
    for ts, w, k in got:
        start = ts.replace(minute=(ts.minute // minutes) * minutes, second=0, microsecond=0)
        assert w == start and k == start.strftime("%Y%m%d_%H%M")

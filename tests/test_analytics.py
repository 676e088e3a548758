from conftest import edf, event
from shoplake.operators import analytics as A


def _df(spark, rows):
    from shoplake.operators.etl import to_curated
    return to_curated(edf(spark, rows))


def test_t12_pivot_gap_is_zero(spark):
    df = _df(spark, [event("1", "purchase", product="p", category="books", price=10.0, country="US",
                           device_type="mobile"),
                     event("2", "purchase", product="p", category="books", price=5.5, country="GB",
                           device_type="tablet")])
    rows = {r.country: r.asDict() for r in A.revenue_pivot(df).collect()}
    assert rows["US"] == {"country": "US", "mobile": 10.0, "desktop": 0.0, "tablet": 0.0, "other": 0.0}
    assert rows["GB"]["tablet"] == 5.5 and rows["GB"]["mobile"] == 0.0


def test_t13_zero_denominator_gives_null(spark):
    df = _df(spark, [event("1", "add_to_cart", product="p", category="toys", price=1.0)])
    row = A.funnel_by_category(df).first()
    assert row.viewed_sessions == 0 and row.added_to_cart_sessions == 1
    assert row.view_to_cart_pct is None and row.view_to_purchase_pct is None
    assert row.cart_to_purchase_pct == 0.0


def test_t14_null_session_cart_is_abandoned(spark):
    df = _df(spark, [event("1", "add_to_cart", session=None, product="p1", category="toys", price=1.0),
                     event("2", "purchase", session=None, product="p1", category="toys", price=1.0),
                     event("3", "add_to_cart", session="s", product="p2", category="toys", price=1.0),
                     event("4", "purchase", session="s", product="p2", category="toys", price=1.0)])
    rows = {r.product_id: r.abandoned_count for r in A.abandoned_cart_products(df).collect()}
    assert rows == {"p1": 1}


def test_funnel_stages_are_independent_sets_and_no_expand(spark):
    df = _df(spark, [event("1", "purchase", session="s1", product="p", category="books", price=1.0),
                     event("2", "product_view", session="s2", product="p", category="books", price=1.0),
                     event("3", "product_view", session="s2", product="q", category="books", price=1.0)])
    row = A.funnel_by_category(df).first()
    assert (row.viewed_sessions, row.added_to_cart_sessions, row.purchased_sessions) == (1, 0, 1)
    assert row.view_to_purchase_pct == 100.0
    assert "Expand" not in A.funnel_by_category(df)._jdf.queryExecution().executedPlan().toString()
    overall = A.funnel_overall(df).first()
    assert (overall.viewed, overall.added_to_cart, overall.checkout_started, overall.purchased) == (1, 0, 0, 1)


def test_revenue_mean_rounds_half_up_exactly(spark):
    df = _df(spark, [event("1", "purchase", product="p", category="books", price=10.00),
                     event("2", "purchase", product="p", category="books", price=10.01)])
    row = A.revenue_by_country_device(df).first()
    assert row.purchase_count == 2 and row.total_revenue == 20.01
    assert row.avg_order_value == 10.01  # 10.005 rounds half up


def test_session_engagement_complete_seconds(spark):
    df = _df(spark, [event("1", "page_view", "2026-09-10T10:00:00.900", session="s1"),
                     event("2", "product_view", "2026-09-10T10:00:10.100", session="s1", product="p",
                           category="books", price=1.0),
                     event("3", "purchase", "2026-09-10T11:00:00", session="s2", product="p", category="books",
                           price=1.0)])
    row = A.session_engagement(df).first()
    assert row.total_sessions == 2
    assert row.avg_session_duration_seconds == 4.5  # (9 + 0) / 2
    assert row.avg_pages_per_session == 1.0


def test_revenue_trend_and_dated(spark):
    df = _df(spark, [event("1", "purchase", "2026-09-09T10:00:00", product="p", category="b", price=1.25),
                     event("2", "purchase", "2026-09-10T10:00:00", product="p", category="b", price=2.5),
                     event("3", "purchase", "2026-09-10T12:00:00", product="p", category="b", price=2.5)])
    trend = [tuple(r) for r in A.revenue_trend(df).collect()]
    assert trend == [("2026", "09", "09", 1, 1.25), ("2026", "09", "10", 2, 5.0)]
    dated = A.revenue_trend_dated(df).collect()
    assert str(dated[1].date) == "2026-09-10" and dated[1].daily_revenue == 5.0


def test_union_zones_fills_missing_columns(spark):
    batch = edf(spark, [event("1", discount_code="VIP20")])
    stream = edf(spark, [event("2")], drop=("discount_code",))
    rows = {r.event_id: r.discount_code for r in A.union_zones(batch, stream).collect()}
    assert rows == {"1": "VIP20", "2": None}


def test_funnel_counts_zero_when_event_types_are_null(spark):
    df = _df(spark, [event("1", None, product="p", category="toys", price=1.0)])
    row = A.funnel_by_category(df).first()
    assert (row.viewed_sessions, row.added_to_cart_sessions, row.purchased_sessions) == (0, 0, 0)


def test_category_with_only_null_sessions_stays(spark):
    df = edf(spark, [event("1", "product_view", session=None, category="toys"), event("2", "purchase", session="s", category="books")])
    rows = {r.category: (r.viewed_sessions, r.purchased_sessions) for r in A.funnel_by_category(df).collect()}
    assert rows == {"toys": (0, 0), "books": (0, 1)}


def test_pivot_keeps_revenue_of_other_devices(spark):
    df = edf(spark, [dict(event(str(i), "purchase", price=p), device_type=d)
                     for i, (p, d) in enumerate([(3.0, "mobile"), (5.0, "tv"), (2.0, None)])])
    row = A.revenue_pivot(df).first()
    assert (row.mobile, row.desktop, row.other) == (3.0, 0.0, 7.0)


def test_abandoned_carts_read_the_events_once(spark):
    df = edf(spark, [event("1", "add_to_cart", session=None, product="p"), event("2", "purchase", session=None, product="p"),
                     event("3", "add_to_cart", session="s", product="q"), event("4", "purchase", session="s", product="q"),
                     event("5", "add_to_cart", session="t", product="q")])
    got = A.abandoned_cart_products(df)
    assert sorted(tuple(r) for r in got.collect()) == [("p", 1), ("q", 1)]
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_times_need_a_date_and_a_time_of_day(spark):
    from shoplake.functions import parse_ts
    texts = ["2026-09-10T10:00:00", "2026-09-10 10:00", "2026-09-10T10:00:00.123456+02:00", "2026-09-10T10:00:00Z",
             "12:00:00", "T10:00", "2026", "2026-09-10", "20260910T100000Z", "x2026-09-10T10:00:00", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_ts("t").isNotNull().alias("ok"))
    assert [r.ok for r in df.collect()] == [True] * 4 + [False] * 7


def test_mean_of_refunds_and_large_totals(spark):
    from shoplake.functions import money_mean
    df = spark.createDataFrame([(-5, 2), (5, 2), (4 * 10**18, 3), (7, 0)], "c bigint, n bigint")
    got = [r.m for r in df.select(money_mean("c", "n").alias("m")).collect()]
    assert got[:2] == [-0.03, 0.03] and got[2] == float(1333333333333333333) / 100.0 and got[3] is None

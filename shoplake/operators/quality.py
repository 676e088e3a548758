"""Data-quality checks as jobs over any event table.

Each check returns a small frame of findings. Reference lists (stages, domains, expected keys) are
fixed and tiny, so they are broadcast; the event side is only ever aggregated or anti-joined, never
collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.functions import date_parts, parse_ts, window_start
from shoplake.schema import (
    CATEGORIES,
    COUNTRIES,
    DEVICE_TYPES,
    EVENT_COLUMNS,
    EVENT_TYPES,
    FUNNEL_STAGES,
    NO_PRODUCT_EVENTS,
    PURCHASE_RATE_BOUNDS,
    REFERRERS,
    STAGE_RATES,
)

DOMAINS = {
    "event_type": EVENT_TYPES,
    "device_type": DEVICE_TYPES,
    "referrer": REFERRERS,
    "country": COUNTRIES,
    "category": CATEGORIES,
}


def _stage_counts(df: DataFrame) -> DataFrame:
    """One row: the number of events of every funnel stage, ``n0`` .. ``n4`` (0 when absent).

    A single pass with conditional counts; the aggregate is partial per task, so the final step
    sees one row per task whatever the size of ``df``.
    """
    return df.agg(*[F.count(F.when(F.col("event_type") == F.lit(stage), F.lit(1))).alias(f"n{i}")
                    for i, stage in enumerate(FUNNEL_STAGES)])


def _rule(name: str, observed, lower, upper):
    as_double = [F.lit(None).cast("double") if v is None else (v if isinstance(v, F.Column) else F.lit(float(v)))
                 for v in (observed, lower, upper)]
    return F.struct(F.lit(name).alias("rule"), as_double[0].cast("double").alias("observed"),
                    as_double[1].cast("double").alias("lower"), as_double[2].cast("double").alias("upper"))


def check_funnel(df: DataFrame) -> DataFrame:
    """Funnel shape rules -> ``rule, observed, lower, upper, passed`` (bounds exclusive).

    Every stage has events; each stage has fewer events than the one before; the page_view ->
    purchase rate lies strictly inside ``PURCHASE_RATE_BOUNDS``. One scan of ``df``.
    """
    n = [F.col(f"n{i}") for i in range(len(FUNNEL_STAGES))]
    rules = [_rule(f"stage_positive:{stage}", n[i], 0.0, None) for i, stage in enumerate(FUNNEL_STAGES)]
    rules += [_rule(f"falls:{FUNNEL_STAGES[i - 1]}>{FUNNEL_STAGES[i]}", n[i], None, n[i - 1])
              for i in range(1, len(FUNNEL_STAGES))]
    lo, hi = PURCHASE_RATE_BOUNDS
    rate = F.round(n[-1].cast("double") / F.nullif(n[0], F.lit(0)), 6)
    rules.append(_rule("purchase_rate", rate, lo, hi))
    table = _stage_counts(df).select(F.inline(F.array(*rules)))
    passed = (F.col("observed").isNotNull()
              & (F.col("lower").isNull() | (F.col("observed") > F.col("lower")))
              & (F.col("upper").isNull() | (F.col("observed") < F.col("upper"))))
    return table.select("rule", "observed", "lower", "upper", F.coalesce(passed, F.lit(False)).alias("passed"))


def check_stage_rates(df: DataFrame, expected: Sequence[tuple[str, str, float]] = STAGE_RATES) -> DataFrame:
    """Designed vs. observed step conversion ``from_stage, to_stage, expected_rate, observed_rate``.

    Stages must be funnel stages. One scan of ``df``.
    """
    idx = {stage: i for i, stage in enumerate(FUNNEL_STAGES)}
    rows = [F.struct(F.lit(a).alias("from_stage"), F.lit(b).alias("to_stage"),
                     F.lit(float(r)).alias("expected_rate"),
                     F.round(F.col(f"n{idx[b]}").cast("double") / F.nullif(F.col(f"n{idx[a]}"), F.lit(0)), 4)
                     .alias("observed_rate"))
            for a, b, r in expected]
    return _stage_counts(df).select(F.inline(F.array(*rows)))


def check_duplicate_ids(df: DataFrame) -> DataFrame:
    """``event_id, occurrences`` for ids seen more than once."""
    return (df.groupBy("event_id").agg(F.count(F.lit(1)).alias("occurrences"))
            .where(F.col("occurrences") > 1))


def check_keys(raw_text: DataFrame, expected: Sequence[str] = EVENT_COLUMNS) -> DataFrame:
    """Over raw JSON lines, ``key, problem, rows`` for keys missing from or foreign to the record."""
    exp = F.array(*[F.lit(k) for k in expected])
    # Both differences of a record in one array, so that the lines are read and parsed once.
    label = lambda array, problem: F.transform(array, lambda k: F.struct(
        k.alias("key"), F.lit(problem).alias("problem")))
    parsed = raw_text.select(F.json_object_keys("value").alias("keys")).where(F.col("keys").isNotNull())
    found = parsed.select(F.explode(F.concat(label(F.array_except(exp, "keys"), "missing"),
                                             label(F.array_except("keys", exp), "unexpected"))).alias("f"))
    return found.groupBy("f.key", "f.problem").agg(F.count(F.lit(1)).alias("rows"))


def check_domains(df: DataFrame, domains: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """``column_name, value, rows`` for non-null values outside their domain."""
    # Only what lies outside of its domain leaves the row.
    outside = [F.when(F.col(c).isNotNull() & ~F.col(c).cast("string").isin(*values), F.struct(
        F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")))
        for c, values in (domains or DOMAINS).items()]
    found = df.select(F.explode(F.array_compact(F.array(*outside))).alias("cv"))
    return found.groupBy("cv.column_name", "cv.value").agg(F.count(F.lit(1)).alias("rows"))


def check_partitions(raw: DataFrame) -> DataFrame:
    """Raw rows whose path partitions differ from the date parts of their own event time.

    Returns ``year, month, day, hour, event_year, event_month, event_day, event_hour, rows``.
    """
    parts = date_parts(parse_ts("timestamp"))
    own = raw.select("year", "month", "day", "hour",
                     *[parts[p].alias(f"event_{p}") for p in ("year", "month", "day", "hour")])
    differs = F.lit(False)
    for p in ("year", "month", "day", "hour"):
        differs = differs | ~F.col(p).eqNullSafe(F.col(f"event_{p}"))
    return (own.where(differs).groupBy(*own.columns).agg(F.count(F.lit(1)).alias("rows")))


def check_product_presence(df: DataFrame) -> DataFrame:
    """Per event type, ``events`` and ``violations`` of the product rule.

    page_view and search carry no product; every other type carries one.
    """
    no_product = F.col("event_type").isin(*NO_PRODUCT_EVENTS)
    bad = (no_product & F.col("product_id").isNotNull()) | (~no_product & F.col("product_id").isNull())
    return df.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.count(F.when(bad, F.lit(1))).alias("violations"))


def schema_profile(raw_text: DataFrame, minutes: int = 60, fields: Sequence[str] = ("discount_code",)) -> DataFrame:
    """Per event-time window and field, ``rows``, ``present_rows`` (key in the record) and
    ``null_rows`` (key absent or null); tells a key that is absent apart from one that is null.

    Each line is parsed twice whatever the number of fields: once for its key set, once by
    ``json_tuple`` for the timestamp and all profiled values together.
    """
    fields = list(fields)
    values = F.json_tuple("value", "timestamp", *fields)
    base = raw_text.select(F.json_object_keys("value").alias("keys"), values)
    ts = parse_ts("c0").cast("timestamp_ntz")
    per_field = base.select(
        window_start(ts, minutes).alias("window_start"),
        F.explode(F.array(*[F.struct(
            F.lit(f).alias("field"),
            F.coalesce(F.array_contains("keys", F.lit(f)), F.lit(False)).alias("present"),
            F.col(f"c{i + 1}").isNull().alias("is_null")) for i, f in enumerate(fields)])).alias("f"))
    return (per_field.groupBy("window_start", F.col("f.field").alias("field"))
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.count(F.when(F.col("f.present"), F.lit(1))).alias("present_rows"),
                 F.count(F.when(F.col("f.is_null"), F.lit(1))).alias("null_rows")))

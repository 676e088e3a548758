"""Column expressions shared by the jobs. All are built-in Spark expressions (JVM side, codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cost of scanned data, dollars per TiB (fixed value of the query service's price list).
USD_PER_TIB = 5.00
TIB = 2 ** 40


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# A date and a time of day, in the extended ISO form. Anything less (a bare time would be taken as today, a
# bare year as its first day) and the basic form without separators is not a date-time here.
DATE_TIME = r"^\s*\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?\s*(Z|UTC|[+-]\d{2}(:?\d{2})?)?\s*$"


def parse_ts(c: str | Column) -> Column:
    """ISO-8601 text -> TIMESTAMP (an instant, shown in the UTC session zone); null when unparseable.

    Accepts a date-time with or without a UTC offset, with or without fractional seconds. A text that
    is only a date, a time or a year, and the basic form (``20260910T100000Z``), gives null.
    """
    text = col_(c)
    return F.when(text.rlike(DATE_TIME), F.try_to_timestamp(text))


def parse_ts_ntz(c: str | Column) -> Column:
    """As ``parse_ts`` but as a wall-clock UTC ``TIMESTAMP_NTZ``, for results handed to clients."""
    return parse_ts(c).cast("timestamp_ntz")


def event_time(df) -> Column:
    """Event time of a curated frame: ``event_ts`` when the frame carries it, else parsed ``timestamp``."""
    if "event_ts" in df.columns:
        return F.col("event_ts").cast("timestamp_ntz")
    return parse_ts_ntz("timestamp")


def date_parts(ts: str | Column) -> dict[str, Column]:
    """Zero-padded year / month / day / hour strings of a timestamp."""
    ts = col_(ts)
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
        "hour": F.date_format(ts, "HH"),
    }


def iso_text(ts: str | Column) -> Column:
    """Timestamp -> ISO-8601 text with microseconds and no offset."""
    return F.date_format(col_(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def window_start(ts: str | Column, minutes: int) -> Column:
    """Start of the tumbling N-minute window containing ``ts``, aligned to the top of the hour.

    For N dividing 60 this equals ``window(ts, 'N minutes').start``; for other N the windows restart
    at every hour (the last one of each hour is shorter), which epoch-aligned windows do not do.
    The start is a wall-clock ``TIMESTAMP_NTZ`` in the (UTC) session zone.
    """
    if minutes <= 0 or minutes > 60:
        raise ValueError("minutes must be in 1..60")
    ts = col_(ts)
    bucket = F.floor(F.minute(ts) / F.lit(minutes)) * F.lit(minutes)
    start = F.date_trunc("hour", ts) + F.make_dt_interval(F.lit(0), F.lit(0), bucket.cast("int"), F.lit(0))
    return start.cast("timestamp_ntz")


def window_key(start: str | Column) -> Column:
    """Label of a window: ``yyyyMMdd_HHmm`` of its start."""
    return F.date_format(col_(start), "yyyyMMdd_HHmm")


def partition_key(ts: str | Column, file_name: str | Column, prefix: str = "raw") -> Column:
    """Object key ``<prefix>/year=YYYY/month=MM/day=DD/hour=HH/<file>`` of an event time."""
    ts = col_(ts)
    name = col_(file_name) if not isinstance(file_name, str) else F.lit(file_name)
    return F.format_string(
        "%s/year=%04d/month=%02d/day=%02d/hour=%02d/%s",
        F.lit(prefix), F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), name)


def pct(numer: str | Column, denom: str | Column, scale: int = 2) -> Column:
    """``round(100 * a / b, scale)`` in double precision; null when ``b`` is 0 (no division error)."""
    return F.round((col_(numer) * F.lit(100)).cast("double") / F.nullif(col_(denom), F.lit(0)), scale)


def money(c: str | Column) -> Column:
    """A 2-decimal amount held as double -> exact ``decimal(18,2)``, so sums do not depend on order."""
    return col_(c).cast("decimal(18,2)")


def cents(c: str | Column) -> Column:
    """A 2-decimal amount -> whole cents as bigint."""
    return (money(c) * F.lit(100)).cast("bigint")


def money_sum(c: str | Column) -> Column:
    """Exact sum of 2-decimal amounts, returned as double (the table's type)."""
    return F.sum(money(c)).cast("double")


def money_mean(total_cents: str | Column, n: str | Column) -> Column:
    """Mean of amounts, rounded half away from zero to the cent, from a cent total and a count.

    Integer division only (``div`` on bigint), so the cents are exact for any total and count; the
    sign is put back after rounding the absolute value, as ROUND does for refunds.
    """
    total_cents, n = col_(total_cents).cast("bigint"), col_(n).cast("bigint")
    whole = F.call_function("div", F.lit(2) * F.abs(total_cents) + n, F.nullif(F.lit(2) * n, F.lit(0)))
    signed = F.when(total_cents < 0, -whole).otherwise(whole)
    return F.when(n > 0, signed.cast("double") / F.lit(100.0))


def scan_cost_usd(bytes_scanned: str | Column) -> Column:
    """Query cost of scanning the given bytes at the per-TiB price."""
    return col_(bytes_scanned).cast("double") / F.lit(float(TIB)) * F.lit(USD_PER_TIB)


def is_blank(c: str | Column) -> Column:
    c = col_(c)
    return c.isNull() | (c == F.lit(""))

"""Raw lines with defects, derived from the driver's events.

Of every fifty event ids, ten stand for a defect each; what each does is stated once here and once, by
its outcome, in the SQL twins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.functions import date_parts
from shoplake.schema import EVENT_COLUMNS, RAW_PARTITIONS

EVERY = 50
EMPTY_ID, NULL_TIME, GARBAGE_TIME, TRUNCATED, BARE_TIME, COPIED_ID, EXTRA_KEY, NO_REFERRER, WRONG_HOUR, NULL_ID = range(1, 11)
# These carry a discount code, once the key exists; before that time records lack the key.
DISCOUNTED = (20, 24)
KEY_SINCE = "2024-01-15 00:00:00"
CUT = 10  # characters a truncated line lacks


def defective_lines(curated: DataFrame) -> DataFrame:
    """Curated events with ``event_ts`` -> JSON lines (``value``) with their raw partitions and ``event_no``.

    A copied id is that of the event six before; a wrong hour is the next one, in the path only.
    """
    number = F.col("event_id").cast("bigint")
    m = number % EVERY
    ts = F.col("event_ts")
    event_id = (F.when(m == EMPTY_ID, F.lit("")).when(m == NULL_ID, F.lit(None).cast("string"))
                .when(m == COPIED_ID, (number - COPIED_ID).cast("string")).otherwise(F.col("event_id")))
    time = (F.when(m == NULL_TIME, F.lit(None).cast("string")).when(m == GARBAGE_TIME, F.lit("not a time"))
            .when(m == BARE_TIME, F.lit("12:00:00")).otherwise(F.col("timestamp")))
    plain = [c for c in EVENT_COLUMNS if c not in ("referrer", "discount_code")]
    record = F.to_json(F.struct(*[{"event_id": event_id, "timestamp": time}.get(c, F.col(c)).alias(c) for c in plain]),
                       {"ignoreNullFields": "false"})
    discount = F.when(m.between(*DISCOUNTED), F.lit(',"discount_code":"SAVE10"')).otherwise(F.lit(',"discount_code":null'))
    line = F.concat(
        F.expr("left(record, length(record) - 1)"),
        F.when(m != NO_REFERRER, F.lit(',"referrer":null')).otherwise(F.lit("")),
        F.when(ts >= F.lit(KEY_SINCE).cast("timestamp_ntz"), discount).otherwise(F.lit("")),
        F.when(m == EXTRA_KEY, F.lit(',"utm":"x"')).otherwise(F.lit("")), F.lit("}"))
    path_time = F.when(m == WRONG_HOUR, ts + F.expr("interval 1 hour")).otherwise(ts)
    parts = date_parts(path_time)
    return (curated.withColumn("record", record).withColumn("line", line)
            .withColumn("value", F.when(m == TRUNCATED, F.expr(f"left(line, length(line) - {CUT})")).otherwise(F.col("line")))
            .select("value", number.alias("event_no"), *[parts[p].alias(p) for p in RAW_PARTITIONS]))

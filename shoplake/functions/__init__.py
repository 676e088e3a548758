from shoplake.functions.expressions import (  # noqa: F401
    cents,
    is_blank,
    date_parts,
    event_time,
    iso_text,
    money,
    money_mean,
    money_sum,
    parse_ts,
    parse_ts_ntz,
    partition_key,
    pct,
    scan_cost_usd,
    window_key,
    window_start,
)

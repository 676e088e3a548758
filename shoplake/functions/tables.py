"""Small constant tables as local relations (no Python worker, no job of their own)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def sql_literal(value) -> str:
    """A Python constant as a Spark SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def constant_table(spark: SparkSession, rows: Sequence[Sequence], columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows of constants -> DataFrame with the given ``(name, type)`` columns.

    Written as an inline ``VALUES`` table, which Spark plans as a local relation: a handful of fixed
    rows is broadcast or joined without running a job, and no Python rows are shipped.
    """
    names = ", ".join(f"`{n}`" for n, _ in columns)
    select = ", ".join(f"CAST(`{n}` AS {t}) AS `{n}`" for n, t in columns)
    if not rows:
        nulls = ", ".join(f"CAST(NULL AS {t}) AS `{n}`" for n, t in columns)
        return spark.sql(f"SELECT {nulls} WHERE false")
    values = ", ".join("(" + ", ".join(sql_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT {select} FROM VALUES {values} AS t({names})")

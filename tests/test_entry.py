import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "category"


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ["funnel_by_category", "revenue_by_country_device", "session_engagement",
                                  "abandoned_cart_products", "events_per_5min", "dq_funnel_shape",
                                  "etl_clean_counts", "revenue_pivot", "curated_write_readback",
                                  "file_landing_counts", "dq_unexpected_keys", "stream_session_stage",
                                  "batch_stream_union", "dq_missing_partitions", "events_per_7min"])
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in rel.description]
    assert sorted(df.columns) == sorted(d_cols)
    order = sorted(df.columns)

    def canon(cols, rows):
        idx = [cols.index(c) for c in order]
        return sorted((tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in idx) for r in rows),
                      key=repr)

    assert canon(df.columns, df.collect()) == canon(d_cols, rel.fetchall())

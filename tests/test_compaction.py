"""K2: packing by size, partitions left alone, swaps through the catalog."""

import uuid

import pytest
from pyspark.sql import functions as F

from shoplake.operators import compaction as K


def test_packing_against_a_plain_running_sum(spark):
    sizes = [1, 1, 2, 3, 5, 8, 40, 99, 100, 250, 0]
    files = spark.createDataFrame([("d=1", f"f{i:02}", b) for i, b in enumerate(sizes)] + [("d=2", "g", 7)],
                                  "partition string, file string, bytes long")
    got = {r["file"]: r["bin"] for r in K.pack(files, 100).collect()}
    want, total = {}, 0
    for b, f in sorted((b, f"f{i:02}") for i, b in enumerate(sizes) if b < 100):
        want[f] = f"0-{int((total + b / 2) // 100)}"
        total += b
    assert got == want | {"f08": "f08", "f09": "f09", "g": "0-0"}


def test_hot_partition_is_packed_in_parts(spark):
    files = spark.range(3000).select(F.lit("d=1").alias("partition"), F.col("id").cast("string").alias("file"), F.lit(10).cast("long").alias("bytes"))
    bins = K.pack(files, 100, files_per_packing=500).groupBy("bin").agg(F.count("*").alias("n")).collect()
    assert sum(r["n"] for r in bins) == 3000 and max(r["n"] for r in bins) <= 11
    assert len({r["bin"].split("-")[0] for r in bins}) == 6


def test_plan_takes_partitions_with_gain_only(spark):
    files = spark.createDataFrame([("d=1", "a", 10), ("d=1", "b", 10), ("d=2", "c", 10), ("d=3", "e", 900), ("d=3", "f", 900), ("d=3", "g", 1)],
                                  "partition string, file string, bytes long")
    assert {r["partition"] for r in K.plan(files, 100).collect()} == {"d=1"}
    assert K.plan(files.where("false"), 100).count() == 0


@pytest.fixture
def lake(spark, tmp_path):
    """A table with a scattered day, a packed day, an odd name and a null."""
    path, name = str(tmp_path / "t"), "t_" + uuid.uuid4().hex[:8]
    rows = spark.range(400).select("id", F.when(F.col("id") < 200, "2026-01-01").when(F.col("id") < 300, "2026-01-02")
                                   .when(F.col("id") < 350, "a b+c/ü").alias("day"), F.lit("x").alias("kind"))
    (rows.where("day = '2026-01-02'").coalesce(1).unionByName(rows.where("day IS NULL OR day <> '2026-01-02'").repartition(8))
     .write.partitionBy("kind", "day").parquet(path))
    spark.sql(f"CREATE TABLE {name} (id BIGINT, kind STRING, day STRING) USING parquet PARTITIONED BY (kind, day) LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    yield name, path, str(tmp_path / "runs")
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _files(spark, name):
    return {(r["day"], r["f"]) for r in spark.table(name).select("day", F.col("_metadata.file_path").alias("f")).distinct().collect()}


def test_only_scattered_partitions_move(spark, lake):
    name, path, runs = lake
    rows, old = sorted(spark.table(name).collect(), key=str), _files(spark, name)
    moved = {r["partition"]: r for r in K.compact_table(spark, name, path, runs, ["kind", "day"], at_once=2).collect()}
    assert len(moved) == 3 and "kind=x/day=2026-01-02" not in moved
    assert all(r["files_before"] > 1 and r["files_after"] == 1 for r in moved.values())
    assert sum(r["rows"] for r in moved.values()) == 300
    new = _files(spark, name)
    assert sorted(spark.table(name).collect(), key=str) == rows
    assert len(new) == 4 and {f for f in new & old} == {f for f in old if f[0] == "2026-01-02"}
    assert K.compact_table(spark, name, path, runs, ["kind", "day"]).count() == 0  # nothing is left to pack
    assert _files(spark, name) == new
    assert {r["partition"] for r in K.replaced_folders(spark, path, runs).collect()} == set(moved)


def test_new_rows_through_the_table_are_packed_again(spark, lake):
    name, path, runs = lake
    K.compact_table(spark, name, path, runs, ["kind", "day"])
    spark.sql(f"INSERT INTO {name} VALUES (1000, 'x', '2026-01-01'), (1001, 'x', '2026-01-01')")
    moved = K.compact_table(spark, name, path, runs, ["kind", "day"]).collect()
    assert [r["partition"] for r in moved] == ["kind=x/day=2026-01-01"] and moved[0]["rows"] == 202 and moved[0]["run"] == 2
    assert spark.table(name).count() == 402
    assert K.replaced_folders(spark, path, runs).count() == 4  # three first moves and one folder of the first run


def test_a_run_cut_before_its_swaps_is_finished_by_the_next(spark, lake, monkeypatch):
    name, path, runs = lake
    old = _files(spark, name)
    with monkeypatch.context() as m:
        m.setattr(K, "swap", lambda *_: None)
        K.compact_table(spark, name, path, runs, ["kind", "day"])
    assert _files(spark, name) == old
    assert K.compact_table(spark, name, path, runs, ["kind", "day"]).count() == 0
    assert len(_files(spark, name)) == 4 and spark.table(name).count() == 400


def test_open_partitions_stay(spark, lake):
    name, path, runs = lake
    moved = K.compact_table(spark, name, path, runs, ["kind", "day"], closed=F.col("partition") < "kind=x/day=2026-01-02").collect()
    assert [r["partition"] for r in moved] == ["kind=x/day=2026-01-01"]


def test_a_large_file_is_written_in_pieces(spark, tmp_path):
    path, name = str(tmp_path / "t"), "t_" + uuid.uuid4().hex[:8]
    rows = spark.range(60_000).select("id", F.lit("a").alias("day"))
    rows.coalesce(1).write.option("parquet.block.size", 65536).option("compression", "none").partitionBy("day").parquet(path)
    for i in range(4):
        spark.range(i, i + 1).select("id", F.lit("a").alias("day")).coalesce(1).write.mode("append").partitionBy("day").parquet(path)
    spark.sql(f"CREATE TABLE {name} (id BIGINT, day STRING) USING parquet PARTITIONED BY (day) LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        moved = K.compact_table(spark, name, path, str(tmp_path / "runs"), ["day"], target_bytes=131072).collect()[0]
        assert moved["files_before"] == 5 and 2 < moved["files_after"] <= 6 and moved["rows"] == 60_004
        assert spark.table(name).agg(F.sum("id")).first()[0] == sum(range(60_000)) + 6
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.sql(f"DROP TABLE {name}")

"""Shuffled shards by a two-pass external shuffle.

The first pass scatters the records uniformly into buckets of bounded size by a seeded hash of the record.
The second loads one bucket at a time, shuffles it by Fisher-Yates with a generator seeded for the bucket,
and writes it. The buckets one after another are a random order of all records; it is cut into shards whose
row counts differ by one at most (the law ``rows``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from shoplake.llm.common import materialize

BUCKET_BYTES = 16 << 20
OVERHEAD = 8  # bytes of a record beside its text
LAW = "rows"
STORED = "doc_id long, text string, slot long, shard int"


def record_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) and the overhead."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(OVERHEAD)).cast("long")


def fisher_yates(hashes: np.ndarray, ids: np.ndarray, seed: int, bucket: int) -> np.ndarray:
    """A bucket's rows in their new order. They are put into the order of their hashes first, so that the
    order in which they arrive does not matter; numpy's shuffle is a Fisher-Yates shuffle."""
    order = np.lexsort((ids, hashes))
    np.random.default_rng([seed, bucket]).shuffle(order)
    return order


def _starts(counts: DataFrame) -> DataFrame:
    """bucket, start: rows of all buckets before it. The running sum is taken inside groups of 1,024 buckets
    and over the groups' sums, so that no task orders all buckets."""
    group = F.shiftright("bucket", 10)
    counts = counts.withColumn("group", group)

    def before(window: WindowSpec) -> Column:
        return F.coalesce(F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    tops = counts.groupBy("group").agg(F.sum("n").alias("n")).withColumn("base", before(Window.orderBy("group")))
    inside = before(Window.partitionBy("group").orderBy("bucket"))
    return (counts.withColumn("inside", inside).join(tops.drop("n"), "group")
            .select("bucket", (F.col("base") + F.col("inside")).cast("long").alias("start")))


def write(docs: DataFrame, path: str, shards: int = 24, seed: int = 12, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Shuffle ``docs`` (doc_id, text) and write them to ``path``, one folder ``shard=`` per shard, each file in
    ascending ``slot`` (a row's place in its shard, from 0).

    Order and shards depend on the records, the seed and the bucket size alone. Null ids and texts are
    kept; equal rows are interchangeable. Where the copies of one row would fill a quarter of a bucket, they
    are dealt to all buckets by their place in the input, which is written first so that it is fixed.
    A single text may exceed a bucket. Without rows no folder is written; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "text"))
    keys = materialize(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.sum(record_size()).alias("bytes")), "shard-keys")
    total, size = (int(x or 0) for x in keys.agg(F.sum("n"), F.sum("bytes")).first())
    buckets = max(1, -(-size // bucket_bytes))
    bucket = F.pmod("h", F.lit(buckets))
    hot = keys.filter((F.col("n") > 1) & (F.col("bytes") > bucket_bytes // 4)).select("h", F.lit(True).alias("hot"))
    if hot.isEmpty():
        dealt = rows.withColumn("bucket", bucket)
        counts = keys.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("n"))
    else:
        placed = rows.withColumn("at", F.monotonically_increasing_id()).join(materialize(hot, "shard-hot"), "h", "left")
        own = F.when(F.col("hot"), F.pmod(F.xxhash64("h", "at"), F.lit(buckets))).otherwise(bucket)
        dealt = materialize(placed.withColumn("bucket", own).select("doc_id", "text", "h", "bucket"), "shard-dealt")
        counts = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))

    def shuffled(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        start, ids = right["start"][0].as_py(), left["doc_id"]
        order = fisher_yates(left["h"].to_numpy(), ids.fill_null(0).to_numpy(), seed, key[0].as_py())
        place = start + np.arange(len(order))
        shard = place * shards // total
        first = -(-shard * total // shards)
        return pa.table({"doc_id": ids.take(order), "text": left["text"].take(order),
                         "slot": pa.array(place - first), "shard": pa.array(shard, pa.int32())})

    starts = materialize(_starts(counts), "shard-starts")
    pairs = dealt.groupBy("bucket").cogroup(starts.groupBy("bucket"))
    (pairs.applyInArrow(shuffled, STORED).sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, text, slot, shard of the written shards."""
    return spark.read.schema(STORED).parquet(path)

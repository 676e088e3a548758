import math

import numpy as np
from pyspark.sql import functions as F

from shoplake.llm import sharding


def plainly(rows, hashes, shards, seed, bucket_bytes):
    """(doc_id, text, shard, slot) of every row by plain loops; ``hashes`` as Spark gives them."""
    size = sum(len((t or "").encode()) + 8 for _, t in rows)
    buckets = max(1, math.ceil(size / bucket_bytes))
    order = []
    for bucket in range(buckets):
        inside = sorted((h, i or 0, n) for n, ((i, _), h) in enumerate(zip(rows, hashes, strict=True)) if h % buckets == bucket)
        places = np.arange(len(inside))
        if len(places):
            np.random.default_rng([seed, bucket]).shuffle(places)
        order += [inside[p][2] for p in places]
    out, slots = [], {}
    for place, n in enumerate(order):
        shard = place * shards // len(rows)
        slots[shard] = slots.get(shard, -1) + 1
        out.append((*rows[n], shard, slots[shard]))
    return out


def check_law(rows, shards):
    """Counts at most one apart, slots without gaps."""
    by_shard = {s: [] for s in range(shards)}
    for r in rows:
        by_shard[r["shard"]].append(r["slot"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    counts = [len(slots) for slots in by_shard.values()]
    assert max(counts) - min(counts) <= 1


def test_shards_equal_the_plain_version(spark, make_docs, odd_texts, tmp_path):
    rows = [(i, t) for i, t, _ in odd_texts] + [(100 + i, f"text {i} " * (i % 7)) for i in range(500)]
    docs, path = make_docs(rows), str(tmp_path / "shards")
    sharding.write(docs, path, shards=24, seed=5, bucket_bytes=40_000)
    found = sharding.read(spark, path).collect()
    check_law(found, 24)
    hashes = [r["h"] for r in docs.select(F.xxhash64(F.lit(5), F.col("doc_id").cast("long"), "text").alias("h")).collect()]
    assert sorted(map(str, map(tuple, [(r["doc_id"], r["text"], r["shard"], r["slot"]) for r in found]))) == \
        sorted(map(str, plainly(rows, hashes, 24, 5, 40_000)))


def test_copies_of_one_row_fill_no_bucket(spark, make_docs, tmp_path):
    rows = [(None, "same text")] * 3000 + [(i, f"text {i}") for i in range(3000)]
    path = str(tmp_path / "shards")
    sharding.write(make_docs(rows).repartition(4), path, bucket_bytes=10_000)
    found = sharding.read(spark, path).collect()
    check_law(found, 24)
    assert sorted(str((r["doc_id"], r["text"])) for r in found) == sorted(map(str, rows))
    copies = [sum(r["doc_id"] is None for r in found if r["shard"] == s) for s in range(24)]
    assert min(copies) > 60 and max(copies) < 190  # 125 expected


def test_fewer_rows_than_shards_and_none(spark, make_docs, tmp_path):
    sharding.write(make_docs([(1, "a"), (2, None)]), str(tmp_path / "two"))
    found = sharding.read(spark, str(tmp_path / "two")).collect()
    check_law(found, 24)
    assert len(found) == 2
    sharding.write(make_docs([]), str(tmp_path / "none"))
    assert sharding.read(spark, str(tmp_path / "none")).count() == 0


def test_order_does_not_depend_on_partitions(spark, make_docs, tmp_path):
    docs = make_docs([(i, f"text {i}") for i in range(300)])
    got = []
    for n in (1, 7):
        sharding.write(docs.repartition(n), str(tmp_path / str(n)), bucket_bytes=1000)
        got.append(sorted(map(str, sharding.read(spark, str(tmp_path / str(n))).collect())))
    assert got[0] == got[1]

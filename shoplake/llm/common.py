"""Helpers shared by the operators: written intermediate tables, global order, linking and components."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.session import configure, scratch_dir

# Fixed value of the contracts: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


# Python workers and the Parquet reader get small batches, so that a few very long texts do not fill their memory.
ARROW_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
              "spark.sql.parquet.columnarReaderBatchSize": "256"}


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators' jobs rely on."""
    configure(spark)
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id's decimal text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def with_position(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Add ``name``: the row's 0-based place in the order of ``order`` (nulls last), without a single-task sort.

    Rows are range-sorted and numbered inside their partition; only the row counts of the partitions
    (as many as Spark has shuffle partitions) are summed up in one place.
    """
    keys = [F.col(c).asc_nulls_last() for c in order]
    at = f"__{name}_at"
    placed = materialize(df.orderBy(*keys).withColumn(at, F.monotonically_increasing_id()), "ordered")
    part = F.shiftright(F.col(at), 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    before, starts = 0, {}
    for row in sorted(counts, key=lambda r: r["part"]):
        starts[row["part"]] = before
        before += row["n"]
    if not starts:
        return placed.withColumn(name, F.lit(0).cast("long")).drop(at)
    start = F.element_at(F.create_map(*[F.lit(int(x)) for kv in starts.items() for x in kv]), part)
    inside = F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn(name, (start + inside).cast("long")).drop(at)


# --- linking inside buckets ---------------------------------------------------------------------------

Linked = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _star_edges(ids: np.ndarray, adjacency: np.ndarray) -> list[tuple[int, int]]:
    """Spanning edges of the graph ``adjacency`` over ``ids``: one per member that is not its component's first."""
    todo = adjacency.any(axis=1)
    edges: list[tuple[int, int]] = []
    for root in np.flatnonzero(todo):
        if not todo[root]:
            continue
        seen = np.zeros(len(ids), bool)
        seen[root] = True
        frontier = seen.copy()
        while frontier.any():
            frontier = adjacency[frontier].any(axis=0) & ~seen
            seen |= frontier
        todo &= ~seen
        edges += [(int(ids[root]), int(x)) for x in ids[seen] if x != ids[root]]
    return edges


def _edges_of_bucket(ids: np.ndarray, data: np.ndarray, side: np.ndarray, linked: Linked) -> list[tuple[int, int]]:
    """Edges of one bucket (side all 2), or of a pair of blocks (sides 0 and 1)."""
    if (side == 2).all():
        first, second = np.arange(len(ids)), np.arange(len(ids))
    else:
        first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(first) or not len(second):
        return []
    hit = linked(data[first], data[second])
    if not hit.any():
        return []
    adjacency = np.zeros((len(ids), len(ids)), bool)
    adjacency[np.ix_(first, second)] = hit
    adjacency |= adjacency.T
    np.fill_diagonal(adjacency, False)
    return _star_edges(ids, adjacency)


def link_in_buckets(rows: DataFrame, linked: Linked, width: int, block: int = 1024,
                    rows_per_task: int = 20_000) -> DataFrame:
    """Edges (a, b) that connect what is linked inside each bucket.

    ``rows``: bucket long, id long (unique inside a bucket), data binary of ``width`` bytes. Without a
    data column the id's eight little-endian bytes are the data.
    ``linked(A, B)`` gets two uint8 arrays (one row of ``width`` bytes each) and returns a boolean
    matrix. The edges span each bucket's components instead of listing all pairs: at most one per
    member and comparison. A bucket of more than ``block`` rows is cut into blocks by id, and each
    pair of blocks is compared in a task group of its own, so no group exceeds two blocks and every
    pair is still compared. Small buckets share task groups of about ``rows_per_task`` rows.
    """
    with_data = "data" in rows.columns
    rows = materialize(rows, "buckets")
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    large = materialize(sizes.filter(F.col("n") > block)
                        .select("bucket", F.ceil(F.col("n") / F.lit(block // 2)).cast("long").alias("blocks")), "large")
    total = rows.count()
    groups = max(1, total // rows_per_task)
    joined = rows.join(large, "bucket", "left")
    mine = F.pmod(F.xxhash64("id"), F.col("blocks"))
    # A member of block m meets every block: the pair (m, other) is written smaller number first.
    spread = (
        joined.withColumn("mine", mine)
        .withColumn("other", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(-1).cast("long")))
                                       .otherwise(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
        .select(
            "bucket", "id", *["data"] * with_data,
            F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"),
            F.when(F.col("blocks").isNull() | (F.col("mine") == F.col("other")), F.lit(2))
            .when(F.col("mine") < F.col("other"), F.lit(0)).otherwise(F.lit(1)).alias("side"),
            F.col("blocks").isNull().alias("small"),
        )
        .withColumn("task", F.when(F.col("small"), F.pmod(F.xxhash64("bucket"), F.lit(groups)))
                    .otherwise(F.xxhash64("bucket", "lo", "hi")))
    )

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bucket", "lo", "hi", "id"], kind="stable", ignore_index=True)
        ids, side = pdf["id"].to_numpy(), pdf["side"].to_numpy()
        data = (np.frombuffer(b"".join(pdf["data"]), np.uint8) if with_data else ids.view(np.uint8)).reshape(len(pdf), width)
        key = pdf[["bucket", "lo", "hi"]].fillna(-1).to_numpy()
        cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        edges: list[tuple[int, int]] = []
        for start, end in zip(np.r_[0, cut], np.r_[cut, len(pdf)], strict=True):
            if end - start > 1:
                edges += _edges_of_bucket(ids[start:end], data[start:end], side[start:end], linked)
        return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    edges = spread.groupBy("small", "task").applyInPandas(compare, "a long, b long")
    return materialize(edges.distinct(), "edges")


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """Connected components of the edges (a, b): rows (node, root), root being the smallest node reachable.

    Alternating large-star and small-star steps: each round is two grouped minima and written to the
    shared folder; the number of rounds grows with the logarithm of the longest path. Grouping is by
    minimum only, so a node with very many neighbours is combined before the shuffle and no
    neighbour list is built.
    """
    both = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    current = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                          .distinct(), "cc")
    for _ in range(max_rounds):
        # Large star: every larger neighbour of a node is tied to the smallest node around it.
        links = both(current)
        low = links.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = (links.filter("b > a").join(low, "a")
                 .select(F.col("b").alias("a"), F.col("low").alias("b")).distinct())
        # Small star: every smaller neighbour of a node, and the node, are tied to the smallest of them.
        small_low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(small_low, "a").select(
            F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("low").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")
        ).select("e.a", "e.b").filter("a <> b").distinct()
        following = materialize(small, "cc")
        # Done when every node points to one node that points nowhere: the edges are stars.
        several = following.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        chained = following.join(following.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        current = following
        if several.isEmpty() and chained.isEmpty():
            roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_lists(text: str | None, limit: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words (UTF-8, A-Z lower-cased) in lists of about ``limit`` bytes of text, so that a very long
    text never becomes one list. Null and white space give nothing."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    start = 0
    while start < len(data):
        end = start + limit
        if end < len(data):
            space = _SPACE.search(data, end)
            end = space.start() if space else len(data)
        # bytes.split() splits at exactly the six ASCII white-space bytes of the contracts.
        if words := data[start:end].split():
            yield words
        start = end


def batches_of(texts: Iterator[pd.Series]) -> Iterator[list[str]]:
    """Texts of each batch as a list, null as the empty text."""
    for s in texts:
        yield [t if isinstance(t, str) else "" for t in s]

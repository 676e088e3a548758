"""Exact top-k search by inner product as a Voronoi join.

Vectors are grouped by their nearest pivot. Each cell is summed up by its size, radius and the few
members nearest to the pivot. Scores against those members give every query a lower bound of its k-th
best score; a vector goes to a group of queries only if its largest possible score there,
``<pivot, x> + radius * |x|``, reaches the group's bound. Each (query group, data block) is solved
locally and the local lists are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplake.llm.common import materialize

QUERY_BLOCK = 2048  # queries of a group at most, about
DATA_BLOCK = 32_768  # vectors of a block, about
MAX_PIVOTS = 64
EXACT = 2.0**53


def quantised(embeddings: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id, dim, vec (floor(scale * x) of each component, little-endian doubles) of the usable rows."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            present = lists.is_valid().to_numpy(zero_copy_only=False) & ids.is_valid().to_numpy(zero_copy_only=False)
            lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            out = []
            for i in np.flatnonzero(present):
                x = flat[ends[i] - lengths[i]:ends[i]]
                if np.isfinite(x).all():
                    out.append((ids[i].as_py(), len(x), np.floor(scale * x).tobytes()))
            columns = list(zip(*out, strict=True)) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()),
                                              pa.array(columns[2], pa.binary())], names=["vec_id", "dim", "vec"])

    return embeddings.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(
        convert, "vec_id long, dim int, vec binary")


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), dim)


def assigned(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Add cell (number of the nearest pivot among those of the vector's length, 0 without one) and dist to it."""

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                x = _matrix(part["vec"], dim)
                p = pivots.get(dim, np.zeros((1, dim)))
                square = (x**2).sum(axis=1)[:, None] - 2 * x @ p.T + (p**2).sum(axis=1)[None, :]
                cell = square.argmin(axis=1)
                yield part.assign(cell=cell.astype(np.int32), dist=np.sqrt(((x - p[cell])**2).sum(axis=1)))

    return vectors.mapInPandas(nearest, "vec_id long, dim int, vec binary, cell int, dist double")


def top_scores(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray,
               k: int) -> Iterator[tuple[int, np.ndarray, list[int]]]:
    """For each query: its number, the positions of its k best data rows (ties to the smaller id) and their scores.

    ``ids`` must be ascending. Rows with the query's own id are left out.
    """
    limit = (np.abs(queries).max(initial=0) * np.abs(data).max(initial=0)) * max(1, data.shape[1])
    exact = limit < EXACT
    if not exact:  # whole numbers beyond 2^53: Python integers
        queries = np.array([[int(v) for v in q] for q in queries], object).reshape(queries.shape)
        data = np.array([[int(v) for v in x] for x in data], object).reshape(data.shape)
    for at in range(0, len(queries), 256):
        scores = queries[at:at + 256] @ data.T
        for i, row in enumerate(scores, at):
            own = slice(*np.searchsorted(ids, [query_ids[i], query_ids[i] + 1]))
            order = np.r_[0:own.start, own.stop:len(ids)]
            row = row[order]
            if len(row) > k and exact:
                bar = np.partition(row, len(row) - k)[len(row) - k]
                above, level = np.flatnonzero(row > bar), np.flatnonzero(row == bar)
                chosen = np.sort(np.r_[above, level[:k - len(above)]])
            else:
                chosen = np.arange(len(row))
            chosen = chosen[np.argsort([-v for v in row[chosen].tolist()], kind="stable")][:k]
            yield i, order[chosen], [int(v) for v in row[chosen].tolist()]


def search(embeddings: DataFrame, k: int = 20, query_every: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows by inner product for each query.

    Queries are the rows whose vec_id is divisible by ``query_every``; candidates all rows of the same
    length with another vec_id. Rows with a null id, a null vector, or null or non-finite components take
    no part; a repeated row is a candidate as often as it occurs and one query. Scores beyond the long
    range are cut to it. An empty table gives an empty result; other columns are ignored.
    """
    vectors = materialize(quantised(embeddings, scale), "knn-vectors")
    total = vectors.count()
    # Pivots: a sample by id hash, its size bounded by MAX_PIVOTS; every row is indexed by them.
    wanted = min(MAX_PIVOTS, max(4, math.isqrt(total) // 16))
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).collect()
    pivots: dict[int, np.ndarray] = {}
    for dim in {r["dim"] for r in sample}:
        pivots[dim] = np.unique(np.array([np.frombuffer(r["vec"], np.float64) for r in sample if r["dim"] == dim]), axis=0)
    data = materialize(assigned(vectors, pivots), "knn-cells")

    # Summary members: the k + 1 rows nearest to each pivot. Copies of one vector are thinned out by salted
    # groups first, so that a cell with very many rows is not sorted in one task.
    salted = Window.partitionBy("dim", "cell", "salt").orderBy("dist", "vec_id")
    near = Window.partitionBy("dim", "cell").orderBy("dist", "vec_id")
    members = (data.withColumn("salt", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(64)))
               .withColumn("rn", F.row_number().over(salted)).filter(F.col("rn") <= k + 1)
               .withColumn("rn", F.row_number().over(near)).filter(F.col("rn") <= k + 1))
    summary: dict[int, pd.DataFrame] = {}
    for r in members.select("dim", "vec_id", "vec").filter(F.col("dim").isin([int(d) for d in pivots])).collect():
        summary.setdefault(r["dim"], []).append((r["vec_id"], r["vec"]))  # at most MAX_PIVOTS * (k + 1) rows
    summary = {d: pd.DataFrame(sorted(rows), columns=["vec_id", "vec"]) for d, rows in summary.items()}

    queries = data.filter(F.col("vec_id") % query_every == 0).dropDuplicates(["vec_id", "vec"])

    def bound(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            floor = np.full(len(pdf), -np.inf)
            pdf = pdf.reset_index(drop=True)
            for dim, part in pdf.groupby("dim"):
                if dim in summary:
                    known = summary[dim]
                    found = top_scores(_matrix(part["vec"], dim), part["vec_id"].to_numpy(),
                                       _matrix(known["vec"], dim), known["vec_id"].to_numpy(), k)
                    for i, _, scores in found:
                        if len(scores) == k:
                            floor[part.index[i]] = scores[-1]
            yield pdf[["vec_id", "dim", "vec", "cell", "dist"]].assign(floor=floor)

    queries = queries.mapInPandas(bound, "vec_id long, dim int, vec binary, cell int, dist double, floor double")
    queries = materialize(queries, "knn-queries")
    sizes = queries.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(QUERY_BLOCK)).alias("blocks"))
    queries = queries.join(sizes, ["dim", "cell"]).withColumn(
        "part", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    queries = materialize(queries.drop("blocks"), "knn-groups")

    # Query groups with their radius and the least of their bounds, as a list per vector length: as many rows as
    # there are cells and query blocks.
    groups = (queries.groupBy("dim", "cell", "part")
              .agg(F.max("dist").alias("radius"), F.min("floor").alias("floor"))
              .groupBy("dim").agg(F.sort_array(F.collect_list(F.struct("cell", "part", "radius", "floor"))).alias("groups")))
    blocks = max(1, -(-total // DATA_BLOCK))

    def replicate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                group = part["groups"].iloc[0]
                x = _matrix(part["vec"], dim)
                norm = np.sqrt((x**2).sum(axis=1))
                p = pivots.get(dim, np.zeros((1, dim)))
                for g in group:
                    most = x @ p[g["cell"]] + g["radius"] * norm
                    needed = most + 1e-6 * (1 + np.abs(most) + g["radius"] * norm) >= g["floor"]
                    if needed.any():
                        yield part.loc[needed, ["vec_id", "dim", "vec", "block"]].assign(
                            cell=np.int32(g["cell"]), part=np.int32(g["part"]))

    placed = (data.withColumn("block", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(blocks)).cast("int"))
              .join(groups, "dim").select("vec_id", "dim", "vec", "block", "groups"))
    sent = placed.mapInPandas(replicate, "vec_id long, dim int, vec binary, block int, cell int, part int")
    asked = queries.select("vec_id", "dim", "vec", "cell", "part",
                           F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def solve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        if len(left) and len(right):
            dim = int(left["dim"].iloc[0])
            left, right = left.sort_values("vec_id"), right.sort_values("vec_id")
            query_ids, ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
            found = top_scores(_matrix(left["vec"], dim), query_ids, _matrix(right["vec"], dim), ids, k)
            for i, positions, scores in found:
                out += [(int(query_ids[i]), int(ids[p]), max(-2**63, min(2**63 - 1, s)))
                        for p, s in zip(positions, scores, strict=True)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"], dtype="int64")

    keys = ["dim", "cell", "part", "block"]
    local = asked.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(
        solve, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (local.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

"""Whitening of embeddings from an exactly counted scatter matrix.

Components become whole numbers. A task packs each dimension's bit planes across the rows of a block into
64-bit words; the number of rows that have bit a of dimension i and bit b of dimension j is a popcount of
two planes' AND, and these counts weighted by 2^(a+b) add up to the exact cross-products. The sums over all
blocks stay whole numbers, are centred as such, and only then become doubles for the eigenvectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import materialize

BLOCK = 16_384  # rows whose planes are packed together
LIMIT = 1 << 60  # whole numbers beyond it are cut to it
LIMB, LIMBS = 40, 4  # a sum travels as LIMBS numbers of LIMB bits
MOST = 2**63 - 1


def _numbers(batch: pa.RecordBatch, scale: int) -> Iterator[tuple[int, np.ndarray]]:
    """Place and whole numbers floor(scale * c) of each usable vector (second column) of a batch."""
    lists = batch.column(1)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    finite = np.isfinite(flat)
    whole = np.floor(scale * np.where(finite, flat, 0.0))
    x = np.where(np.abs(whole) < LIMIT, whole, np.sign(whole) * LIMIT).astype(np.int64)
    bad = np.concatenate([[0], np.cumsum(~finite)])
    for i in np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False)):
        start, end = ends[i] - lengths[i], ends[i]
        if bad[start] == bad[end]:
            yield i, x[start:end]


def _packed(x: np.ndarray) -> bytes:
    """The numbers in the narrowest type that holds all of them, so that equal vectors give equal bytes."""
    low, high = x.min(initial=0), x.max(initial=0)
    kind = next(k for k in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    return x.astype(kind).tobytes()


def _unpacked(data: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{len(data) // dim}").astype(np.int64)


def _vectors(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[tuple[int, np.ndarray]]:
    """Length and matrix of blocks of packed vectors (columns dim, vec)."""
    waiting: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for dim, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            rows = waiting.setdefault(dim, [])
            rows.append(_unpacked(data, dim))
            if len(rows) >= block:
                yield dim, np.stack(rows)
                del waiting[dim]
    for dim, rows in waiting.items():
        yield dim, np.stack(rows)


def bit_planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of non-negative numbers (rows x dimensions) as words across the rows, the dimension and the
    bit of each plane; by dimension, then bit. A dimension has as many planes as its largest number has bits."""
    bits = np.array([int(v).bit_length() for v in y.max(axis=0)])
    planes = np.zeros((bits.sum(), -(-len(y) // 64) * 8), np.uint8)
    first = np.cumsum(bits) - bits
    for bit in range(bits.max(initial=0)):
        dims = np.flatnonzero(bits > bit)
        packed = np.packbits(((y[:, dims] >> bit) & 1).astype(np.uint8), axis=0)
        planes[first[dims] + bit, :len(packed)] = packed.T
    dims = np.repeat(np.arange(y.shape[1]), bits)
    return planes.view(np.uint64), dims, np.arange(len(dims)) - first[dims]


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums of the dimensions and of their products over the rows, as arrays of Python integers."""
    n, d = x.shape
    low = x.min(axis=0)
    planes, dims, bit = bit_planes(x - low)
    # The weighted counts fit 64 bits unless the numbers are very large; then they are Python integers.
    small = 2 * bit.max(initial=0) + int(n).bit_length() + 8 < 62
    weight = (1 << bit).astype(np.int64) if small else np.array([1 << int(b) for b in bit], object)
    kind = np.int64 if small else object
    ahead, own, sums = np.zeros((d, d), kind), np.zeros((d, d), kind), np.zeros(d, kind)
    for p in range(len(planes)):
        counts = np.bitwise_count(planes[p] & planes[p:]).sum(axis=1, dtype=np.int64)
        weighted = counts * weight[p:]
        sums[dims[p]] += weighted[0]
        own[dims[p], dims[p]] += weighted[0] * weight[p]
        if p + 1 < len(planes):
            firsts = np.flatnonzero(np.r_[True, dims[p + 2:] != dims[p + 1:-1]])
            ahead[dims[p], dims[p + 1:][firsts]] += np.add.reduceat(weighted[1:], firsts) * weight[p]
    products = (ahead + ahead.T + own).astype(object)
    sums, low = sums.astype(object), low.astype(object)
    products += np.outer(low, sums) + np.outer(sums, low) + n * np.outer(low, low)
    return sums + n * low, products


@dataclass
class Model:
    """Mean and components of the vectors of one length."""

    n: int
    sums: list[int]
    directions: np.ndarray  # one component per column, divided by the root of its eigenvalue
    explained: np.ndarray
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact: longs, or Python integers where they would not fit."""
        most = self.n * int(np.abs(x).max(initial=0)) + max((abs(s) for s in self.sums), default=0)
        kind = np.int64 if most < 2**62 else object
        return self.n * x.astype(kind) - np.array(self.sums, kind)

    def deviations(self, centred: np.ndarray) -> list[int]:
        most = max((abs(int(v)) for v in (centred.min(initial=0), centred.max(initial=0))), default=0)
        if most * most * max(1, centred.shape[1]) > MOST:
            return [min(MOST, sum(int(v) ** 2 for v in row)) for row in centred]
        return (centred.astype(np.int64) ** 2).sum(axis=1).tolist()

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(np.float64) @ self.directions


def _eigen(n: int, sums: list[int], products: list[list[int]], components: int) -> Model:
    """The components whose eigenvalues are above what rounding makes of zero, at most ``components``."""
    d = len(sums)
    # Python's division of integers rounds once.
    cov = np.array([[(n * products[i][j] - sums[i] * sums[j]) / (n * n) for j in range(d)] for i in range(d)])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(np.trace(cov))
    kept = np.flatnonzero(values > d * np.finfo(float).eps * trace)[:components]
    return Model(n, sums, vectors[:, kept] / np.sqrt(values[kept]), values[kept] / trace)


def fit_list(embeddings: DataFrame, scale: int = 64) -> DataFrame:
    """dim, vec: every distinct vector once, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(len(x), _packed(x)) for _, x in _numbers(batch, scale) if len(x)]
            dims, data = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(dims, pa.int32()), pa.array(data, pa.binary())], names=["dim", "vec"])

    return embeddings.select("vec_id", "embedding").mapInArrow(run, "dim int, vec binary").distinct()


def fit(vectors: DataFrame, components: int = 16, offset: int = 1_000_000) -> dict[int, Model]:
    """A model for each length among the distinct packed vectors (``fit_list``). What comes to the driver is
    bounded by the lengths alone: the sums of products, one row for each pair of dimensions."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for dim, x in _vectors(batches, BLOCK):
            sums, products = scatter(x + offset)
            total = found.setdefault(dim, [0, 0, 0])
            found[dim] = [total[0] + len(x), total[1] + sums, total[2] + products]
        mask = (1 << LIMB) - 1
        for dim, (n, sums, products) in found.items():
            entries = [(dim, -1, -1, n)] + [(dim, -1, j, sums[j]) for j in range(dim)]
            entries += [(dim, i, j, products[i, j]) for i in range(dim) for j in range(i, dim)]
            # The topmost limb keeps the sign.
            limbs = [[v >> LIMB * k if k == LIMBS - 1 else v >> LIMB * k & mask for *_, v in entries] for k in range(LIMBS)]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int32()) for c in list(zip(*entries, strict=True))[:3]), *(pa.array(x, pa.int64()) for x in limbs)],
                names=["dim", "i", "j", *(f"l{k}" for k in range(LIMBS))])

    names = [f"l{k}" for k in range(LIMBS)]
    parts = vectors.select("dim", "vec").mapInArrow(count, "dim int, i int, j int, " + ", ".join(f"{x} long" for x in names))
    sums: dict[int, dict[tuple[int, int], int]] = {}
    for r in parts.groupBy("dim", "i", "j").agg(*[F.sum(x).alias(x) for x in names]).collect():
        sums.setdefault(r["dim"], {})[r["i"], r["j"]] = sum(r[x] << LIMB * k for k, x in enumerate(names))
    return {dim: _eigen(of[-1, -1], [of[-1, j] for j in range(dim)],
                        [[of[min(i, j), max(i, j)] for j in range(dim)] for i in range(dim)], components)
            for dim, of in sums.items()}


def measured(vectors: DataFrame, models: dict[int, Model], offset: int = 1_000_000) -> dict[int, Model]:
    """The models with their identity error: the largest absolute entry of the whitened fit list's covariance
    minus the identity."""
    shared = vectors.sparkSession.sparkContext.broadcast(models)  # a few numbers per pair of dimensions

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for dim, x in _vectors(batches, BLOCK):
            model = shared.value[dim]
            w = model.whitened(model.centred(x + offset))
            w = np.c_[np.ones(len(w)), w]
            found[dim] = found.get(dim, 0) + w.T @ w
        for dim, of in found.items():
            i, j = np.indices(of.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(of.size, dim), pa.int32()), pa.array(i.ravel(), pa.int32()),
                 pa.array(j.ravel(), pa.int32()), pa.array(of.ravel())], names=["dim", "i", "j", "v"])

    parts = vectors.select("dim", "vec").mapInArrow(moments, "dim int, i int, j int, v double")
    for row in (parts.groupBy("dim", "i", "j").agg(F.sum("v").alias("v"))
                .groupBy("dim").agg(F.collect_list(F.struct("i", "j", "v")).alias("of")).collect()):
        model = models[row["dim"]]
        of = np.zeros((len(model.explained) + 1,) * 2)
        for x in row["of"]:
            of[x["i"], x["j"]] = x["v"]
        of /= model.n
        cov = of[1:, 1:] - np.outer(of[0, 1:], of[0, 1:])
        model.identity_error = float(np.abs(cov - np.eye(len(cov))).max(initial=0.0))
    return models


def whiten(embeddings: DataFrame, components: int = 16, scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: one row for each usable vector and
    component (numbered from 1 by falling eigenvalue).

    A vector's numbers are ``floor(scale * c) + offset``, cut to 2^60. Vectors that are null, or hold null or
    non-finite entries, take no part. The model is fitted to every distinct vector once; vectors of different
    lengths have models of their own. Components whose eigenvalue is zero but for rounding cannot be
    scaled and are left out, so a single distinct vector gives no rows. Deviations beyond the long range
    are cut to it. Repeated rows and null ids are kept; an empty table gives an empty result; other columns
    are ignored.
    """
    vectors = materialize(fit_list(embeddings, scale), "whitening-fit")
    models = measured(vectors, fit(vectors, components, offset), offset)
    shared = embeddings.sparkSession.sparkContext.broadcast(models)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_dim: dict[int, list[tuple[int, np.ndarray]]] = {}
            for i, x in _numbers(batch, scale):
                by_dim.setdefault(len(x), []).append((i, x))
            for dim, found in by_dim.items():
                model = shared.value.get(dim)
                k = len(model.explained) if model else 0
                if not k:
                    continue
                centred = model.centred(np.stack([x for _, x in found]) + offset)
                rows = np.repeat([i for i, _ in found], k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1), len(found)), pa.int32()),
                     pa.array(np.full(len(rows), model.n)), pa.array(np.repeat(model.deviations(centred), k)),
                     pa.array(model.whitened(centred).ravel()), pa.array(np.tile(model.explained, len(found))),
                     pa.array(np.full(len(rows), model.identity_error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return embeddings.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(
        project, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra.numpy import arrays
from pyspark.sql import types as T

from shoplake.llm import whitening

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("component", T.StringType()), T.StructField("n", T.StringType())])


def make(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "x", "y")
                                  for i, v in rows], SCHEMA)


def plainly(rows, components=16):
    """(vec_id, component) -> n, deviation, |whitened|, explained with whole numbers and numpy."""
    xs = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)) for i, v in rows
          if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in xs})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    centred = [[n * x[j] - sums[j] for j in range(d)] for x in fit]
    cov = np.array([[sum(c[i] * c[j] for c in centred) / n**3 for j in range(d)] for i in range(d)])
    values, vectors = np.linalg.eigh(cov)
    out = []
    for i, x in xs:
        c = [n * x[j] - sums[j] for j in range(d)]
        for k in range(min(components, d)):
            e, v = values[-1 - k], vectors[:, -1 - k]
            out.append((i, k + 1, n, sum(y * y for y in c), abs(float(np.array(c) / n @ v) / math.sqrt(e)), e / np.trace(cov)))
    return out


def vectors(n, d, seed=0):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, d)) @ np.diag(np.linspace(3, 0.5, d))


@pytest.mark.parametrize("n,d", [(400, 20), (60, 5)])
def test_rows_equal_the_plain_version(spark, n, d):
    rows = [(int(i), v.tolist()) for i, v in enumerate(vectors(n, d))]
    rows += [(900 + i, rows[7][1]) for i in range(200)] + [(None, rows[3][1]), (7, rows[7][1])]
    odd = [(1001, None), (1002, [None] + [0.0] * (d - 1)), (1003, [math.nan] + [0.0] * (d - 1)), (1004, [math.inf] * d)]
    found = whitening.whiten(make(spark, rows + odd).repartition(5)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], r[4])
    got = sorted(((r["vec_id"], r["component"], r["n"], r["deviation"], abs(r["whitened"]), r["explained"]) for r in found), key=key)
    want = sorted(plainly(rows), key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    np.testing.assert_allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-9, atol=1e-9)
    assert {r["identity_error"] for r in found} and max(r["identity_error"] for r in found) < 1e-9
    # Either sign, but the same for all rows: the whitened fit list has the identity as covariance.
    once = {r["vec_id"]: None for r in found if r["vec_id"] is not None and r["vec_id"] < n}
    w = np.zeros((len(once), min(16, d)))
    for r in found:
        if r["vec_id"] in once:
            w[r["vec_id"], r["component"] - 1] = r["whitened"]
    np.testing.assert_allclose(np.cov(w.T, bias=True), np.eye(min(16, d)), atol=1e-9)


def test_odd_tables(spark):
    assert whitening.whiten(make(spark, [])).count() == 0
    assert whitening.whiten(make(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whiten(make(spark, [(1, [1.0, 2.0])] * 5)).count() == 0  # one distinct vector
    # A constant dimension has no component; lengths have models of their own.
    rows = [(i, [float(i % 3), 5.0]) for i in range(9)] + [(20 + i, [float(i * i), float(i), 1.0]) for i in range(4)]
    found = whitening.whiten(make(spark, rows)).collect()
    assert {(r["vec_id"] >= 20, r["component"], r["n"]) for r in found} == {(False, 1, 3), (True, 1, 4), (True, 2, 4)}
    # Numbers beyond the long range.
    found = whitening.whiten(make(spark, [(i, [c, 1e3 * i]) for i, c in enumerate((1e30, -1e30, 0.0, 5.0))])).collect()
    assert len(found) >= 4 and max(r["deviation"] for r in found) == 2**63 - 1
    assert all(math.isfinite(r["whitened"]) for r in found)


@settings(max_examples=60, deadline=None)
@given(arrays(np.int64, st.tuples(st.integers(1, 150), st.integers(1, 6)),
              elements=st.integers(-40, 40) | st.integers(-2**40, 2**40) | st.sampled_from([-2**60, 2**60])))
def test_scatter_is_exact(x):
    sums, products = whitening.scatter(x)
    y = x.astype(object)
    assert sums.tolist() == y.sum(axis=0).tolist()
    assert products.tolist() == (y.T @ y).tolist()

import random

import numpy as np
import pytest
from pyspark.sql import types as T

from shoplake.llm import knn

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("dim", T.StringType())])


def plain(rows, k, every):
    usable = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v, _ in rows
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, a in usable:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in usable if i != q and len(b) == len(a))
            out |= {(q, n, i, max(-2**63, min(2**63 - 1, -s))) for n, (s, i) in enumerate(scored[:k], 1)}
    return out


def vectors(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dim))
    return (centres[rng.integers(0, 4, n)] + 0.3 * rng.normal(size=(n, dim))).astype(np.float32).tolist()


@pytest.mark.parametrize("blocks", [(2048, 32_768), (7, 90)])
def test_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(knn, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(knn, "DATA_BLOCK", blocks[1])
    rows = [(i, v, "x") for i, v in enumerate(vectors(400, 12, 1))]
    rows += [(1000 + i, rows[3][1], "x") for i in range(200)]  # one vector that a third of the rows share
    rows += [(2000, None, "x"), (2020, [1.0, None, 2.0], "x"), (2040, [float("nan")] * 12, "x"), (2060, [], "x"), (None, [1.0] * 12, "x"),
             (2080, [float("inf")] * 12, "x"), (2100, [0.5, 1.0], "x"), (2101, [0.25, -1.0], "x"), (-20, [0.5, 1.0], "x"),
             (2120, [1e20, 3e19], "x")]
    random.Random(2).shuffle(rows)
    got = knn.search(spark.createDataFrame(rows, SCHEMA), k=9).collect()
    assert {tuple(r) for r in got} == plain(rows, 9, 20) and len(got) == len(plain(rows, 9, 20))


def test_empty_table(spark):
    assert knn.search(spark.createDataFrame([], SCHEMA)).count() == 0

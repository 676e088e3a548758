import math
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd

from shoplake.llm import deleted_interpolation as lm


def tokens(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def fold(i):
    return lm.fold_of(i)


def corpus(n=300):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        at, text = rng.randrange(60), []
        for _ in range(rng.randrange(0, 40)):
            at = (at * 7 + rng.randrange(3)) % 60
            text.append(words[at] if rng.random() < 0.9 else f"rare{rng.randrange(500)}")
        rows.append((i, " ".join(text), "a"))
    return rows


def plain(rows, weights=None):
    """Counts, base scores and, for given weights, model scores, one token at a time."""
    train = Counter()
    pairs = Counter()
    for i, t, _ in rows:
        w = tokens(t)
        if fold(i) != lm.TEST:
            train.update(w)
            pairs.update(zip([None, *w[:-1]], w, strict=True))
    total, distinct = sum(train.values()), len(train)
    docs = sum(fold(i) != lm.TEST for i, _, _ in rows)
    out = []
    for i, t, _ in rows:
        w, base, score = tokens(t), 0.0, 0.0
        for before, word in zip([None, *w[:-1]], w, strict=True):
            base += math.log10((train[word] + 0.5) / (total + 0.5 * (distinct + 1)))
            context = docs if before is None else train[before]
            if weights is not None:
                a, b, c = weights.by_bucket[0 if not context else int(math.log2(context)) + 1]
                bigram = pairs[before, word] / context if context else 0.0
                score += math.log10(a * bigram + b * train[word] / max(total, 1) + c / (distinct + 1))
        out.append((str(i), len(w), sum(train[x] > 0 for x in w), total, round(base, 5), round(score, 5)))
    return sorted(out)


def learnt(docs, block):
    counted = lm.count_pairs(docs.select("doc_id", "text"), block)
    totals = lm.Totals.of(counted)
    cells = lm.held_cells(counted, totals)
    return lm.learn_weights(cells, totals.distinct), cells, totals


def test_scores_token_by_token(make_docs):
    odd = [(None, None, None), (5000, "", "b"), (5001, None, "b"), (7, "w1 w2 w2", "c"), (7, "w1 w2 w2", "c"),
           (5003, "w3 w4 " * 4000, "b"), (5004, "é W1 日本", "b")]
    rows = corpus() + odd
    docs = make_docs(rows)
    for block in (2_000_000, 500):  # one block per task; texts that span blocks
        weights, _, _ = learnt(docs, block)
        got = lm.score(docs, block).collect()
        assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5),
                       round(r["score"], 5)) for r in got) == plain(rows, weights)
        assert all(r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 5 == 1) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_weights_rise_the_held_out_likelihood(make_docs):
    weights, cells, totals = learnt(make_docs(corpus()), 2_000_000)
    assert np.allclose(weights.by_bucket.sum(axis=1), 1) and (weights.by_bucket[:, 1:] > 0).all() and weights.by_bucket[0, 0] == 0
    assert cells["n"].sum() == sum(len(tokens(t)) for i, t, _ in corpus() if fold(i) == lm.HELD)

    def likelihood(w):
        estimates = np.stack([cells["bigram"], cells["word"], np.full(len(cells), 1 / (totals.distinct + 1))], axis=1)
        return (cells["n"] * np.log((w[cells["bucket"]] * estimates).sum(axis=1))).sum()

    best = likelihood(weights.by_bucket)
    rng = np.random.default_rng(0)
    for _ in range(30):
        other = np.maximum(weights.by_bucket + rng.normal(0, 0.03, weights.by_bucket.shape), 1e-4)
        assert likelihood(other / other.sum(axis=1, keepdims=True)) <= best + 1e-3 * abs(best)


def test_em_on_a_known_mixture():
    cells = pd.DataFrame({"bucket": [3, 3], "bigram": [0.5, 0.0], "word": [0.0, 0.5], "n": [700, 300]})
    a, b, c = lm.learn_weights(cells, 10**9).by_bucket[3]
    assert abs(a - 0.7) < 0.01 and abs(b - 0.3) < 0.01


def test_packing():
    arrays = [np.arange(5, dtype=np.uint64), np.zeros(0, np.uint32), np.array([1, 2**31], np.uint32), np.array([0.5, -1.0])]
    assert all(np.array_equal(a, b) and a.dtype == b.dtype for a, b in zip(arrays, lm.unpack(lm.pack(*arrays)), strict=True))


def test_empty_and_untrained_tables(make_docs):
    assert lm.score(make_docs([])).count() == 0
    only = next(i for i in range(99) if fold(i) == lm.TEST)
    row = lm.score(make_docs([(only, "a b", "x")])).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["score"], row["base_score"]) == (3, 0, 0, 0.0, 0.0)


def test_weights_do_not_depend_on_the_blocks(make_docs):
    rows = corpus() + [(5003, "w3 rare7 " * 1000, "b"), (7, "rare1 rare1 w2", "c"), (None, None, None)]
    (few, _, one), (whole, _, other) = (learnt(make_docs(rows), block) for block in (500, 2_000_000))
    assert np.allclose(few.by_bucket, whole.by_bucket) and one == other


def test_stacked_nodes_give_the_same_scores(make_docs):
    rows = corpus(120)
    docs = make_docs(rows)
    levels = lm.Levels.of(60, 1, 1)
    assert len(levels.chunks) > 1 and levels.chunks[-1] == 1
    want = sorted(map(str, ((r["doc_id"], r["n_known"], round(r["score"], 6)) for r in lm.score(docs).collect())))
    got = lm.score(docs, 100, fan_bits=1, slack=1).collect()
    assert sorted(map(str, ((r["doc_id"], r["n_known"], round(r["score"], 6)) for r in got))) == want


def test_rows_dealt_grow_with_the_tokens():
    """A sender deals a bounded number of rows, and each level has about as many nodes as there are senders."""
    for senders in (10, 1000, 50_000, 10_000_000):
        levels = lm.Levels.of(senders)
        nodes = [chunks << levels.bits * (i + 1) for i, chunks in enumerate(levels.chunks)]
        assert all(n <= 4 * max(senders, 16) << (levels.bits if i + 1 == len(nodes) else 0) for i, n in enumerate(nodes))
        keys = np.sort(np.random.default_rng(0).integers(0, 2**63, 100_000).astype(np.uint64) * np.uint64(2))
        counts = [np.ones(len(keys), int), np.zeros(len(keys), int)]
        dealt = levels.deal(0, 7, [keys, *counts, keys[:10], counts[0][:10], counts[1][:10]])
        assert len(dealt) <= 1 << levels.bits <= 4096
        assert np.array_equal(np.concatenate([np.cumsum(lm.unpack(d)[0], dtype=np.uint64) for *_, d in dealt]), keys)

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from shoplake.llm import toxicity


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choices(["ba", "de", "ki", "lo", "mu", "na"], k=rng.randrange(1, 4))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        text = rng.choices(words, k=rng.randrange(20, 120))
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(["zqidiot", "zqscum", "Wurgx" + rng.choice(words)]))
        rows.append((i, " ".join(text), "a"))
        labels.append((i, None if i % 17 == 3 else int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_odd_rows(spark, make_docs):
    rows, labels = corpus(900)
    odd = [(None, None, None), (5000, "", "b"), (5001, None, "b"), (5002, "zqscum " + "la " * 300_000, "b"), (7, rows[7][1], "c")]
    docs = make_docs(rows + odd)
    marks = spark.createDataFrame(labels + [(None, 1), (9999, 1), (7, 0)], "doc_id long, toxic int")
    got = toxicity.judge(docs, marks).collect()
    assert len(got) == len(rows) + len(odd)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got if r["doc_id"] is not None)
    held = [(r["predicted"], int(r["doc_id"] % 5 == 0)) for r in got if r["held_out"] and r["doc_id"] and r["doc_id"] < 900]
    right = np.mean([a == b for a, b in held])
    found = np.mean([a for a, b in held if b])
    assert right > 0.97 and found > 0.9
    scores = {r["doc_id"]: r["score"] for r in got}
    assert scores[5000] == scores[5001] < 0.5 < scores[5002]
    kept = toxicity.clean_documents(docs, marks)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["predicted"] == 0 for r in got)


def test_held_out_labels_are_not_learnt(spark, make_docs):
    rows, labels = corpus(120)
    docs = make_docs(rows)
    flipped = [(i, 1 - t if t is not None and zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, t in labels]
    one, two = ({r["doc_id"]: r["score"] for r in toxicity.judge(docs, spark.createDataFrame(x, "doc_id long, toxic int")).collect()}
                for x in (labels, flipped))
    assert one == two


def test_no_labels_and_no_documents(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.judge(make_docs([(1, "a", "b")]), none).first()
    assert (got["score"], got["predicted"]) == (0.5, 0)
    assert toxicity.judge(make_docs([]), none).count() == 0
    only = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, toxic int")
    model = toxicity.fit(make_docs([(i, "a b", "x") for i in range(9)]), only)
    assert not len(model.keys) and model.bias > 0


def test_sample_is_bounded(spark, make_docs):
    rows, labels = corpus(300)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(make_docs(rows), marks, max_per_class=40)
    assert len(model.keys)
    assert toxicity.features("a" * 10).size > 0 and F is not None


def plainly(docs, marks, learn, max_per_class=3000):
    """Model as {n-gram: weight}, bias: the same steps with strings, sets and loops over documents."""
    def grams(text):
        text = f" {(text or '').lower()} "
        return {text[i:i + n] for n in range(toxicity.ORDERS[0], toxicity.ORDERS[1] + 1) for i in range(len(text) - n + 1)}

    sample = sorted((i, t, m) for i, t, m in ((i, t, marks.get(i)) for i, t in docs) if m is not None and learn(i))
    of = [grams(t) for _, t, _ in sample]
    toxic = np.array([m for *_, m in sample])
    few, many = int(toxic.sum()), int((1 - toxic).sum())
    counts = {}
    for x, m in zip(of, toxic, strict=True):
        for g in x:
            counts.setdefault(g, [0, 0])[m] += 1
    chosen = {}
    for g, (a, b) in counts.items():
        g2 = sum(2 * c * np.log(c / ((a + b) * share / (many + few))) for c, share in ((a, many), (b, few)) if c)
        if g2 > toxicity.SURPRISE:
            chosen[g] = len(chosen)
    rows = [np.array([chosen[g] for g in x if g in chosen], int) for x in of]
    weights, bias = toxicity.train(rows, toxic, np.array([counts[g] for g in chosen]).T)
    return dict(zip(chosen, weights, strict=True)), bias


def test_scores_equal_a_plain_version(spark, make_docs):
    rows, labels = corpus(200)
    docs, marks = make_docs(rows), {i: t for i, t in labels if t is not None}
    weights, bias = plainly([r[:2] for r in rows], marks, lambda i: zlib.crc32(str(i).encode()) % 3 != 1)
    assert len(weights) > 20
    got = toxicity.judge(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        text = f" {texts[r['doc_id']].lower()} "
        z = bias + sum(w for g, w in weights.items() if g in text)
        assert abs(r["score"] - 1 / (1 + np.exp(-z))) < 1e-6


def test_long_texts_of_many_letters_are_not_toxic(spark, make_docs):
    """Random letters hold any short n-gram; however long they are, their score is that of a window."""
    rows, labels = corpus(600)
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz "))
    long_ = [(5000 + k, "".join(rng.choice(letters, n)), "b") for k, n in enumerate((10_000, 100_000, 1_000_000))]
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(make_docs(rows), marks)
    got = {r["doc_id"]: r["s"] for r in make_docs(long_ + [(6000, long_[2][1] + " zqscum " + long_[1][1], "b")]).select(
        "doc_id", toxicity.score(F.col("text"), model).alias("s")).collect()}
    assert all(got[5000 + k] < 0.7 for k in range(3))
    assert got[6000] > got[5002]  # a toxic word is found wherever it stands


def test_ngrams_are_counted_in_bounded_parts(monkeypatch):
    """Texts beyond what is counted at a time come in parts; the sums are those of whole texts."""
    import pandas as pd

    rng = np.random.default_rng(5)
    letters = np.array(list("abc "))
    docs = [(str(i), i % 2, "".join(rng.choice(letters, n))) for i, n in enumerate((0, 3, 40, 40, 2000, 7000, 16_000, 30, 12_000))]
    docs += [("9", 1, None), ("10", 0, docs[6][2]), ("11", 0, "a" * 20_000)]
    monkeypatch.setattr(toxicity, "COUNTED", 10_000)
    want = {}
    for _, label, text in docs:
        for k in toxicity.features(text).tolist():
            want.setdefault(k, [0, 0])[label] += 1
    for slices in (1, 7):
        names = ["slice", "toxic", "document", "keys", "counts"]
        rows = pd.DataFrame(toxicity.counted(iter(docs), slices), columns=names)
        assert rows["document"].notna().any() and rows["document"].isna().any()
        assert max(len(k) for k in rows["keys"]) <= toxicity.COUNTED + 4 * toxicity.WINDOW
        rows["keys"], rows["counts"] = rows["keys"].map(np.ndarray.tobytes), rows["counts"].map(np.ndarray.tobytes)
        got, last = {}, -1
        for _, part in rows.groupby("slice"):
            keys, n = toxicity.added(part)
            assert last < int(keys[0])  # slices are ranges of the hashes
            last = int(keys[-1])
            got |= dict(zip(keys.tolist(), n.T.tolist(), strict=True))
        assert got == want


def test_model_is_the_same_counted_in_parts(spark, make_docs, monkeypatch):
    rows, labels = corpus(200)
    rows[4] = (4, " ".join(r[1] for r in rows), "a")
    docs, marks = make_docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    whole = toxicity.fit(docs, marks)
    monkeypatch.setattr(toxicity, "COUNTED", 20_000)
    parts = toxicity.fit(docs, marks)
    assert len(whole.keys) and whole.keys.tolist() == parts.keys.tolist() and whole.weights.tolist() == parts.weights.tolist()

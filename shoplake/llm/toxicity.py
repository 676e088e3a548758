"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the character n-grams of the lower-cased text (64-bit hashes), present or absent. Each gets the
log ratio of its smoothed document frequencies in the two classes; features whose frequencies don't differ
clearly (log-likelihood ratio below ``SURPRISE``) are left out. A logistic regression on the scaled
features scores windows of ``WINDOW`` characters; a text's score is that of its highest window, so that a
long text isn't marked for the many n-grams that any long text has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import crc_of_id, materialize

ORDERS = (5, 8)  # shortest and longest n-gram
SURPRISE = 16.0
# The model is fitted on at most so many labelled documents of each class, those with the smallest id hash.
MAX_PER_CLASS = 3000
WINDOW = 5000  # characters
TABLE_BITS = 20
COUNTED = 1 << 20  # n-grams that are counted at a time
NONE = np.zeros(0, np.uint64)


@dataclass(frozen=True)
class Model:
    """The chosen n-grams' hashes (sorted), their weights (already scaled by the log-count ratios) and the bias."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        """Which leading bits any of the hashes has: most others are told apart without a search."""
        out = np.zeros(1 << TABLE_BITS, bool)
        out[(self.keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
        return out

    def places(self, hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Numbers of the chosen n-grams among some hashes, each once."""
        hashes = hashes[table[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)]]
        if not len(hashes):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.unique(at[self.keys[at] == hashes])


def windows(text: str | None) -> Iterator[np.ndarray]:
    """Hashes of the n-grams that begin in each window of a text; white space marks the text's ends."""
    lowest, highest = ORDERS
    text = f" {(text or '').lower()} "
    for at in range(0, len(text), WINDOW):
        codes = np.frombuffer(text[at:at + WINDOW + highest - 1].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        h, found = codes, []
        for n in range(2, highest + 1):
            if len(codes) < n:
                break
            h = h[:-1] * np.uint64(0x100000001B3) + codes[n - 1:]
            if n >= lowest:
                found.append(h[:WINDOW] * np.uint64(0x9E3779B97F4A7C15))
        yield np.concatenate([NONE, *found])


def features(text: str | None) -> np.ndarray:
    """The distinct hashes of a text's n-grams, sorted."""
    out = NONE
    for found in windows(text):
        out = np.union1d(out, found)
    return out


def counted(texts: Iterator[tuple[str, int, str | None]], slices: int) -> Iterator[tuple[int, int, str | None, np.ndarray, np.ndarray]]:
    """Documents (id, label, text) that have each n-gram, as rows of slice, label, document, sorted hashes, counts.

    Hashes fall into ``slices`` even ranges. About ``COUNTED`` n-grams are held at a time: shorter texts are counted
    together, the document is null; a longer one comes in parts, whose n-grams may repeat, under its id.
    """
    bounds = np.array([(i << 64) // slices for i in range(1, slices)], np.uint64)

    def rows(label: int, document: str | None, keys: np.ndarray, counts: np.ndarray):
        cuts = [0, *np.searchsorted(keys, bounds), len(keys)]
        for i in range(slices):
            if cuts[i] < cuts[i + 1]:
                yield i, label, document, keys[cuts[i]:cuts[i + 1]], counts[cuts[i]:cuts[i + 1]]

    held: dict[int, list[np.ndarray]] = {}

    def flush():
        for label, found in held.items():
            keys, n = np.unique(np.concatenate(found), return_counts=True)
            yield from rows(label, None, keys, n.astype(np.int32))
        held.clear()

    for document, label, text in texts:
        part, size, parts = [], 0, 0
        for found in windows(text):
            part.append(found)
            size += len(found)
            if size >= COUNTED:
                keys = np.unique(np.concatenate(part))
                yield from rows(label, document, keys, np.ones(len(keys), np.int32))
                part, size, parts = [], 0, parts + 1
        keys = np.unique(np.concatenate([NONE, *part]))
        if parts:
            yield from rows(label, document, keys, np.ones(len(keys), np.int32))
        else:
            held.setdefault(label, []).append(keys)
            if sum(len(x) for found in held.values() for x in found) >= COUNTED:
                yield from flush()
    yield from flush()


def added(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of one slice, sorted, and how many documents of either class have them, from rows of ``counted``."""
    def unpacked(part: pd.DataFrame, column: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(part[column]), kind)

    alone = rows["document"].notna()
    found = [(unpacked(part, "keys", np.uint64), unpacked(part, "counts", np.int32), label)
             for label, part in rows[~alone].groupby("toxic")]
    for (label, _), part in rows[alone].groupby(["toxic", "document"]):
        keys = np.unique(unpacked(part, "keys", np.uint64))
        found.append((keys, np.ones(len(keys), np.int32), label))
    keys = np.unique(np.concatenate([NONE, *[k for k, _, _ in found]]))
    counts = np.zeros((2, len(keys)), np.int64)
    for k, n, label in found:
        counts[label] += np.bincount(np.searchsorted(keys, k), weights=n, minlength=len(keys)).astype(np.int64)
    return keys, counts


def surprise(counts: np.ndarray, many: int, few: int) -> np.ndarray:
    """Log-likelihood ratio of features that ``counts[0]`` of many and ``counts[1]`` of few documents have."""
    share = np.array([many, few])[:, None] / (many + few)
    with np.errstate(divide="ignore", invalid="ignore"):
        return 2 * np.where(counts > 0, counts * np.log(counts / (counts.sum(axis=0) * share)), 0).sum(axis=0)


def train(rows: list[np.ndarray], toxic: np.ndarray, counts: np.ndarray, smoothing: float = 1.0, penalty: float = 0.1,
          rounds: int = 200) -> tuple[np.ndarray, float]:
    """Weights and bias fitted on each document's features (numbers) and 0/1 label; ``counts``: documents of either
    class that have each feature. With one class only, or no feature, a constant score."""
    n, size = len(rows), counts.shape[1]
    many, few = int((toxic == 0).sum()), int((toxic == 1).sum())
    if not many or not few:
        return np.zeros(size), float(np.log((few + 0.5) / (many + 0.5)))
    if not size:
        return np.zeros(0), float(np.log(few / many))
    ratio = np.log((counts[1] + smoothing) / (few + 2 * smoothing)) - np.log((counts[0] + smoothing) / (many + 2 * smoothing))
    column = np.concatenate(rows)
    row = np.repeat(np.arange(n), [len(r) for r in rows])
    value = ratio[column]
    # The rarer class counts for more, by the square root of the classes' ratio.
    each = np.where(toxic == 1, np.sqrt(many / few), 1.0)
    w, bias = np.zeros(size), float(np.log(few / many) / 2)
    seen, seen_bias = np.full(size, 1e-8), 1e-8
    for _ in range(rounds):  # AdaGrad over the whole sample
        z = np.bincount(row, weights=w[column] * value, minlength=n) + bias
        error = (1 / (1 + np.exp(-z)) - toxic) * each
        gradient = np.bincount(column, weights=error[row] * value, minlength=size) + penalty * w
        seen += gradient**2
        w -= 0.1 * gradient / np.sqrt(seen)
        seen_bias += error.sum() ** 2
        bias -= 0.3 * error.sum() / np.sqrt(seen_bias)
    return w * ratio, float(bias)


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, max_per_class: int = MAX_PER_CLASS) -> Model:
    """Fit on labelled documents (doc_id, text; doc_id, toxic). ``learn``: condition on doc_id of the rows to learn from.

    At most ``max_per_class`` documents of each class are used, and of each only the chosen features reach the
    task that fits the weights; the bias is set back to the classes'
    shares among all labelled documents. Null labels and ids are left out; several labels of a
    document count as the largest, several texts as the smallest.
    """
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = known.filter(learn) if learn is not None else known
    known = (known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .join(docs.select("doc_id"), "doc_id", "left_semi"))
    known = materialize(known.withColumn("toxic", (F.col("toxic") > 0).cast("int")), "toxic-labels")
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    sample = None
    for label in (0, 1):
        part = known.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_per_class)
        sample = part if sample is None else sample.unionByName(part)
    sample = materialize(sample, "toxic-sample")  # at most 2 * max_per_class rows of two numbers

    texts = materialize(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
                        .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "toxic-texts")
    used = {label: min(totals.get(label, 0), max_per_class) for label in (0, 1)}

    # Hashes travel packed, a row for each slice and some million n-grams, so that neither the shuffle nor a task
    # holds a row for each n-gram.
    size = texts.agg(F.sum(F.length("text") + 2)).first()[0] or 0
    slices = 1 + size * (ORDERS[1] - ORDERS[0] + 1) // COUNTED

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("slice", pa.int32()), ("toxic", pa.int32()), ("document", pa.string()), ("keys", pa.binary()), ("counts", pa.binary())])
        rows = ((i.as_py(), label.as_py(), t.as_py()) for batch in batches for i, label, t in zip(*batch.columns, strict=True))
        for i, label, document, keys, n in counted(rows, slices):
            yield pa.RecordBatch.from_pylist([{"slice": i, "toxic": label, "document": document, "keys": keys.tobytes(), "counts": n.tobytes()}], schema)

    def clear(pdf: pd.DataFrame) -> pd.DataFrame:
        found, n = added(pdf)
        high = surprise(n, used[0], used[1]) > SURPRISE
        return pd.DataFrame({"key": found[high].view(np.int64), "clean": n[0, high], "toxic": n[1, high]})

    kept = None
    if used[0] and used[1]:
        # Spark counts the sample's n-grams; only those that the classes clearly differ in come to the driver.
        packed = texts.select(F.col("doc_id").cast("string"), "toxic", "text").mapInArrow(
            count, "slice int, toxic int, document string, keys binary, counts binary")
        kept = packed.groupBy("slice").applyInPandas(clear, "key long, clean long, toxic long").toPandas()
    keys = kept["key"].to_numpy(np.int64).view(np.uint64) if kept is not None else NONE
    order = np.argsort(keys)
    counts = kept[["clean", "toxic"]].to_numpy(np.int64).T[:, order] if kept is not None else np.zeros((2, 0), np.int64)
    chosen = Model(keys[order], np.zeros(len(keys)), 0.0)

    @F.pandas_udf("array<int>")
    def numbers(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = chosen.table()
        for part in batches:
            yield pd.Series([np.unique(np.concatenate([chosen.places(w, table) for w in windows(t)])).astype(np.int32) for t in part])

    def learn_from(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", ignore_index=True)
        weights, bias = train([np.asarray(x, np.int32) for x in pdf["x"]], pdf["toxic"].to_numpy(), counts)
        return pd.DataFrame({"weights": [weights], "bias": [bias]})

    rows = texts.select(F.lit(0).alias("model"), "doc_id", "toxic", numbers("text").alias("x"))
    fitted = rows.groupBy("model").applyInPandas(learn_from, "weights array<double>, bias double").collect()
    if not fitted:
        return Model(NONE, np.zeros(0), 0.0)
    shift = 0.0
    if used[0] and used[1]:
        shift = float(np.log(totals[1] / totals[0]) - np.log(used[1] / used[0])) / 2
    return Model(chosen.keys, np.array(fitted[0]["weights"]), fitted[0]["bias"] + shift)


def score(text: Column, model: Model) -> Column:
    """Score between 0 and 1 of every whole text, higher for toxic: that of its highest window; null as the empty text."""

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = model.table()
        for texts in batches:
            z = np.array([max(model.weights[model.places(w, table)].sum() for w in windows(t)) for t in texts]) + model.bias
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -700, 700))))

    return of(text)


def held_out(doc_id: Column) -> Column:
    """True for documents whose labels are never learnt from: crc32 of the id as text, modulo 3, is 1."""
    return crc_of_id(doc_id) % 3 == 1


def judge(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Scores see nothing but the text. Null and empty texts get the score of a text without n-grams;
    repeated rows get equal scores; without labels every score is 0.5. Other columns are ignored.
    """
    model = fit(docs, labels, ~held_out(F.col("doc_id")))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, as they are, whose score stays under the threshold."""
    model = fit(docs, labels, ~held_out(F.col("doc_id")))
    names = docs.columns
    scored = docs.select(F.struct(*names).alias("__doc"), score(F.col("text"), model).alias("__score"))
    return scored.filter(F.col("__score") < threshold).select("__doc.*")

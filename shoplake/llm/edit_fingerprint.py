"""Document fingerprints by randomised edit embedding.

A text is embedded by a random walk: at step j the embedding shows the character under the pointer, and
the pointer moves on if the random bit of (j, character) is 1. All texts share the random bits, so two
texts that differ by few edits walk together again soon after each edit and their embeddings differ in
few places. The fingerprint samples the embedding at ``SLOTS`` steps: slot s looks at the step whose
random rank for s is the least among all steps of the text's walk, so texts of nearly equal length look
at mostly equal steps. Fingerprints are compared by the share of equal slots; bands of sampled slots find
candidates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import components, link_in_buckets, materialize

SLOTS = 256
CLASSES = 8  # characters fall into so many classes by hash; the walk's bits depend on the class
PERIOD = 1 << 14  # the random bits repeat after so many steps
PIECE = 1 << 16  # characters walked at a time


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A fixed 64-bit mixing function."""
    with np.errstate(over="ignore"):
        x = (x.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


@lru_cache(1)
def _waits() -> np.ndarray:
    """waits[c, j]: steps from step j until the pointer leaves a character of class c (1: at once)."""
    out = np.empty((CLASSES, PERIOD), np.int64)
    for c in range(CLASSES):
        at = np.flatnonzero((_mix(np.arange(PERIOD), 1000 + c) & np.uint64(1)).astype(bool))
        out[c] = np.r_[at, at[0] + PERIOD][np.searchsorted(at, np.arange(PERIOD))] - np.arange(PERIOD) + 1
    return out


@lru_cache(1)
def _triple_waits() -> list[bytes]:
    """The same for three characters in a row: table (c0 * CLASSES + c1) * CLASSES + c2, at step j."""
    waits, out = _waits(), []
    for c0 in range(CLASSES):
        one = waits[c0]
        for c1 in range(CLASSES):
            two = one + waits[c1][(np.arange(PERIOD) + one) % PERIOD]
            for c2 in range(CLASSES):
                three = two + waits[c2][(np.arange(PERIOD) + two) % PERIOD]
                out.append(three.astype(np.uint8).tobytes())
    return out


@lru_cache(1)
def _records() -> tuple[np.ndarray, np.ndarray]:
    """Steps, ascending, and slots: at each of these steps the slot's sample moves there.

    Each slot samples one step uniformly from a walk of any length, as a reservoir of one: after a move at
    step t, the next one is at floor((t + 1) / u) for uniform u. All texts share the moves, so walks of
    nearly equal length mostly end on the same samples.
    """
    steps, slots = [], []
    for s in range(SLOTS):
        t, k = 0, 0
        while t < 1 << 45:
            steps.append(t)
            slots.append(s)
            u = (int(_mix(np.array([k * SLOTS + s]), 5_000_000)[0]) + 1) / 2**64
            t, k = int((t + 1) / u), k + 1
    order = np.argsort(steps, kind="stable")
    return np.array(steps)[order], np.array(slots)[order]


class Walk:
    """The embedding of a text read piece by piece; only the slots' samples are kept."""

    def __init__(self) -> None:
        self.step = 0
        self.slots = np.zeros(SLOTS, np.uint8)

    def copy(self) -> Walk:
        other = Walk()
        other.step, other.slots = self.step, self.slots.copy()
        return other

    def read(self, codes: np.ndarray) -> Walk:
        steps, slots = _records()
        for at in range(0, len(codes), PIECE):
            piece = codes[at:at + PIECE]
            starts = self._reach(piece)
            low, high = np.searchsorted(steps, [starts[0], self.step])
            # The character under the pointer at each move; later moves of a slot overwrite earlier ones.
            under = piece[np.searchsorted(starts, steps[low:high], side="right") - 1]
            self.slots[slots[low:high]] = (_mix(under, 77) >> np.uint64(40)).astype(np.uint8)
        return self

    def _reach(self, codes: np.ndarray) -> np.ndarray:
        """The step at which each character is reached. Three characters are walked at a time."""
        waits, tables, mask, step, reached = _waits(), _triple_waits(), PERIOD - 1, self.step, []
        put = reached.append
        classes = ((codes * np.uint32(2654435761)) >> np.uint32(29)).astype(np.int64)
        whole = len(classes) // 3 * 3
        c0, c1, c2 = classes[:whole].reshape(-1, 3).T
        for triple in ((c0 * CLASSES + c1) * CLASSES + c2).tolist():
            put(step)
            step += tables[triple][step & mask]
        starts = np.empty(len(classes), np.int64)
        starts[0:whole:3] = reached
        starts[1:whole:3] = starts[0:whole:3] + waits[c0, starts[0:whole:3] & mask]
        starts[2:whole:3] = starts[1:whole:3] + waits[c1, starts[1:whole:3] & mask]
        for i in range(whole, len(classes)):
            starts[i] = step
            step += int(waits[classes[i], step & mask])
        self.step = step
        return starts


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def embed(text: str) -> np.ndarray:
    """Fingerprint of a whole text: SLOTS bytes; all zero for the empty text."""
    return Walk().read(_codes(text)).slots


def embed_with_edit(text: str, other: str) -> tuple[np.ndarray, np.ndarray, str]:
    """Fingerprints of a text and of its edited text, and the edited text: the last half of the code points
    replaced by the first as many (or all) of ``other``. The walk over the shared half is made once."""
    codes = _codes(text)
    half = len(codes) // 2
    kept = len(codes) - half
    shared = Walk().read(codes[:kept])
    edited = shared.copy().read(_codes(other[:half]))
    return shared.read(codes[kept:]).slots, edited.slots, text[:kept] + other[:half]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal slots."""
    return float((a == b).mean())


def _texts(values: pd.Series) -> list[str]:
    return [t if isinstance(t, str) else "" for t in values]


def fingerprints(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with n_chars and fingerprint (hex) instead of the text; null texts are empty."""
    rest = [c for c in docs.columns if c not in ("text", "n_chars", "fingerprint")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = _texts(pdf["text"])
            yield pdf[rest].assign(n_chars=[len(t) for t in texts], fingerprint=[embed(t).tobytes().hex() for t in texts])

    schema = docs.select(*rest, F.lit(0).cast("long").alias("n_chars"), F.lit("").alias("fingerprint")).schema
    return docs.select(*rest, "text").mapInPandas(run, schema)


def in_order(docs: DataFrame, parts: int) -> DataFrame:
    """doc_id, text, part, sentinel: the rows in ``parts`` ranges of ascending doc_id (null last), sorted inside
    each; every range also has the first row of the next one (the last range that of the first), marked sentinel.

    The bounds are quantiles of the ids and the first ids are minima, both found from the ids alone, so
    the texts are shuffled once.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shares = [i / parts for i in range(1, parts)]
    found = rows.agg(F.percentile_approx("doc_id", shares, 10_000).alias("b")).first()["b"] if shares else None
    bounds = np.unique(np.array(found or [], np.int64))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        out = np.full(len(ids), len(bounds), np.int32)  # null ids are in the last range
        out[known] = np.searchsorted(bounds, ids[known].to_numpy(np.int64), side="right")
        return pd.Series(out)

    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")
    ids = rows.select("doc_id").withColumn("part", range_of("doc_id"))
    firsts = sorted((r["part"], r["first"]["none"], r["first"]["doc_id"])
                    for r in ids.groupBy("part").agg(F.min(key).alias("first")).collect())  # a row for each range
    before = {(none, first): firsts[i - 1][0] for i, (_, none, first) in enumerate(firsts)}
    known = docs.sparkSession.createDataFrame([(f, n, p) for (n, f), p in before.items()],
                                              "first long, none boolean, previous int")
    marked = rows.withColumn("part", range_of("doc_id")).join(
        F.broadcast(known), F.col("doc_id").eqNullSafe(F.col("first")) & (F.col("doc_id").isNull() == F.col("none")), "left")
    own = F.struct(F.col("part").alias("part"), F.lit(False).alias("sentinel"))
    copy = F.struct(F.col("previous").alias("part"), F.lit(True).alias("sentinel"))
    placed = marked.withColumn("at", F.explode(F.when(F.col("previous").isNull(), F.array(own)).otherwise(F.array(own, copy))))
    return (placed.select("doc_id", "text", "at.part", "at.sentinel").repartition(parts, "part")
            .sortWithinPartitions("part", "sentinel", F.col("doc_id").asc_nulls_last(), "text"))


def compare_with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of every document and of its edited text, compared.

    The edited text has the last half replaced from the next document's beginning (ascending doc_id, null
    last, equal ids by text; after the last comes the first). Columns: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next. Null and empty texts have an all-zero
    fingerprint; equal texts have equal ones; a single document is its own next. An empty table gives an
    empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: tuple | None = None  # part, doc_id, text of the row before
        open_: tuple | None = None  # the last result, which lacks the next document's fingerprint
        done: list[tuple] = []
        for pdf in batches:
            for part, doc_id, text, sentinel in zip(pdf["part"], pdf["doc_id"], _texts(pdf["text"]), pdf["sentinel"],
                                                    strict=True):
                if waiting and waiting[0] == part:
                    _, own_id, own = waiting
                    first, second, edited = embed_with_edit(own, text)
                    if open_:
                        done.append(_row(*open_, first))
                    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    open_ = (own_id, len(own), sha, first, second)
                    if sentinel:
                        done.append(_row(*open_, embed(text)))
                        open_ = None
                waiting = None if sentinel else (part, None if pd.isna(doc_id) else int(doc_id), text)
            yield _frame(done)
            done = []

    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    return in_order(docs, parts).mapInPandas(run, schema)


def _row(doc_id: int | None, n: int, sha: str, first: np.ndarray, second: np.ndarray, following: np.ndarray) -> tuple:
    return (doc_id, n, sha, first.tobytes().hex(), second.tobytes().hex(), likeness(first, second),
            likeness(first, following))


def _frame(done: list[tuple]) -> pd.DataFrame:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pd.DataFrame(done, columns=names).astype({"doc_id": "Int64"})


def alike(least: float):
    def linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.empty((len(a), len(b)), bool)
        for i, x in enumerate(a):
            out[i] = (b == x).mean(axis=1) >= least
        return out

    return linked


def near_duplicates(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """doc_id and component_id (smallest doc_id reachable by links) of every row.

    Fingerprints are linked if at least ``least`` of their slots are equal. Candidates share a band of
    slots, and each is verified on all slots. There is one band more than slots that may differ, so every
    linked pair shares one. Copies collapse first. Null and
    empty texts are copies of each other; null ids are never a component's smallest. An empty table gives
    an empty result; other columns are ignored.
    """
    prints = materialize(fingerprints(docs.select("doc_id", "text")), "edit-prints")
    distinct = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    distinct = materialize(distinct.withColumn("id", F.monotonically_increasing_id()), "edit-distinct")
    differing = int(sum(1 - d / SLOTS >= least for d in range(1, SLOTS + 1)))
    bounds = [b * SLOTS // min(differing + 1, SLOTS) for b in range(min(differing + 1, SLOTS) + 1)]
    keys = F.array(*[F.xxhash64(F.lit(b), F.substring("fingerprint", 2 * low + 1, 2 * (high - low)))
                     for b, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))])
    rows = distinct.select("id", F.unhex("fingerprint").alias("data"), F.explode(keys).alias("bucket"))
    found = components(link_in_buckets(rows, alike(least), SLOTS))
    rooted = distinct.join(found, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "id"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select("doc_id", "component_id")

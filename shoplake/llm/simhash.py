"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints within ``max_bits`` differing bits are linked. The 64 bits are cut into parts of
correlated bits; part i gets a threshold e_i with sum(e_i + 1) = max_bits + 1, so two linked
fingerprints agree within e_i bits on some part. The thresholds come from a dynamic program over
candidate counts estimated from all fingerprints. Each fingerprint is put into the buckets of its parts
(and of their flipped keys where e_i > 0); bucket mates are verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import components, link_in_buckets, materialize, word_lists

BITS = 64
# Relative costs: a row put into a bucket (shuffled, sorted) against one comparison of two fingerprints.
ROW_COST = 400.0
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def simhash(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """64-bit fingerprint: bit set if set in over half of the shingles' XXH64; 0 without words."""
    hist, total, tail = np.zeros((8, 256), np.int64), 0, []
    hash_of = xxhash.xxh64_intdigest
    for words in word_lists(text):
        words = tail + words
        tail = words[-(shingle - 1):] if shingle > 1 else []
        n = len(words) - shingle + 1
        if n <= 0:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.r_[0, ends[:-1] + 1][:n].tolist()
        found = np.array([hash_of(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1:].tolist(), strict=True)],
                         np.uint64).view(np.uint8).reshape(-1, 8)
        for k in range(8):
            hist[k] += np.bincount(found[:, k], minlength=256)
        total += n
    if not total:
        return hash_of(b" ".join(tail), seed) if tail else 0
    votes = (hist @ _BYTE_BITS).ravel()
    return int(np.packbits(2 * votes > total, bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, shingle: int = 4, seed: int = 42) -> Column:
    """The fingerprint as a long (the 64 bits in two's complement)."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            prints = np.fromiter((simhash(t, shingle, seed) for t in texts), np.uint64, len(texts))
            yield pd.Series(prints.view(np.int64))

    return of(text)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


@dataclass(frozen=True)
class Part:
    bits: tuple[int, ...]
    threshold: int

    @property
    def mask(self) -> int:
        return sum(1 << b for b in self.bits)


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how often each pair of bits is set together (64 x 64), over all of them."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, both = 0, np.zeros((BITS, BITS))
        for pdf in batches:
            bits = np.unpackbits(pdf["fp"].to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            bits = bits.astype(np.float32)
            both += bits.T @ bits
            n += len(pdf)
        i, j = np.indices(both.shape)
        yield pd.DataFrame({"i": np.r_[-1, i.ravel()], "j": np.r_[-1, j.ravel()],
                            "n": np.r_[n, both.ravel()].astype(np.int64)})

    rows = prints.select("fp").mapInPandas(count, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    both = np.zeros((BITS, BITS))
    n = 0
    for r in rows.collect():
        if r["i"] < 0:
            n = r["n"]
        else:
            both[r["i"], r["j"]] = r["n"]
    return n, both


def correlated_parts(n: int, both: np.ndarray, m: int) -> list[tuple[int, ...]]:
    """Cut the bits into m parts of nearly equal width, each grown from a bit by its most correlated free bit."""
    mean = np.diag(both) / max(n, 1)
    deviation = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    correlation = np.abs((both / max(n, 1) - np.outer(mean, mean)) / np.outer(deviation, deviation))
    np.fill_diagonal(correlation, 0)
    free, parts = set(range(BITS)), []
    for k in range(m):
        width = BITS // m + (k < BITS % m)
        part = [max(sorted(free), key=lambda b: correlation[b, sorted(free)].sum())]
        free.discard(part[0])
        while len(part) < width:
            best = max(sorted(free), key=lambda b: correlation[b, part].sum())
            part.append(best)
            free.discard(best)
        parts.append(tuple(sorted(part)))
    return parts


def within(mean: np.ndarray, most: int) -> list[float]:
    """P(two independent fingerprints differ in at most e of these bits), e = 0..most, bits taken as independent."""
    differ = 2 * mean * (1 - mean)
    exactly = np.zeros(most + 1)
    exactly[0] = 1
    for p in differ:
        exactly[1:] = exactly[1:] * (1 - p) + exactly[:-1] * p
        exactly[0] *= 1 - p
    return np.cumsum(exactly).tolist()


def allocate(costs: list[dict[int, float]], max_bits: int) -> tuple[float, list[int]]:
    """Thresholds (one per part) with sum(e + 1) = max_bits + 1 and the least total cost."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for options in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for e, more in options.items():
                key = used + e + 1
                if key <= max_bits + 1 and (key not in following or cost + more < following[key][0]):
                    following[key] = (cost + more, [*chosen, e])
        best = following
    return best.get(max_bits + 1, (float("inf"), []))


def plan(prints: DataFrame, max_bits: int = 4) -> list[Part]:
    """Parts and thresholds for these distinct fingerprints (column fp): the cheapest over several part counts."""
    n, both = bit_statistics(prints)
    mean = np.diag(both) / max(n, 1)
    layouts = {m: correlated_parts(n, both, m) for m in range(2, max_bits + 2)} or {1: [tuple(range(BITS))]}
    keys = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"),
                              F.col("fp").bitwiseAND(F.lit(_signed(Part(bits, 0).mask))).alias("key"))
                     for m, parts in layouts.items() for i, bits in enumerate(parts)])
    equal = (prints.select(F.explode(keys).alias("k")).groupBy("k.m", "k.i", "k.key").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("m", "i").agg(F.sum(F.col("n").cast("double") * (F.col("n") - 1) / 2).alias("pairs")))
    pairs = {(r["m"], r["i"]): r["pairs"] for r in equal.collect()}
    found = []
    for m, parts in layouts.items():
        costs = []
        for i, bits in enumerate(parts):
            near = within(mean[list(bits)], 2)
            each = max(pairs.get((m, i), 0.0), 1.0) / max(near[0], 1e-18)  # candidates if all pairs met
            width = len(bits)
            costs.append({-1: 0.0, 0: ROW_COST * n + each * near[0],
                          1: ROW_COST * n * (1 + width / 2) + each * near[2],
                          2: ROW_COST * n * (1 + width) + 2 * each * near[2]})
        cost, chosen = allocate(costs, max_bits)
        if chosen:
            found.append((cost, m, [Part(b, e) for b, e in zip(parts, chosen, strict=True)]))
    return min(found, key=lambda x: x[:2])[2]


def buckets(prints: DataFrame, parts: list[Part]) -> DataFrame:
    """Rows (bucket, id = fp): the keys under which any two fingerprints linked by ``parts`` meet."""
    fp, keys = F.col("fp"), []
    for i, part in enumerate(parts):
        if part.threshold < 0:
            continue
        own = fp.bitwiseAND(F.lit(_signed(part.mask)))
        keys.append(F.xxhash64(F.lit(i), own))
        for b in part.bits if part.threshold else ():
            bit = F.lit(_signed(1 << b))
            flipped = F.xxhash64(F.lit(i), own.bitwiseXOR(bit))
            # Within one bit, one of the two has the differing bit unset, so only unset bits are flipped;
            # within two bits, each of the two flips one of the differing bits and they meet in between.
            keys.append(flipped if part.threshold > 1 else F.when(own.bitwiseAND(bit) == 0, flipped))
    return (prints.select(fp.alias("id"), F.explode(F.array_distinct(F.array(*keys))).alias("bucket"))
            .filter("bucket IS NOT NULL"))


def close(max_bits: int):
    def linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x, y = np.ascontiguousarray(a).view(np.uint64).ravel(), np.ascontiguousarray(b).view(np.uint64).ravel()
        return np.bitwise_count(x[:, None] ^ y[None, :]) <= max_bits

    return linked


def groups(prints: DataFrame, max_bits: int = 4, parts: list[Part] | None = None) -> DataFrame:
    """Distinct fingerprints (column fp) with root, the smallest (signed) fingerprint linked to it, itself included."""
    if max_bits > 5:
        raise ValueError("part thresholds of up to two bits cover distances of up to five bits")
    edges = link_in_buckets(buckets(prints, parts or plan(prints, max_bits)), close(max_bits), 8)
    found = components(edges)
    return prints.select("fp").join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, seed: int = 42) -> DataFrame:
    """doc_id, fp (long) and component_id (smallest doc_id reachable by links) of every row.

    Null and empty texts have fingerprint 0 and are linked like any other; repeated rows stay. A null
    doc_id is never a component's smallest unless all its ids are null. An empty table gives an empty
    result; other columns are ignored.
    """
    prints = materialize(docs.select("doc_id", fingerprint(F.col("text"), shingle, seed).alias("fp")), "simhash")
    # Copies collapse to one row before anything is compared.
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    if distinct.isEmpty():
        return prints.withColumn("component_id", F.col("doc_id"))
    rooted = materialize(groups(distinct, max_bits).join(distinct, "fp"), "simhash-groups")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialize(rooted.join(smallest, "root").select("fp", "component_id"), "simhash-components")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The documents, one of each group: the row with the smallest doc_id (of rows equal in id, the one with
    the smallest hash over its columns). Columns stay as they are."""
    names = docs.columns
    row = F.xxhash64(*[F.col(c) for c in names])
    slim = docs.select(F.col("doc_id"), F.col("text"), row.alias("__row"))
    prints = materialize(slim.select("doc_id", "__row", fingerprint(F.col("text"), shingle).alias("fp")), "dedup")
    distinct = materialize(prints.groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row")).alias("first"),
        F.count(F.lit(1)).alias("n")), "dedup-distinct")
    if distinct.isEmpty():
        return docs
    rooted = groups(distinct.select("fp"), max_bits).join(distinct, "fp")
    keep = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", "first.__row")
    keep = materialize(keep.withColumnRenamed("doc_id", "__id"), "dedup-keep")
    whole = docs.select(F.struct(*names).alias("__doc"), F.col("doc_id").alias("__mine"), row.alias("__hash"))
    kept = whole.join(keep, F.col("__mine").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__row")))
    # Rows that repeat as a whole can't be told apart by id and hash: only those are reduced by value.
    repeated = materialize(prints.groupBy("doc_id", "__row").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                           .select(F.col("doc_id").alias("__rid"), F.col("__row").alias("__rrow")), "dedup-repeated")
    if repeated.isEmpty():
        return kept.select("__doc.*")
    again = F.col("__mine").eqNullSafe(F.col("__rid")) & (F.col("__hash") == F.col("__rrow"))
    single = kept.join(repeated, again, "left_anti")
    reduced = kept.join(repeated, again, "left_semi").dropDuplicates(["__mine", "__hash"])
    return single.unionByName(reduced).select("__doc.*")

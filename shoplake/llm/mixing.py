"""Mixing sources to target weights by hash thresholds.

Every document has a 60-bit hash. A source that shall give the share f of its words takes the
documents whose hash does not exceed a threshold; the threshold is found from histograms (words by
source and 12-bit hash bucket), level by level, refining only the bucket where the budget is crossed.
Nothing is sorted, and a larger budget's choice contains a smaller one's. A target above the source's
size is met by whole passes over the source plus a threshold for the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplake.llm.common import materialize, with_position, word_count

LEVEL_BITS = 12
LEVELS = 5


def hash60(doc_id: Column, text: Column) -> Column:
    """First 15 hex digits of the MD5 of "id:text" as a number. Null id and null text count as empty."""
    both = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(both.cast("binary")), 1, 15), 16, 10).cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """One slim row per document: doc_id, source, size (words), h (hash)."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                       hash60(F.col("doc_id"), F.col("text")).alias("h"))


def targets(measured: DataFrame, weights: Sequence[int] = (5, 2, 1), budget: float = 1.0,
            max_repeat: int = 3) -> DataFrame:
    """Per source: source, source_size, weight, target.

    Sources by code point (null last) get the weights in turn. The budget (a share of all words) is
    dealt by weight; no source gets more than ``max_repeat`` times its size, what it can't use goes
    to the others by weight. The water level is found by repeated sums over the sources.
    """
    sources = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_position(sources, ["source"], "place")
    turn = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = materialize(ranked.withColumn("weight", turn).drop("place"), "sources")
    cap = F.col("source_size") * max_repeat
    total, weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    words = budget * (total or 0)
    level = words / weight if weight else 0.0
    while True:
        full = cap <= F.col("weight") * F.lit(float(level))
        capped, free = ranked.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))).first()
        if not free:
            level = float("inf")
            break
        following = (words - (capped or 0)) / free
        if following <= level:
            break
        level = following
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(float(level)))
    return ranked.withColumn("target", F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(target))


def thresholds(measured: DataFrame, wanted: DataFrame, max_repeat: int = 3) -> DataFrame:
    """Add to ``targets``: passes (whole takes of the source) and upto (largest hash of the rest, -1: none)."""
    whole = F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(max_repeat).cast("long"))
    wanted = wanted.withColumn("passes", F.when(F.col("source_size") == 0, F.lit(0).cast("long")).otherwise(whole))
    wanted = materialize(wanted.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")), "targets")
    # Per source: the open bucket (prefix), the words of all buckets before it, and its hash range.
    open_ = wanted.select("source", "rest", F.lit(0).cast("long").alias("prefix"),
                          F.lit(0).cast("long").alias("base"))
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        here = F.shiftright(F.col("h"), shift)
        inside = measured.join(open_.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        inside = inside.filter(F.shiftright(F.col("h"), shift + LEVEL_BITS) == F.col("prefix"))
        histogram = inside.groupBy("source", "rest", "base", here.alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("h").alias("first"), F.max("h").alias("last"))
        # At most 2^12 buckets per source.
        running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        upto = F.col("base") + F.sum("words").over(running)
        crossed = (histogram.withColumn("upto", upto).filter(F.col("upto") > F.col("rest"))
                   .groupBy("source").agg(F.min(F.struct("bucket", "upto", "words", "first", "last", "rest")).alias("x")))
        open_ = materialize(crossed.select("source", "x.rest", F.col("x.bucket").alias("prefix"),
                                           (F.col("x.upto") - F.col("x.words")).alias("base"),
                                           "x.words", "x.first", "x.last"), "boundary")
        if open_.filter(F.col("first") != F.col("last")).isEmpty():
            break
    # The boundary hash is taken if the sum then lies at least as near to the budget as without it.
    edge = F.when(F.col("base") + F.col("words") / 2 <= F.col("rest"), F.col("first")).otherwise(F.col("first") - 1)
    found = open_.select(F.col("source").alias("s"), edge.alias("upto"))
    joined = wanted.join(found, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    # A source without a crossing is taken whole only if its rest asks for all of it, which passes already count;
    # one without a rest, such as a source at its cap, gives nothing more, not even empty documents.
    upto = F.when(F.col("rest") > 0, F.col("upto"))
    return materialize(joined.withColumn("upto", F.coalesce(upto, F.lit(-1).cast("long"))), "thresholds")


def choose(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Rows (any columns, with source and h) plus source_size, target and copies (how often the row is taken)."""
    limits = limits.select(F.col("source").alias("__s"), "source_size", "target", "passes", "upto")
    rows = rows.drop("source_size", "target", "copies")
    joined = rows.join(limits, F.col("source").eqNullSafe(F.col("__s")), "left")
    copies = F.col("passes") + (F.col("h") <= F.col("upto")).cast("long")
    return joined.withColumn("copies", copies).drop("__s", "passes", "upto")


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), budget: float = 1.0, max_repeat: int = 3) -> DataFrame:
    """doc_id, size, source_size, target, taken (words taken, repeats counted) of every document.

    Null text has size 0; null sources form one source, last in order. Rows equal in id and text share
    one fate; empty documents take no words; an empty table gives an empty result. Other columns are
    ignored.
    """
    measured = materialize(measure(docs), "measured")
    limits = thresholds(measured, targets(measured, weights, budget, max_repeat), max_repeat)
    return choose(measured, limits).select("doc_id", "size", "source_size", "target",
                                           (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), budget: float = 1.0,
                    max_repeat: int = 3) -> DataFrame:
    """The mixed corpus: every document as many times as it is taken, with its own columns."""
    names = docs.columns
    measured = materialize(measure(docs), "measured")
    limits = thresholds(measured, targets(measured, weights, budget, max_repeat), max_repeat)
    # Columns of the documents travel in a struct, so that no name can clash.
    rows = docs.select(F.struct(*names).alias("__doc"), "source", hash60(F.col("doc_id"), F.col("text")).alias("h"))
    taken = choose(rows, limits).filter("copies > 0")
    return (taken.withColumn("__n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("__doc.*"))

"""URL filter: rules, and for the rest a ratio of two character language models.

URLs that a rule accepts and URLs that a rule rejects each train a variable-order Markov model over
characters (contexts of up to ``ORDER`` characters, Witten-Bell smoothing). A URL's score is the
difference of its two log-likelihoods divided by its length; the threshold is calibrated on rule-judged
URLs kept out of the training. All of it is DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import materialize

ORDER = 4
START, END = chr(2), chr(3)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
UNIT = 1e9  # log ratios are summed as whole billionths, so that sums don't depend on their order
BINS_PER_NAT = 256


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


# Fixed values of the contract.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null without one."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def windows(addresses: DataFrame, *keep: str) -> DataFrame:
    """One row per character of ``address`` and its end: the character with the ORDER characters before it."""
    padded = F.concat(F.lit(START * ORDER), F.col("address"), F.lit(END))
    places = F.sequence(F.lit(1), F.length("address") + 1)
    return addresses.select(*keep, F.explode(F.transform(places, lambda i: F.substring(padded, i, ORDER + 1))).alias("window"))


def suffixes(window: Column) -> Column:
    """The window's last 1 .. ORDER + 1 characters, with their number, as an array of structs."""
    return F.array(*[F.struct(F.lit(k).alias("k"), F.substring(window, ORDER + 2 - k, k).alias("gram"),
                              F.substring(window, ORDER + 2 - k, k - 1).alias("context"))
                     for k in range(1, ORDER + 2)])


def train(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Gram counts and context counts of both classes from (address, accepted boolean).

    Grams: gram, a, r. Contexts: context, an, rn (occurrences), at, rt (different next characters).
    """
    whole = windows(labelled, "accepted").groupBy("window").agg(
        F.sum(F.col("accepted").cast("long")).alias("a"), F.sum((~F.col("accepted")).cast("long")).alias("r"))
    grams = (whole.select(F.explode(suffixes(F.col("window"))).alias("s"), "a", "r")
             .groupBy("s.gram", "s.context").agg(F.sum("a").alias("a"), F.sum("r").alias("r")))
    grams = materialize(grams, "url-grams")
    contexts = grams.groupBy("context").agg(
        F.sum("a").alias("an"), F.sum("r").alias("rn"),
        F.sum((F.col("a") > 0).cast("long")).alias("at"), F.sum((F.col("r") > 0).cast("long")).alias("rt"))
    return grams.select("gram", "a", "r"), materialize(contexts, "url-contexts")


def window_ratios(wanted: DataFrame, grams: DataFrame, contexts: DataFrame, alphabet: int) -> DataFrame:
    """window, ratio (log of the two smoothed probabilities' quotient, in billionths) of distinct windows."""
    parts = (wanted.select("window", F.explode(suffixes(F.col("window"))).alias("s")).select("window", "s.*")
             .join(grams, "gram", "left").join(contexts, "context", "left"))
    steps = parts.groupBy("window").agg(F.sort_array(F.collect_list(F.struct(
        "k", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("a", "r", "an", "rn", "at", "rt")]))).alias("steps"))

    def smoothed(n: str, total: str, kinds: str) -> Column:
        # Shortest context first: each longer one that was seen mixes its counts with the estimate so far.
        return F.aggregate("steps", F.lit(1.0 / alphabet), lambda p, s: F.when(
            s[total] > 0, (s[n] + s[kinds] * p) / (s[total] + s[kinds])).otherwise(p))

    ratio = F.log(smoothed("a", "an", "at")) - F.log(smoothed("r", "rn", "rt"))
    return steps.select("window", F.round(ratio * UNIT).cast("long").alias("ratio"))


def calibrate(held: DataFrame) -> float:
    """Threshold with the best balanced accuracy on (accepted, score), nearest to 0 on ties; 0 if a class is missing."""
    place = F.floor(F.least(F.greatest(F.col("score"), F.lit(-40.0)), F.lit(40.0)) * BINS_PER_NAT).cast("int")
    bins = held.groupBy(place.alias("bin")).agg(F.sum(F.col("accepted").cast("long")).alias("a"),
                                                F.sum((~F.col("accepted")).cast("long")).alias("r")).collect()
    good, bad = sum(b["a"] for b in bins), sum(b["r"] for b in bins)
    if not good or not bad:
        return 0.0
    best, below_a, below_r = [], 0, 0
    for b in [*sorted(bins, key=lambda b: b["bin"]), None]:
        edge = b["bin"] if b else max(x["bin"] for x in bins) + 1
        best.append((-((good - below_a) / good + below_r / bad), abs(edge), edge))
        if b:
            below_a, below_r = below_a + b["a"], below_r + b["r"]
    return min(best)[2] / BINS_PER_NAT


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, held_share: int = 5) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every row; score is the length-normalised log ratio.

    A null URL has an empty host and path and is judged as the empty address. One in ``held_share`` of the
    rule-judged addresses (by hash) calibrates the threshold, the others train. Without rule-judged
    addresses of a class its model is uniform. Repeated rows get equal verdicts, an empty table gives an
    empty result; other columns are ignored.
    """
    host, path = host_and_path(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = judged.select("*", rule.alias("rule"), verdict.alias("by_rule"),
                           F.concat("host", "path").alias("address"))
    # Equal addresses are scored once. The same address always falls under the same rule.
    addresses = materialize(judged.groupBy("address").agg(F.max("by_rule").alias("by_rule")), "url-addresses")
    accepted = (F.col("by_rule") == "allow").alias("accepted")
    held = F.conv(F.substring(F.md5(F.col("address").cast("binary")), 1, 8), 16, 10).cast("long") % held_share == 0
    labelled = addresses.filter("by_rule IS NOT NULL").select("address", accepted, held.alias("held"))
    grams, contexts = train(labelled.filter(~F.col("held")))
    places = windows(addresses, "address")
    wanted = materialize(places.select("window").distinct(), "url-windows")
    alphabet = wanted.select(F.substring("window", ORDER + 1, 1).alias("c")).distinct().count() + 1
    ratios = materialize(window_ratios(wanted, grams, contexts, alphabet), "url-ratios")
    scores = (places.join(ratios, "window").groupBy("address")
              .agg((F.sum("ratio") / F.lit(UNIT) / F.count(F.lit(1))).alias("score")))
    scores = materialize(scores, "url-scores")
    threshold = calibrate(labelled.filter("held").join(scores, "address").select("accepted", "score"))
    by_method = F.when(F.col("score") >= F.lit(threshold), F.lit("allow")).otherwise(F.lit("block"))
    return judged.join(scores, "address").select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", by_method).alias("verdict"),
        F.round("score", 6).alias("score"))

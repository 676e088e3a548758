"""Registered queries of the operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.llm import (
    deleted_interpolation,
    edit_fingerprint,
    fill_in_middle,
    knn,
    mixing,
    pieces,
    sharding,
    simhash,
    surrogates,
    token_store,
    toxicity,
    url_filter,
    whitening,
)
from shoplake.llm.common import prepare, table
from shoplake.llm.oracle import ORACLES
from shoplake.session import scratch_dir

# Files of the public tokenizers package.
PIECES, BYTE_BPE = "piece_bpe_32k.model", "byte_bpe_50k.json"

# A deployment passes a key of its own; who has it can repeat the replacement.
SURROGATE_KEY = "demonstration key"

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights 5, 2, 1 by source, at most three times each."""
    prepare(spark)
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the rules, and by the language-model ratio where none fits."""
    prepare(spark)
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by surrogates."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.pseudonymised(docs, SURROGATE_KEY)


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and the text decoded from them."""
    prepare(spark)
    segmenter = pieces.Segmenter(pieces.Vocabulary.read(public_tokenizers.path(PIECES)))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    encoded = pieces.encode(docs, segmenter)
    decoded = pieces.decode(encoded, segmenter)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    prepare(spark)
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(found["fp"]).alias("fingerprint"), "component_id")


def op6_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows by inner product for every twentieth embedding."""
    prepare(spark)
    return knn.search(table(spark, sf_dir, "embeddings"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    prepare(spark)
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids written to Parquet list columns and read back."""
    prepare(spark)
    path = scratch_dir(spark, "llm-tokens")
    token_store.write(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), path)
    stored = token_store.read(spark, path)
    return stored.select("doc_id", "start", "n_tokens", token_store.crc_of_ids(stored["ids"]).alias("ids_crc32"))


def op9_edit_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edit-embedding fingerprints of every document and its edited text, compared."""
    prepare(spark)
    return edit_fingerprint.compare_with_next(table(spark, sf_dir, "documents"))


def op10_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bigram language-model score of every document, beside a smoothed unigram score."""
    prepare(spark)
    return deleted_interpolation.score(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at two line ends and reordered, and restored from that."""
    prepare(spark)
    done = fill_in_middle.transform(table(spark, sf_dir, "documents"))
    restored = fill_in_middle.restored(done["output"], done["form"])
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored, 256).alias("restored_sha256"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents shuffled into 24 written shards, read back."""
    prepare(spark)
    path = scratch_dir(spark, "llm-shards")
    sharding.write(table(spark, sf_dir, "documents"), path)
    stored = sharding.read(spark, path)
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return stored.select("doc_id", sharding.record_size().alias("size"), crc.alias("text_crc32"),
                         F.lit(sharding.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding whitened to its 16 strongest components."""
    prepare(spark)
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_mixing, op2_url_filter, op3_surrogates, op4_pieces, op5_simhash, op6_knn,
                                    op7_toxicity, op8_token_store, op9_edit_fingerprint,
                                    op10_deleted_interpolation, op11_fill_in_middle, op12_sharding, op13_whitening)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)

import __spark_entry__ as entry
import corpus_pipeline
from shoplake.llm import queries

SF = "/root/testdata/sf0.001"


def test_every_query_is_registered():
    names = entry.queries()
    assert set(queries.queries()) <= set(names) and names["pipeline"] is corpus_pipeline.run
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(names)


def test_stages_on_a_small_corpus(spark):
    from shoplake.llm import mixing, simhash, toxicity
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], SF).cache())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert frames[-1].columns == docs.columns
    before, clean, unique, replaced, mixed, encoded = frames
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    toxic = {r["doc_id"] for r in toxicity.judge(docs, labels).filter("predicted = 1").collect()}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in before.collect()} - toxic
    groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(clean).collect()}
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted(set(groups.values()))
    texts = {r["doc_id"]: r["text"] for r in replaced.collect()}
    assert texts.keys() == {r["doc_id"] for r in unique.collect()}
    assert all(r["n_chars"] == len(r["text"]) for r in replaced.collect())
    words = sum(r["taken"] for r in mixing.mix(replaced).collect())
    assert sum(len(r["text"].encode().split()) for r in mixed.collect()) == words
    assert encoded.count() == mixed.count() and encoded.filter("NOT round_trip").count() == 0


def test_stages_on_odd_rows_and_an_empty_table(spark, odd_texts):
    """Null ids, sources and texts, empty and very long texts, ties, repeated rows, clashing columns: no stage fails,
    and what is no copy, not toxic and not mixed away comes through whole."""
    rows = [(i, t, None, s, None if t is None else len(t), "x", 1) for i, t, s in odd_texts]
    schema = "doc_id long, text string, lang string, source string, n_chars long, size string, score int"
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before, docs = docs, stage(spark, docs, SF).cache()
            assert docs.columns == before.columns, name
            kept = {(r["doc_id"], r["text"]) for r in before.collect()}
            if name in ("toxicity", "simhash_dedup", "source_mixing"):
                assert {(r["doc_id"], r["text"]) for r in docs.collect()} <= kept
        encoded = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert encoded.count() == docs.count() and encoded.filter("NOT round_trip").count() == 0

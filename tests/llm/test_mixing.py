import duckdb
import pandas as pd

from shoplake.llm import mixing
from shoplake.llm.oracle import OP1_MIXING


def oracle(rows):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"}))
    return con.sql(OP1_MIXING).df()


def rows_of(df):
    return sorted((-1 if pd.isna(i) else int(i), size, source_size, round(target, 6), taken) for i, size, source_size, target, taken
                  in zip(df["doc_id"], df["size"], df["source_size"], df["target"], df["taken"], strict=True))


def test_odd_rows_match_plain_sql(make_docs, odd_texts):
    got = mixing.mix(make_docs(odd_texts)).toPandas()
    want = oracle(odd_texts)
    assert rows_of(got) == rows_of(want)
    assert len(got) == len(odd_texts)


def test_targets_are_near_and_capped(make_docs):
    rows = [(i, "w " * (1 + i * 7 % 90), f"s{i % 7 if i % 3 else 0}") for i in range(3000)]
    got = mixing.mix(make_docs(rows, clash=False)).toPandas()
    assert (got["taken"] <= 3 * got["size"]).all() and (got["taken"] % got["size"] == 0).all()
    by = got.merge(pd.DataFrame(rows, columns=["doc_id", "text", "source"]), on="doc_id").groupby("source")
    for _, part in by:
        assert abs(part["taken"].sum() - part["target"].iloc[0]) <= part["size"].max()
        assert part["target"].iloc[0] <= 3 * part["source_size"].iloc[0]
    assert abs(by["target"].first().sum() - got["size"].sum()) < 1e-6 * got["size"].sum()


def test_larger_budget_contains_smaller(make_docs):
    docs = make_docs([(i, "a b c " * (i % 11), f"s{i % 4}") for i in range(500)], clash=False)
    small, large = (mixing.mix(docs, budget=b).toPandas().set_index("doc_id")["taken"].sort_index() for b in (0.4, 0.9))
    assert (small <= large).all() and small.sum() < large.sum()


def test_empty_table(make_docs):
    assert mixing.mix(make_docs([])).count() == 0
    assert mixing.mixed_documents(make_docs([])).count() == 0


def test_mixed_documents_repeat_rows(make_docs, odd_texts):
    docs = make_docs(odd_texts)
    taken = mixing.mix(docs).toPandas()
    rows = mixing.mixed_documents(docs)
    assert rows.columns == docs.columns
    words = sum(len((r["text"] or "").encode().split()) for r in rows.collect())
    assert words == taken["taken"].sum()


def test_empty_documents_of_a_capped_source_are_not_repeated_beyond_the_cap(make_docs):
    """Source a is at its cap of three takes; its empty document is not taken a fourth time."""
    docs = make_docs([(1, "", "a"), (4, "x y z", "a"), *[(10 + i, "w " * 50, "b") for i in range(5)]])
    copies = mixing.mixed_documents(docs, weights=(5, 1)).groupBy("doc_id").count().collect()
    assert all(r["count"] <= 3 for r in copies)
    assert {r["doc_id"]: r["count"] for r in copies}[4] == 3

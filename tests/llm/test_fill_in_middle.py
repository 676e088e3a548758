import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoplake.llm import fill_in_middle as fim

PATTERNS = {"line": r"[^\n]*\n|[^\n]+", "char": r"(?s)."}


def plainly(doc_id, text, unit="line", key="7", rate=100, spm_share=50):
    digest = hashlib.sha256(f"{key}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    text = text or ""
    units = re.findall(PATTERNS[unit], text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return (doc_id, n, "plain", None, None, text)
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_share:
        return (doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}")


EXTRA = [(20, "\n"), (21, "\n\n\na"), (22, "a\r\nb\n"), (23, "é\n日本\n𝔘𝔫\n" * 3), (24, "has <S> in\nit\n"), (25, "\x8a\n\x0b\n"),
         (26, "line \n" * 30_000), (27, "x" * 70_000 + "\n")] + [(i, "one\ntwo\nthree\nfour\nfive") for i in range(30, 60)]


@pytest.mark.parametrize("unit,rate,spm_share", [("line", 100, 50), ("char", 70, 20)])
def test_rows_equal_the_plain_version(spark, make_docs, odd_texts, unit, rate, spm_share):
    rows = [(i, t) for i, t, _ in odd_texts] + EXTRA
    found = fim.transform(make_docs(rows), unit, rate=rate, spm_share=spm_share)
    found = found.withColumn("restored", fim.restored(F.col("output"), F.col("form"))).collect()
    want = [(*plainly(i, t, unit, rate=rate, spm_share=spm_share), t or "") for i, t in rows]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}


def test_empty_table(spark, make_docs):
    assert fim.transform(make_docs([])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("a\n\x0b\x8aéĊ日𝔘"), max_size=40), min_size=1, max_size=6), st.sampled_from(fim.UNITS),
       st.integers(0, 2**32), st.integers(0, 2**32))
def test_cuts_in_a_buffer_of_texts(texts, unit, h1, h2):
    coded = [t.encode() for t in texts]
    ends = np.cumsum([len(c) for c in coded])
    starts = np.r_[0, ends[:-1]]
    draws = tuple(np.full(len(texts), h) for h in (h1, h2))
    n, one, two = fim.cuts(np.frombuffer(b"".join(coded), np.uint8), starts, ends, draws, unit)
    for i, text in enumerate(texts):
        units = re.findall(PATTERNS[unit], text)
        a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
        assert n[i] == len(units)
        assert one[i] - starts[i] == len("".join(units[:a]).encode())
        assert two[i] - starts[i] == len("".join(units[:b]).encode())


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=100))
def test_rank_and_select(data):
    buffer = np.frombuffer(data, np.uint8)
    marks = fim.Marks(fim.newline_marks(buffer))
    places = [i for i, b in enumerate(data) if b == 10]
    assert marks.rank(np.arange(len(data) + 1)).tolist() == [sum(p < i for p in places) for i in range(len(data) + 1)]
    assert marks.select(np.arange(len(places))).tolist() == places

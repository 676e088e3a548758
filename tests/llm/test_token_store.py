import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shoplake.llm import token_store

PATH = public_tokenizers.path("byte_bpe_50k.json")


LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library():
    texts = ["", " ", "a  b", "a \nb", "a\n\n b c", " \t x", "it's  don't\r\nx", "日本 語　x", "<|endoftext|> x", "x  y", "<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>", "<|endoftext|",
             "abc1 abc, it' don't, Straße Ελλάδα, мир! a1b x's ab's. end\n", "one two\nthree four\tfive '' ,, a, ,a a,b", "\n", "\na\n\nb c\n", "a\n\n", "a b\n\n\nc. d,\ne", "\n\n", "a\r\n\r\nb",
             "é́ ؀", "\x1c a", "a.b,c! 12 3", "word " * 50 + "\n"]
    encoder = token_store.Encoder(PATH)
    for text in texts * 2:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library_ids(text), repr(text)


def test_encoder_equals_the_library_on_mixed_texts():
    rng = random.Random(1)
    encoder = token_store.Encoder(PATH)
    parts = [" ", " ", " ", "\n", "\n\n", "\t", "it's", "don't", "Word", "ü", "1", "23", ".", ",", "'", "--", "<|", "日本", "мир", "é", "aB"]
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 14)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library_ids(text), repr(text)


@pytest.mark.parametrize("encoding", ["delta", "dictionary"])
def test_store_and_selective_reads(spark, make_docs, odd_texts, tmp_path, encoding):
    path = str(tmp_path / "tokens")
    token_store.write(make_docs(odd_texts), PATH, path, encoding=encoding, page_bytes=4096)
    stored = token_store.read(spark, path)
    rows = stored.withColumn("crc", token_store.crc_of_ids(F.col("ids"))).collect()
    assert len(rows) == len(odd_texts)
    texts = {i: t for i, t, _ in odd_texts}
    before = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert (r["start"], r["n_tokens"]) == (before, len(r["ids"])) and r["ids"][-1] == 0
        before += r["n_tokens"]
        if r["doc_id"] is not None:
            want = np.array([*library_ids(texts[r["doc_id"]]), 0], "<u4")
            assert r["ids"] == want.tolist() and r["crc"] == zlib.crc32(want.tobytes())
    ids = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"]) if r["doc_id"] is not None]
    assert ids == sorted(ids)
    some = token_store.read(spark, path, F.col("doc_id") == 9).collect()
    assert len(some) == 1 and some[0]["start"] == next(r["start"] for r in rows if r["doc_id"] == 9)
    plan = token_store.read_numbers(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "n_tokens" in plan and "ids" not in plan
    column = next(c for f in (tmp_path / "tokens").glob("*.parquet") for c in [pq.ParquetFile(f).metadata.row_group(0).column(4)])
    used = set(column.encodings)
    assert ("DELTA_BINARY_PACKED" in used) == (encoding == "delta")
    assert column.has_offset_index


def test_empty_table(spark, make_docs, tmp_path):
    token_store.write(make_docs([]), PATH, str(tmp_path / "none"))
    assert token_store.read(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("piece_bytes", [1, 5, 30, 4 << 20])
def test_batches_equal_the_library(monkeypatch, piece_bytes):
    monkeypatch.setattr(token_store, "PIECE_BYTES", piece_bytes)
    rng = random.Random(piece_bytes)
    encoder = token_store.Encoder(PATH)
    parts = [" ", " ", " ", "  ", "\n", "\t", "\r\n", "'s", "'re", "'ll", "'v", "'", "''", "e", "it's", "Word", "ü", "½", "1", ".", ",",
             "日本", "мир", "가", "’", "<|", "<|endoftext|>", "\u3000", "😀"]
    for kind in (pa.string(), pa.large_string()):
        texts = ["".join(rng.choices(parts[:rng.choice([25, len(parts)])], k=rng.randrange(20))) for _ in range(1000)]
        texts[::100] = [None] * 10
        found = encoder.encode_all(pa.array(["it's"] + texts, kind).slice(1)).to_pylist()
        assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [library_ids(t) for t in texts]
    assert len(encoder.encode_all(pa.array([], pa.string()))) == 0


def test_a_match_is_encoded_once(monkeypatch):
    """The model sees each distinct match once, whatever signs stand around it."""
    encoder = token_store.Encoder(PATH)
    seen, looked_up = [], []
    tokenize, missing = encoder.matches.tokenize, type(encoder.matches).__getitem__
    encoder.matches.tokenize = lambda match: seen.append(match) or tokenize(match)
    monkeypatch.setattr(type(encoder.matches), "__getitem__", lambda d, m: looked_up.append(m) or missing(d, m), raising=False)
    texts = ["a word, a word. a word! a word; a word&&& a word*** a word"] * 50
    found = encoder.encode_all(pa.array(texts)).to_pylist()
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [library_ids(t) for t in texts]
    assert sorted(seen) == sorted({"a", "Ġa", "Ġword", ",", ".", "!", ";", "&&&", "***"})
    assert len(looked_up) == len(seen)  # 50 texts, one look-up a distinct match

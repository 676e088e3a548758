import math
import random
import struct

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from shoplake.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def segmenter():
    return pieces.Segmenter(pieces.Vocabulary.read(PATH))


def best_sum(text, vocabulary, table):
    """Largest sum of scores over all segmentations of the marked text, character by character."""
    text = ("▁" if text else "") + text.replace(" ", "▁")
    unknown = min(s for s, k in zip(vocabulary.scores, vocabulary.kinds, strict=True) if k == pieces.NORMAL) - 10
    best = [0.0] + [-math.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 50), end):
            score = table.get(text[start:end], unknown if end - start == 1 else None)
            if score is not None:
                best[end] = max(best[end], best[start] + score)
    return best[-1]


def test_vocabulary_matches_the_library():
    own, theirs = pieces.Vocabulary.read(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert own.pieces == [theirs.id_to_piece(i) for i in range(theirs.get_piece_size())]
    assert own.scores == [theirs.get_score(i) for i in range(theirs.get_piece_size())]


def test_trie_finds_all_and_only_the_keys():
    keys = [(bytes(random.Random(i).choices(b"abc\xff\x00", k=1 + i % 6)), i) for i in range(300)]
    keys = list(dict(keys).items())
    trie = pieces.DoubleArray(keys)

    def find(key):
        state = 0
        for byte in key:
            target = trie.base[state] + byte
            if target >= len(trie.check) or trie.check[target] != state or target == 0:
                return -1
            state = target
        return trie.value[state]

    assert all(find(k) == v for k, v in keys)
    assert find(b"zzz") == -1 and find(b"") == -1


def test_segmentations_have_the_best_sum(segmenter):
    v = pieces.Vocabulary.read(PATH)
    table = {p: s for p, s, k in zip(v.pieces, v.scores, v.kinds, strict=True) if k == pieces.NORMAL}
    texts = ["the quick brown fox", "  a  b", "thblely anreed hestwh of.", "ünïcode 日本語", "12,345.67", "x", "   "]
    unknown = min(table.values()) - 10
    for text, ids in zip(texts, segmenter.encode(texts), strict=True):
        found = sum(unknown / 4 if v.kinds[i] == pieces.BYTE else v.scores[i] for i in ids)
        if all(v.kinds[i] != pieces.BYTE for i in ids):
            assert found == best_sum(text, v, table)


def test_against_the_library_with_log_scores(tmp_path):
    """The same pieces as a unigram model with logarithmic scores: sums equal the library's best ones."""
    def number(n):
        return bytes([n & 127 | 128]) + number(n >> 7) if n > 127 else bytes([n])

    def field(f, data):
        return number(f << 3 | 2) + number(len(data)) + data

    out = b""
    with open(PATH, "rb") as f:
        raw = f.read()
    for f, value in pieces._fields(raw):
        if f == 1:
            d = dict(pieces._fields(value))
            score = struct.unpack("<f", d[2])[0]
            if d.get(3, 1) == pieces.NORMAL:
                score = -math.log(2 - score) if score > -1e8 else -20.0
            out += field(1, field(1, d[1]) + number(2 << 3 | 5) + struct.pack("<f", score)
                         + (number(3 << 3) + number(d[3]) if 3 in d else b""))
        elif f == 2:
            at = value.index(b"\x18\x02")  # the trainer's model type, here made unigram
            out += field(2, value[:at] + b"\x18\x01" + value[at + 2:])
        else:
            out += field(f, value)
    path = tmp_path / "unigram.model"
    path.write_bytes(out)
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    own = pieces.Segmenter(pieces.Vocabulary.read(str(path)))
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices(["th", "er", "ing", "é", "ß", "q", "1", ".", "日"], k=rng.randrange(1, 6)))
                      for _ in range(20)) for _ in range(40)] + ["", " ", "a\tb\n\nc", "日本 語"]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        want = library.encode(text)
        assert math.isclose(sum(own.scores[i] for i in ids), sum(own.scores[i] for i in want), abs_tol=1e-3)
        assert library.decode([int(i) for i in ids]) == text


def test_round_trips_and_pieces_of_long_texts(segmenter, monkeypatch):
    texts = ["", " ", "a", "tab\tline\n\r", "  two  spaces  ", "日本語 😀 \x00", "x" * 5000, "word " * 3000]
    whole = segmenter.encode(texts)
    assert [segmenter.decode(i.tolist()) for i in whole] == texts
    monkeypatch.setattr(pieces, "PIECE_CHARS", 100)
    monkeypatch.setattr(pieces, "CHUNK_CHARS", 50)
    monkeypatch.setattr(pieces, "MEMO_WORDS", 5)
    assert all(np.array_equal(a, b) for a, b in zip(whole, segmenter.encode(texts), strict=True))


def test_odd_rows(make_docs, odd_texts, segmenter):
    docs = make_docs(odd_texts)
    rows = pieces.decode(pieces.encode(docs, segmenter), segmenter).collect()
    want = sorted((str(i), (t or "").replace("▁", " ")) for i, t, _ in odd_texts)
    assert sorted((str(r["doc_id"]), r["decoded"]) for r in rows) == want
    assert pieces.encode(make_docs([]), segmenter).count() == 0

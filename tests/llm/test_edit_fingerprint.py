import hashlib
import random

import numpy as np

from shoplake.llm import edit_fingerprint as ef


def plain_embedding(text):
    """The slots by walking one character at a time."""
    waits, (steps, slots) = ef._waits(), ef._records()
    codes, at, shown = ef._codes(text), 0, []
    for code, c in zip(codes, (codes * np.uint32(2654435761)) >> np.uint32(29), strict=True):
        wait = int(waits[c, at % ef.PERIOD])
        shown += [code] * wait
        at += wait
    out = np.zeros(ef.SLOTS, np.uint8)
    for step, slot in zip(steps, slots, strict=True):
        if step < len(shown):
            out[slot] = (ef._mix(np.array([shown[step]]), 77) >> np.uint64(40)).astype(np.uint8)[0]
    return out


def test_walk_equals_the_plain_one(monkeypatch):
    for text in ["", "a", "ab", "hello wörld 日本", "x" * 1000, "the quick brown fox " * 30]:
        assert np.array_equal(ef.embed(text), plain_embedding(text))
        monkeypatch.setattr(ef, "PIECE", 7)
        assert np.array_equal(ef.embed(text), plain_embedding(text))
        monkeypatch.undo()


def test_few_edits_few_differences():
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcdefgh ", k=3000)) for _ in range(12)]

    def edited(text, edits):
        chars = list(text)
        for _ in range(edits):
            p = rng.randrange(len(chars))
            chars[p:p + 1] = rng.choice([[], ["z"], ["y", "z"]])
        return "".join(chars)

    near = [np.mean([ef.likeness(ef.embed(t), ef.embed(edited(t, k))) for t in texts]) for k in (0, 2, 30, 1500)]
    assert near[0] == 1.0 > near[1] > 0.9 > near[2] > near[3]
    other = "".join(rng.choices("uvwxyz.", k=3000))
    assert ef.likeness(ef.embed(texts[0]), ef.embed(other)) < 0.2


def test_odd_rows_in_many_ranges(make_docs, odd_texts):
    order = sorted(odd_texts, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    texts = [t or "" for _, t, _ in order]
    for parts in (1, 5):
        got = ef.compare_with_next(make_docs(odd_texts), parts).collect()
        want = []
        for i, text in enumerate(texts):
            following = texts[(i + 1) % len(texts)]
            half = len(text) // 2
            edited = text[:len(text) - half] + following[:half]
            a, b, c = ef.embed(text), ef.embed(edited), ef.embed(following)
            want.append((str(order[i][0]), len(text), hashlib.sha256(edited.encode()).hexdigest(), a.tobytes().hex(),
                         b.tobytes().hex(), ef.likeness(a, b), ef.likeness(a, c)))
        assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)
    assert ef.compare_with_next(make_docs([])).count() == 0


def test_near_duplicates_are_linked(make_docs):
    rng = random.Random(9)
    rows, family = [], {}
    for f in range(4):
        text = "".join(rng.choices("abcdefghij klmnop", k=6000))
        for i in range(4):
            k = rng.randrange(len(text))
            rows.append((10 * f + i, text[:k] + "#" + text[k + 1:] if i else text, "a"))
            family[10 * f + i] = 10 * f
    rows += [(98, "", "a"), (99, None, "a")]
    got = {r["doc_id"]: r["component_id"] for r in ef.near_duplicates(make_docs(rows)).collect()}
    assert got == family | {98: 98, 99: 98}


def test_differences_spread_over_all_bands_lose_no_link(make_docs, monkeypatch):
    """51 differing slots, one in every eight and more, leave a likeness of 0.80."""
    from pyspark.sql import functions as F
    spread = bytes(1 if i % 8 == 0 or i % 13 == 1 or i in (3, 5) else 0 for i in range(ef.SLOTS))
    prints = {"a": bytes(ef.SLOTS).hex(), "b": spread.hex(), "c": (b"\x02" * ef.SLOTS).hex()}
    assert 0.8 <= 1 - sum(spread) / ef.SLOTS < 0.81
    monkeypatch.setattr(ef, "fingerprints", lambda docs: docs.select("doc_id", F.create_map(
        *[F.lit(x) for kv in prints.items() for x in kv])[F.col("text")].alias("fingerprint")))
    got = {r["doc_id"]: r["component_id"] for r in ef.near_duplicates(make_docs([(1, "a", "x"), (2, "b", "x"), (3, "c", "x")])).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_texts_are_read_in_small_batches(spark, make_docs, tmp_path):
    """The reader holds few rows at a time: 256 texts of 30,000 characters are 8 MB, 4,096 would be 123 MB."""
    from shoplake.llm import queries

    make_docs([(i, f"{i} " * 50, "a") for i in range(600)]).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op9_edit_fingerprint(spark, str(tmp_path))
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 256
    assert sorted(r["doc_id"] for r in got.collect()) == list(range(600))

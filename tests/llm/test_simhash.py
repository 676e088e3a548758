import random

import numpy as np
import xxhash

from shoplake.llm import simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(prints, near=4):
    """Smallest key reachable, for each distinct fingerprint."""
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    keys = sorted(root)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if (a ^ b).bit_count() <= near:
                root[find(a)] = find(b)
    return {p: find(p) for p in keys}


def test_fingerprints_by_definition(odd_texts):
    for _, text, _ in odd_texts:
        if len(text or "") < 60_000:
            assert simhash.simhash(text) == plain_fingerprint(text)


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(random.Random(1).choices(["aa", "b", "cc", "dd", "e"], k=3000))
    whole = simhash.simhash(text)
    monkeypatch.setattr(simhash, "word_lists", lambda t: __import__("shoplake.llm.common", fromlist=["x"]).word_lists(t, 50))
    assert simhash.simhash(text) == whole == plain_fingerprint(text)


def test_odd_rows(make_docs, odd_texts):
    got = simhash.near_duplicates(make_docs(odd_texts)).collect()
    assert len(got) == len(odd_texts)
    prints = {plain_fingerprint(t) for _, t, _ in odd_texts}
    root = plain_components(prints)
    low = {}
    for i, t, _ in odd_texts:
        if i is not None:
            r = root[plain_fingerprint(t)]
            low[r] = min(low.get(r, 10**9), i)
    want = sorted((str(i), f"{plain_fingerprint(t):016x}", low.get(root[plain_fingerprint(t)])) for i, t, _ in odd_texts)
    assert sorted((str(r["doc_id"]), f"{r['fp'] & (1 << 64) - 1:016x}", r["component_id"]) for r in got) == want


def test_clusters_and_hot_buckets(spark):
    rng = random.Random(7)
    prints = set()
    for _ in range(3):  # dense families, far more than a block's rows in one bucket
        centre = rng.getrandbits(64)
        for _ in range(900):
            p = centre
            for b in rng.sample(range(20), rng.randrange(0, 6)):
                p ^= 1 << b
            prints.add(p)
    prints |= {rng.getrandbits(64) for _ in range(500)}
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    want = plain_components(prints)
    for parts in (None, [simhash.Part(tuple(range(32)), 2), simhash.Part(tuple(range(32, 64)), 1)],
                  [simhash.Part(tuple(range(22)), 0), simhash.Part(tuple(range(22, 43)), 1), simhash.Part(tuple(range(43, 64)), 1)]):
        got = {r["fp"]: r["root"] for r in simhash.groups(df, 4, parts).collect()}
        classes = {}
        for p in prints:
            classes.setdefault(want[p], set()).add(got[signed(p)])
        assert len(got) == len(prints)
        assert all(len(c) == 1 for c in classes.values())
        assert len(set().union(*classes.values())) == len(classes)


def test_allocation_covers_the_distance():
    cost, chosen = simhash.allocate([{-1: 0.0, 0: 5.0, 1: 7.0, 2: 9.0}] * 3, 4)
    assert sum(e + 1 for e in chosen) == 5 and cost == 9.0 + 7.0
    assert simhash.correlated_parts(10, np.eye(64) * 5, 5)[0]


def test_deduplicated_keeps_one_of_each_group(make_docs, odd_texts):
    docs = make_docs(odd_texts)
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    root = plain_components({plain_fingerprint(t) for _, t, _ in odd_texts})
    groups = [root[plain_fingerprint(r["text"])] for r in kept.collect()]
    assert len(groups) == len(set(groups)) == len(set(root.values()))
    assert simhash.deduplicated(make_docs([])).count() == 0
    assert simhash.near_duplicates(make_docs([])).count() == 0

import random
import re

import numpy as np
import pytest
import xxhash

from civiclake.llm import simhash
from civiclake.llm.components import smallest_reachable


def brute_fingerprint(text, k=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fingerprints, budget=3):
    roots = {n: n for n in fingerprints}

    def root(n):
        while roots[n] != n:
            n = roots[n]
        return n

    keys = sorted(fingerprints)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (fingerprints[a] ^ fingerprints[b]).bit_count() <= budget:
                x, y = root(a), root(b)
                roots[max(x, y)] = min(x, y)
    return {n: root(n) for n in keys}


def test_fingerprint_by_hand():
    for text in (None, "", " \t", "One", "one TWO", "a b c", "a b c a b c", "É ß x\x85y z w q", "x " * 1000):
        assert simhash.fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("limit", [8192, 3])
def test_components_against_all_pairs(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "TRIE_FINGERPRINTS", limit)
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1]
    values = set(base)
    for _ in range(400):
        value = rng.choice(sorted(values))
        for _ in range(rng.randint(1, 5)):
            value ^= 1 << rng.randrange(64)
        values.add(value)
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    links = simhash.near_links(spark.createDataFrame([(v,) for v in signed], "fp long"), 3)
    got = {r.node: r.root for r in smallest_reachable(links).collect()}
    unsigned = dict(enumerate(sorted(signed)))
    expected = brute_components({n: v & (1 << 64) - 1 for n, v in unsigned.items()})
    for n, value in unsigned.items():
        assert got.get(value, value) == unsigned[expected[n]]


def test_documents_against_all_pairs(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(40):
        words = [rng.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(rng.randrange(50)) for _ in range(120)]
        texts.append(" ".join(words))
        for _ in range(3):
            words[rng.randrange(120)] = "changed"
            texts.append(" ".join(words))
    texts += ["", None, " ", texts[0], texts[0].upper(), "long word " * 20000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[4])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS component_id", "3 AS root")
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    fingerprints = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    expected = brute_components(fingerprints)
    for row in got:
        own = 4 if row.doc_id is None else row.doc_id
        assert row.fingerprint == f"{fingerprints[own]:016x}"
        assert row.component_id == expected[own]


def test_empty_table(spark):
    got = simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string"))
    assert got.columns == ["doc_id", "fingerprint", "component_id"] and got.isEmpty()


def test_long_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(7, 7), (1000, 999)], "a long, b long")
    got = {r.node: r.root for r in smallest_reachable(links).collect()}
    assert got == {i: 0 for i in range(301)} | {999: 999, 1000: 999}

import hashlib
import random

import numpy as np
import pytest

from civiclake.llm import edit_embedding as ee

COINS = ee.coins()


def brute_embedding(text):
    """The character the walk stands on at each step."""
    out, time = [], 0
    for ch in text:
        c = int(ee.character_class(np.array([ord(ch)], np.uint32))[0])
        while True:
            out.append(ch)
            heads = COINS[c, time % ee.PERIOD]
            time += 1
            if heads:
                break
    return out


def brute_hash(x):
    mask = (1 << 64) - 1
    x = (x + 1) * 0x9E3779B97F4A7C15 & mask
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & mask
    x = (x ^ x >> 27) * 0x94D049BB133111EB & mask
    return x ^ x >> 31


def brute_fingerprint(text):
    walk = brute_embedding(text or "")
    places = sorted(range(len(walk) * ee.PLANES), key=lambda z: brute_hash(z ^ 0x9E3779B97F4A7C15))[: ee.SAMPLE]
    bits = "".join(str(brute_hash(z << 21 ^ ord(walk[z // ee.PLANES])) >> 63) for z in places)
    bits += "0" * (-len(bits) % 8)
    return f"{len(walk):x}-" + "".join(f"{int(bits[i : i + 8], 2):02x}" for i in range(0, len(bits), 8)), walk


def brute_likeness(a, b):
    """Over the coordinates that the longer walk's sample and the shorter walk have."""
    (a, x), (b, y) = sorted([brute_fingerprint(a), brute_fingerprint(b)], key=lambda f: len(f[1]))
    if a == b:
        return 1.0
    places = sorted(range(len(y) * ee.PLANES), key=lambda z: brute_hash(z ^ 0x9E3779B97F4A7C15))[: ee.SAMPLE]
    bit = lambda walk, z: brute_hash(z << 21 ^ ord(walk[z // ee.PLANES])) >> 63
    total = sum(1 if bit(x, z) == bit(y, z) else -1 for z in places if z < len(x) * ee.PLANES)
    return min(1.0, max(0.0, total / len(places)))


def prose(rng, n):
    return "".join(rng.choice("etaoin shrdlu, ABé漢😀") for _ in range(n))


def test_fingerprints_of_the_walk_by_hand():
    rng = random.Random(1)
    texts = [None, "", "a", "é", "ab", "😀" * 5, *(prose(rng, n) for n in (3, 15, 16, 17, 31, 40, 300, 3000))]
    for text in texts:
        assert ee.fingerprint(text) == brute_fingerprint(text)[0]
    for a, b in zip(texts[1:], texts[2:]):
        assert ee.likeness(ee.fingerprint(a), ee.fingerprint(b)) == pytest.approx(brute_likeness(a, b), abs=1e-6)


def test_pieces_and_later_starts_make_no_difference(monkeypatch):
    rng = random.Random(2)
    text = prose(rng, 5000)
    whole = ee.fingerprint(text)
    codes = ee.code_points(text)
    rest = ee.rests(codes)
    for cut in (0, 1, 777, 5000):
        again = ee.rests(codes[cut:], int(rest[:cut].sum()))
        assert (np.r_[rest[:cut], again] == rest).all()
    monkeypatch.setattr(ee, "PIECE", 64)
    assert ee.fingerprint(text) == whole


def test_likeness_falls_with_edits():
    rng = random.Random(3)
    means = []
    for edits in (0, 3, 30, 300):
        values = []
        for _ in range(12):
            text = prose(rng, 2000)
            other = list(text)
            for _ in range(edits):
                at = rng.randrange(len(other))
                other[at : at + rng.randrange(2)] = rng.choice(["", "x", "yz"])
            values.append(ee.likeness(ee.fingerprint(text), ee.fingerprint("".join(other))))
        means.append(sum(values) / len(values))
    assert means[0] == 1 and means[1] > 0.8 and means[0] > means[1] > means[2] > means[3] and means[3] < 0.4
    assert ee.likeness(ee.fingerprint(""), ee.fingerprint("some text")) == 0


def brute_rows(docs):
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    return sorted(brute_pairs(list(zip(order, order[1:] + order[:1]))), key=repr)


def brute_pairs(pairs):
    out = []
    for (key, text), (_, following) in pairs:
        text, following = text or "", following or ""
        n = len(text)
        edited = text[: n - n // 2] + following[: n // 2]
        a, b, c = (ee.fingerprint(t) for t in (text, edited, following))
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out.append((key, n, sha, a, b, round(ee.likeness(a, b), 9), round(ee.likeness(a, c), 9)))
    return out


def got_rows(spark, docs):
    df = spark.createDataFrame([(*d, "x", 5) for d in docs], "doc_id bigint, text string, fingerprint string, row int")
    rows = ee.edited_fingerprints(df.repartition(3)).collect()
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in rows), key=repr)


def test_query_columns_against_brute_force(spark):
    rng = random.Random(5)
    docs = [(i * 3 % 101, prose(rng, rng.choice([0, 1, 2, 7, 100, 900]))) for i in range(60)]
    docs += [(200, None), (-1, ""), (201, prose(rng, 70_000)), (202, "same"), (203, "same")]
    assert got_rows(spark, docs) == brute_rows(docs)


@pytest.mark.parametrize("docs", [[], [(1, "alone é")], [(1, "two"), (2, None)], [(None, "no id"), (4, "some"), (9, "more")]])
def test_few_rows(spark, docs):
    assert got_rows(spark, docs) == brute_rows(docs)


def test_repeated_rows_follow_each_other(spark):
    docs = [(7, "the same row")] * 50 + [(6, "before"), (8, "afterwards")]
    got = got_rows(spark, docs)
    assert got == brute_rows(docs)
    several = got_rows(spark, [(7, "one"), (7, "two"), (7, "three")])
    assert sorted(r[1] for r in several) == [3, 3, 5]


def test_an_id_with_many_rows_is_cut(spark):
    rng = random.Random(6)
    docs = [(5, prose(rng, 40)) for _ in range(300)] + [(None, prose(rng, 30)) for _ in range(300)]
    docs += [(i, prose(rng, 50)) for i in range(6, 40)] + [(4, "x")] * 200
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    bounds = ee._boundaries(df, "doc_id", "text", 32)
    without = [ee._signed(ee.xxhash.xxh64_intdigest(t.encode(), 42)) for k, t in docs if k is None]
    assert bounds == sorted(set(bounds)) and bounds[0] == (False, None, min(without))
    assert sum(b[:2] == (True, 5) for b in bounds) > 2 and sum(b[:2] == (False, None) for b in bounds) > 2

    def order(d):
        return d[0] is not None, d[0] or 0, ee._signed(ee.xxhash.xxh64_intdigest(d[1].encode(), 42))

    ordered = sorted(docs, key=order)
    expected = sorted(brute_pairs(list(zip(ordered, ordered[1:] + ordered[:1]))), key=repr)
    assert got_rows(spark, docs) == expected


def test_near_documents_share_a_class(spark):
    rng = random.Random(8)
    docs, expected = [], {}
    for family in range(12):
        base = prose(rng, rng.randrange(1500, 4000))
        for copy in range(4):
            text = list(base)
            for _ in range(copy):
                text[rng.randrange(len(text))] = "x"
            key = 100 * family + copy
            docs += [(key, "".join(text))] * (1 + (copy == 1))
            expected[key] = 100 * family
    docs += [(5000, None), (5001, ""), (None, ""), (6000, "short"), (6001, "short"), (6002, "quite another")]
    expected |= {5000: 5000, 5001: 5000, None: 5000, 6000: 6000, 6001: 6000, 6002: 6002}
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = ee.similar_documents(df).collect()
    assert len(got) == len(docs)
    assert {r["doc_id"]: r["class_id"] for r in got} == expected
    assert ee.similar_documents(df.limit(0)).count() == 0


def test_large_buckets_are_compared_block_by_block(spark, monkeypatch):
    rng = random.Random(9)
    base = prose(rng, 2000)
    docs = [(i, base[: 20 * i] + "#" + base[20 * i + 1 :]) for i in range(1, 41)]
    monkeypatch.setattr(ee, "BLOCK", 4)
    got = ee.similar_documents(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r["class_id"] for r in got} == {1}


@pytest.mark.parametrize("text,size", [("134217728b", 1 << 27), ("16m", 1 << 24), ("64MB", 1 << 26), ("1g", 1 << 30), ("512", 512)])
def test_size_of_a_split(spark, text, size):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", text)
    try:
        assert ee._split_bytes(spark) == size
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)

import hashlib
import random
import re
from zlib import crc32

import numpy as np
import pytest

from civiclake.llm import periodic
from civiclake.llm.queries import QUERIES


def brute_runs(words, min_words):
    """All runs (start, length, period) by comparing words q apart, for every q."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(min_words, 2 * q):
                best.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def brute_row(key, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), crc32(str(key).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    found = brute_runs(words, 12)
    dropped = {i for s, m, q in found for i in range(s + q, s + m)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    longest = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (
        key,
        n,
        len(found),
        *(longest or (None, None, None)),
        1000 * longest[1] // longest[2] if longest else None,
        sha("".join(f"{s},{m},{q}\n" for s, m, q in found)),
        sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def periodic_text(rng):
    words = []
    for _ in range(rng.randrange(1, 6)):
        words += [str(rng.randrange(50)) for _ in range(rng.randrange(20))]
        unit = [str(rng.randrange(rng.choice([2, 3, 30]))) for _ in range(rng.randrange(1, 25))]
        words += (unit * 8)[: rng.randrange(len(unit) * 8)]
    return words


@pytest.mark.parametrize("min_words", [2, 5, 11, 12, 13, 30])
def test_runs_are_those_of_comparing_all_distances(min_words):
    rng = random.Random(min_words)
    texts = [periodic_text(rng) for _ in range(60)]
    texts += [[str(rng.randrange(2)) for _ in range(rng.randrange(200))] for _ in range(60)]
    texts += [["a"] * n for n in (0, 1, 2, 11, 12, 13, 200)]
    texts += [(["a"] * m + ["b"]) * 7 for m in (1, 2, 3, 5, 10, 17)]
    fibonacci = ["a"], ["a", "b"]
    for _ in range(11):
        fibonacci = fibonacci[1], fibonacci[1] + fibonacci[0]
    texts.append(fibonacci[1])
    got = periodic.runs_of_texts(texts, min_words)
    for words, found in zip(texts, got):
        assert found == brute_runs(words, min_words), words


def test_order_statistics_of_ranges():
    rng = np.random.default_rng(4)
    values = rng.permutation(300)[:200].astype(np.int64)
    tree = periodic.WaveletMatrix(values, 9)
    left = rng.integers(0, 200, 500)
    right = np.minimum(left + rng.integers(1, 60, 500), 200)
    bound = rng.integers(0, 700, 500)
    assert tree.below(left, right, bound).tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(left, right, bound)]
    rank = rng.integers(0, right - left)
    assert tree.smallest(left, right, rank).tolist() == [sorted(values[a:b])[r] for a, b, r in zip(left, right, rank)]


def corpus():
    rng = random.Random(13)
    docs = [(i, " ".join(periodic_text(rng)), 1) for i in range(80)]
    docs += [(100, None, 1), (101, "", 1), (102, " \t\n ", 1), (103, "one", 1), (104, "é ß " * 30, 2), (104, "é ß " * 30, 2)]
    return docs


def test_query_columns_against_brute_force(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id bigint, text string, runs int").repartition(3)
    got = periodic.run_digests(periodic.find_runs(df, rewrite=periodic.planted)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted((brute_row(k, t) for k, t, _ in docs), key=repr)
    assert any(crc32(str(k).encode()) % 10 == 0 for k, _, _ in docs)


def test_rows_without_id_long_texts_and_empty_tables(spark):
    long = " ".join(str(i % 4001) for i in range(200_000))
    docs = [(None, "a b c " * 10), (None, None), (5, long), (6, "x " * 100_000)]
    got = {r["n_words"]: r for r in periodic.find_runs(spark.createDataFrame(docs, "id bigint, body string"), 12, "id", "body").collect()}
    assert [tuple(r) for r in got[30]["runs"]] == [(0, 30, 3)] and got[30]["collapsed_text"] == "a b c"
    assert [tuple(r) for r in got[200_000]["runs"]] == [(0, 200_000, 4001)]
    assert [tuple(r) for r in got[100_000]["runs"]] == [(0, 100_000, 1)] and got[100_000]["collapsed_text"] == "x"
    assert got[0]["runs"] == [] and got[0]["collapsed_text"] == ""
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert periodic.run_digests(periodic.find_runs(none)).count() == 0
    with pytest.raises(ValueError):
        periodic.find_runs(none, 1)


def test_registered_query_on_the_smallest_tables(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op13_periodic_runs"](spark, folder).collect()}
    assert got.keys() == texts.keys()
    short = [k for k, t in texts.items() if len(t.split()) < 600]
    assert short and all(tuple(got[k]) == brute_row(k, texts[k]) for k in short)

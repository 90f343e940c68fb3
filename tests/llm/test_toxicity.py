import math
import random
import zlib
from pathlib import Path

import pytest

from civiclake.llm import toxicity as T

FOLDER = "/root/testdata/sf0.1"


def brute_segments(scores):
    """The best-scoring stretch, and the same to its left and right."""
    best = max(((sum(scores[a:b]), -(b - a), -a, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=None)
    if best is None or best[0] <= 0:
        return []
    _, _, _, a, b = best
    left, right = brute_segments(scores[:a]), brute_segments(scores[b:])
    return [*left, (a, b, best[0]), *[(b + x, b + y, s) for x, y, s in right]]


def test_segments_against_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        scores = [rng.choice([-0.25, -0.25, rng.uniform(-3, 3)]) for _ in range(rng.randint(0, 14))]
        hits = [(n, s) for n, s in enumerate(scores) if s != -0.25]
        got = T.maximal_segments(hits, -0.25)
        expected = brute_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in expected]
        assert all(math.isclose(x[2], y[2], abs_tol=1e-9) for x, y in zip(got, expected))


def test_rate_solves_its_equation():
    import numpy as np

    values, shares = np.array([-0.05, 4.0]), np.array([0.999, 0.001])
    rate = T._rate(values, shares)
    assert math.isclose(float((shares * np.exp(rate * values)).sum()), 1, abs_tol=1e-6) and rate > 0


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the benchmark tables")
def test_held_out_accuracy(spark):
    documents, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    model = T.fit(documents, labels)
    rows = T.score(documents, model, with_spans=True).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.predicted == r.toxic for r in held) >= 0.97 * len(held)
    assert sum(r.predicted for r in held if r.toxic) >= 0.8 * sum(r.toxic for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.spans for r in rows if r.predicted)


def fixture(spark, rows=400):
    rng = random.Random(3)
    words = [f"w{n}" for n in range(300)]
    made = []
    for n in range(rows):
        text = rng.choices(words, k=60)
        if n % 5 == 0:
            text[20:22] = ["vile", "vileness"]
        made.append((n, " ".join(text)))
    labels = [(n, 0, int(n % 5 == 0)) for n, _ in made] + [(None, 1, 1), (5000, 1, 1), (3, 1, None), (0, 0, 1)]
    made += [(1000, None), (1001, ""), (1002, "vile " * 20000), (None, "vile vile vileness"), made[0], (1003, "!!")]
    df = spark.createDataFrame(made, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS word", "'x' AS token")
    return df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_odd_rows(spark):
    df, labels = fixture(spark)
    model = T.fit(df, labels)
    got = T.score(df, model).collect()
    assert len(got) == df.count()
    by = {r.doc_id: r for r in got}
    assert by[None].predicted == 1 and not by[None].held_out and by[1002].predicted == 1
    lowest = min(r.score for r in got)
    assert by[1000].score == by[1001].score == by[1003].score == lowest
    assert all(by[n].predicted == (n % 5 == 0) for n in range(400))
    kept = T.keep_clean(df, model)
    assert kept.columns == df.columns and kept.count() == sum(not r.predicted for r in got)


def test_without_labels_or_rows(spark):
    df, labels = fixture(spark, 20)
    for none in (labels.limit(0), labels.where("toxic = 0"), labels.where("doc_id = 5000")):
        model = T.fit(df, none)
        assert T.score(df, model).where("predicted = 1").isEmpty()
    assert T.score(df.limit(0), T.fit(df.limit(0), labels)).isEmpty()


def test_dense_passage_after_isolated_mentions(spark):
    bad = [f"bad{n}" for n in range(6)]
    model = T.Model(scores={w.encode(): 4.0 for w in bad}, rate=1.0, k=0.1, slope=4.0, offset=-6.0)
    apart = " ".join(word + " plain" * 200 for word in bad * 2)
    dense = " ".join(bad)
    made = [(0, apart), (1, f"{apart} {dense}"), (2, f"{apart} {dense} {'plain ' * 500}"), (3, dense)]
    made += [(4, "plain " * 3000 + "bad0 " * 20), (5, f"{dense} bad0 bad1 bad0 bad1")]
    df = spark.createDataFrame(made, "doc_id long, text string")
    got = {r.doc_id: r for r in T.score(df, model, with_spans=True).collect()}
    assert {n: r.predicted for n, r in got.items()} == {0: 0, 1: 1, 2: 1, 3: 1, 4: 0, 5: 1}
    at = 12 * 201
    spans = {n: [(s["first"], s["past"]) for s in r.spans] for n, r in got.items()}
    assert spans == {0: [], 1: [(at, at + 6)], 2: [(at, at + 6)], 3: [(0, 6)], 4: [], 5: [(0, 10)]}
    assert sorted(r.doc_id for r in T.keep_clean(df, model).collect()) == [0, 4]


def test_calibration_sees_whole_texts_and_each_id_once(spark):
    import numpy as np

    rng = random.Random(6)
    plain = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(5000)]
    text = lambda n, bad: " ".join(rng.choice(["vileword", "slurword"]) if rng.random() < bad else rng.choice(plain) for _ in range(n))
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 != 1]
    labels = [(i, int(n % 5 == 0)) for n, i in enumerate(ids)]
    docs = [(i, text(80, 0.5 if toxic else 0.0)) for i, toxic in labels]
    late = next(i for i, toxic in labels if not toxic)
    # a long clean text that names the words again and again, far from its beginning and each other
    long = " ".join(["alpha bravo charlie " * 3000] + ["vileword " + "delta echo " * 60] * 400)
    docs = [(i, long if i == late else t) for i, t in docs] + [docs[3]] * 50 + [(docs[4][0], docs[4][1] + " more words")]
    model = T.fit(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(labels, "doc_id long, toxic int"))
    once = {}
    for key, body in docs:
        words = T.alnum_words(body)
        once[key] = min(once.get(key, (1 << 60, None)), (len(words), words), key=lambda w: w[0])
    clean = [once[i][1] for i, toxic in labels if not toxic]
    hits = [round(s, 3) for words in clean for _, s in model.counted_hits(words)]
    assert len(hits) >= 400
    total = sum(map(len, clean))
    values = np.array([T.OTHER_TOKEN, *hits, max(model.scores.values())])
    shares = np.array([total - len(hits), *[1.0] * len(hits), 0.5])
    assert math.isclose(model.rate, T._rate(values, shares / shares.sum()), rel_tol=1e-6)
    best = lambda words: max((s for _, _, s in model.segments(words)), default=0.0)
    exposure = sum(len(words) * math.exp(-model.rate * best(words)) for words in clean)
    assert math.isclose(model.k, len(clean) / exposure, rel_tol=1e-9)

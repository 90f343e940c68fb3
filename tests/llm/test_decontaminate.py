import hashlib
import random
import re

import numpy as np
import pytest

from civiclake.llm import decontaminate as D

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def brute(text, items, size=10):
    words, hit, names = words_of(text), set(), set()
    for item, phrase_text in items:
        own = words_of(phrase_text)
        for at in range(max(1, len(own) - size + 1) if own else 0):
            phrase = own[at : at + size]
            for i in range(len(words) - len(phrase) + 1):
                if words[i : i + len(phrase)] == phrase:
                    hit.update(range(i, i + len(phrase)))
                    names.add(item)
    names = sorted(str(n) for n in names if n is not None)
    return len(words), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)


def cases():
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(30)] + ["é", "ÉA", "x1"]
    items = [(n, " ".join(rng.choices(vocabulary, k=rng.randint(3, 30)))) for n in range(12)]
    items += [(99, "Short One"), (100, ""), (101, None), (12, items[0][1]), (0, items[0][1]), (None, "no id item here")]
    documents = []
    for n in range(150):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))]
        if n % 3 == 0:
            own = (rng.choice(items)[1] or "").split()
            at = rng.randint(0, max(0, len(own) - 10))
            parts.append("; ".join(own[at : at + rng.randint(8, 14)]).upper())
        parts.append(" ".join(rng.choices(vocabulary + ["other"], k=rng.randint(0, 20))))
        documents.append((n, " - ".join(parts)))
    documents += [(200, None), (201, ""), (202, "short one " * 500), (None, items[3][1]), (3, documents[3][1])]
    return documents, items


@pytest.mark.parametrize("block_bytes", [1 << 24, 1 << 14])
def test_against_brute_force(spark, monkeypatch, tmp_path, block_bytes):
    documents, items = cases()
    monkeypatch.setattr(D, "BLOCK_BYTES", block_bytes)
    df = spark.createDataFrame(documents, "doc_id long, text string").selectExpr("*", "1 AS spans", "2 AS items", "3 AS id")
    benchmark = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    if block_bytes < 1 << 20:
        monkeypatch.setattr(D, "table_bytes", lambda *_: 3 * block_bytes)
    got = D.find_contamination(df, benchmark).collect()
    expected = sorted([(key, *brute(text, items)) for key, text in documents], key=repr)
    assert sorted([tuple(r)[:6] for r in got], key=repr) == expected
    for row in got:
        assert sum(s["past"] - s["first"] for s in row.spans) == row.n_hit


def test_empty_tables(spark):
    documents, items = cases()
    none = spark.createDataFrame([], "item_id long, text string")
    df = spark.createDataFrame(documents, "doc_id long, text string")
    assert D.find_contamination(df, none).where("contaminated").isEmpty()
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert D.find_contamination(empty, spark.createDataFrame(items, "item_id long, text string")).isEmpty()


def test_index_by_hand():
    rng = np.random.default_rng(0)
    values = rng.integers(1, 4, 500)
    index = D.FMIndex(values, 5)
    phrases = [values[i : i + k].tolist() for i in range(0, 400, 37) for k in (1, 3, 6)] + [[4], [3, 3, 3, 3, 3, 3, 3, 3, 3, 1]]
    lines = np.array([[-1] * (10 - len(p)) + p for p in phrases])
    for phrase, low, high in zip(phrases, *index.search(lines)):
        places = [i for i in range(500) if values[i : i + len(phrase)].tolist() == phrase]
        assert sorted(index.locate(np.arange(low, high)).tolist()) == places


def test_cut_in_blocks_like_in_one(spark, monkeypatch):
    items, documents = [], []
    for n in range(8):
        w = [f"d{n}w{k}" for k in range(1, 23)]
        items += [(3 * n, " ".join(w[:15])), (3 * n + 1, " ".join(w[5:]))]
        seam = [f"s{n}x{k}" for k in range(10)]
        items.append((3 * n + 2, " ".join(seam)))
        documents.append((1000 + n, f"before {' '.join(w)} after"))
        documents.append((2000 + n, " ".join([*seam[:5], *w[:15], *seam[5:]])))
    more_documents, more_items = cases()
    df = spark.createDataFrame(documents + more_documents, "doc_id long, text string").selectExpr("*", "1 AS __spans")
    benchmark = spark.createDataFrame(items + [(1000, text) for _, text in more_items], "item_id long, text string")
    one = sorted(D.cut_contamination(df, benchmark).collect(), key=repr)
    found = sorted(D.find_contamination(df, benchmark).collect(), key=repr)
    sizes, phrases_of = [], D.Phrases.of
    monkeypatch.setattr(D, "table_bytes", lambda *_: 2 * D.BLOCK_BYTES)
    monkeypatch.setattr(D.Phrases, "of", lambda block, words: sizes.append(len(block)) or phrases_of(block, words))
    three = D.cut_contamination(df, benchmark)
    assert len(sizes) == 3 and all(sizes)
    assert three.columns == df.columns and sorted(three.collect(), key=repr) == one
    assert sorted(D.find_contamination(df, benchmark).collect(), key=repr) == found
    text = {r.doc_id: r.text for r in one}
    assert all(text[1000 + n] == "before  after" for n in range(8))
    assert all(words_of(text[2000 + n]) == [f"s{n}x{k}".encode() for k in range(10)] for n in range(8))

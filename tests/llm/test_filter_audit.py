import random
import re
from itertools import permutations

import numpy as np
import pytest

from civiclake.llm import filter_audit

SCHEMA = "doc_id bigint, text string, lang string, mask int, digest string"
LABELS = "doc_id bigint, quality int, toxic int"


def brute(docs, labels):
    """(part, order, step) -> counts, by applying the filters to the documents one after another."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    rows = []
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = set()
        if len(words) < 100:
            fails.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text):
            fails.add("C")
        if re.search(r"[#$%&*|]", text):
            fails.add("D")
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs):
            fails.add("E")
        rows.append((i, lang or "", fails))
    out = {}
    for part in {p for _, p, _ in rows}:
        own = [(i, f) for i, p, f in rows if p == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [r for r in left if letter in r[1]]
                left = [r for r in left if letter not in r[1]]
                total[letter] += len(gone)
                failing = [r for r in own if letter in r[1]]
                out[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    len(failing) - len(gone),
                    sum(r[1] == {letter} for r in own),
                    sum(r[0] in good for r in gone),
                    sum(r[0] in toxic for r in gone),
                ]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(total[order[step - 1]])
    return out


def result(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = {}
    for r in df.collect():
        key = (r["part"], r["filter_order"], r["step"])
        assert key not in got
        got[key] = [r[n] for n in names]
    return got


def corpus():
    rng = random.Random(11)
    texts = [
        None,
        "",
        " \t\n",
        "x " * 150,
        " ".join(f"w{i}" for i in range(120)),
        " ".join(f"w{i}" for i in range(99)),
        " ".join(f"W{i}X" for i in range(100)),
        " ".join(f"w{i}" for i in range(100)) + " #",
        "A é B c | ",
        " ".join(f"w{i % 80}" for i in range(100)),
        " ".join(f"w{i % 79}" for i in range(100)),
        "é" * 9 + "A",
        "é" * 8 + "A",
    ]
    docs = [(rng.randrange(60), rng.choice(texts), rng.choice(["en", "de", "", None])) for _ in range(150)]
    docs += [(None, t, "en") for t in texts[:5]] * 2 + [docs[0]] * 3
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 70, 2)] * 2 + [(None, 1, 1)]
    labels += [(4, 1, 0), (4, 0, 1)]
    return docs, labels


def test_against_filters_applied_one_after_another(spark):
    docs, labels = corpus()
    wide = spark.createDataFrame([(*d, 7, "clash") for d in docs], SCHEMA)
    got = result(filter_audit.filter_interactions(wide, spark.createDataFrame(labels, LABELS)))
    assert got == brute(docs, labels)
    assert len(got) == 3 * 600


def test_states_of_the_walk_are_the_documents_that_pass():
    rng = np.random.default_rng(3)
    for k in range(1, 7):
        cells = rng.integers(0, 50, (1 << k, 3))
        states = filter_audit.survivors(cells)
        for subset in range(1 << k):
            passing = [m for m in range(1 << k) if not m & subset]
            assert states[subset].tolist() == cells[passing].sum(axis=0).tolist()


def test_shares_of_a_filter_add_up_to_all_that_is_removed():
    cells = np.random.default_rng(5).integers(0, 9, (8, 3))
    rows = filter_audit.steps(filter_audit.survivors(cells), "xyz")
    assert len(rows) == 18
    shares = {r[0][r[1] - 1]: r[8] for r in rows}
    assert sum(shares.values()) == 6 * int(cells[1:, 0].sum())


def test_copies_are_counted_across_parts_and_in_any_number(spark):
    docs = [(i, "same text", "en" if i % 2 else "de") for i in range(500)] + [(0, "same text", "de")]
    got = result(filter_audit.filter_interactions(spark.createDataFrame([(*d, 0, "") for d in docs], SCHEMA), spark.createDataFrame([], LABELS)))
    assert got["en", "EABCD", 1][1] == 250
    assert got["de", "EABCD", 1][1] == 249  # both rows of id 0 are the first
    assert got["de", "EABCD", 2][1] == 2


def test_empty_table_and_filters_of_ones_own(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert filter_audit.filter_interactions(none, spark.createDataFrame([], LABELS)).count() == 0
    cells = spark.createDataFrame([("p", 1, 5, 2, 0), ("p", 3, 4, 0, 1), ("p", 3, 1, 0, 0), ("p", 0, 6, 1, 1)], "part string, mask int, n long, good long, toxic long")
    got = result(filter_audit.audit(cells, ["s", "t"]))
    assert got["p", "ts", 1] == [11, 5, 0, 0, 0, 1, 5]
    assert got["p", "ts", 2] == [6, 5, 5, 5, 2, 0, 15]
    with pytest.raises(ValueError):
        filter_audit.audit(cells, "aa")

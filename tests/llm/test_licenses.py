import itertools
import random
import re

from civiclake.llm import licenses as L
from civiclake.llm.common import alnum_words


def places(text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    found = [
        (at, label)
        for phrase, label in L.BASE_PHRASES.items()
        for at in range(len(words))
        if words[at : at + len(phrase.split())] == phrase.encode().split()
    ]
    return len(words), sorted(found)


def texts():
    rng = random.Random(6)
    vocabulary = sorted({w for p in L.BASE_PHRASES for w in p.split()}) + ["the", "software", "free", "é"]
    made = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 40))) for _ in range(200)]
    return made + [None, "", "MIT-License, Apache_License!", "mit" * 50, "general public license " * 4000, L.TEMPLATES[0][1].upper()]


def test_base_places_against_brute_force(spark):
    rows = list(enumerate(texts())) + [(None, "mit license"), (0, texts()[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS score", "'x' AS labels")
    got = L.scan_licenses(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for key, text in rows:
        n, found = places(text)
        own = by[key]
        starts = [at for at, _ in found]
        assert (own.n_words, own.n_base) == (n, len(found))
        assert (own.first_word, own.last_word) == (min(starts, default=None), max(starts, default=None))
        assert own.base_labels == ",".join(sorted({label for _, label in found}))
        assert set(own.base_labels.split(",")) - {""} <= set(own.labels.split(","))
        assert 0 <= own.score <= 1 and (own.score == 1 or not found)
    assert L.scan_licenses(df.limit(0)).isEmpty()


def test_labels_of_whole_edited_and_unlike_templates(spark):
    mit = L.TEMPLATES[0][1]
    words = mit.split()
    edited = " ".join(words[:20] + ["CHANGED"] + words[21:])
    rows = [(0, mit), (1, "intro. " + edited), (2, " ".join(words[:12])), (3, "Licensed under CC BY-NC 4.0."), (4, " ".join(reversed(words)))]
    got = {r.doc_id: r for r in L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[n].labels for n in range(5)] == ["mit", "mit", "", "cc-by-nc", ""]
    assert got[0].score == 1 and 0.9 < got[1].score < 1 and 0 < got[2].score < 0.3 and got[4].score < 0.2
    assert [(s.first, s.past) for s in got[0].spans] == [(0, len(words))]


def test_matching_statistics_against_brute_force():
    rng = random.Random(4)
    templates = [("t", " ".join(rng.choices("abcd", k=30))) for _ in range(3)]
    automaton = L.LicenceAutomaton(templates, {"a b": "x", "c": "y"})
    sources = [text.split() for _, text in templates] + [["a", "b"], ["c"]]
    known = {tuple(s[a:b]) for s in sources for a, b in itertools.combinations(range(len(s) + 1), 2)}
    for _ in range(60):
        words = rng.choices("abcde", k=25)
        base, found = automaton.scan([w.encode() for w in words], 2)
        assert sorted(base) == sorted([(n, "x") for n in range(24) if words[n : n + 2] == ["a", "b"]] + [(n, "y") for n in range(25) if words[n] == "c"])
        longest = {}
        for past in range(1, 26):
            longest[past] = max((past - a for a in range(past) if tuple(words[a:past]) in known), default=0)
        ends = {past for past, n in longest.items() if n >= 2 and longest.get(past + 1, 0) != n + 1}
        assert {(a, b) for a, b, _ in found} == {(past - longest[past], past) for past in ends}


def test_best_chain_against_all_chains():
    rng = random.Random(8)
    for _ in range(200):
        matches = []
        for _ in range(rng.randint(1, 7)):
            a, t, n = rng.randint(0, 20), rng.randint(0, 20), rng.randint(1, 6)
            matches.append((a, a + n, t, t + n))
        best = 0
        for size in range(1, len(matches) + 1):
            for chain in itertools.permutations(matches, size):
                if all(p[1] <= q[0] and p[3] <= q[2] for p, q in zip(chain, chain[1:])):
                    best = max(best, sum(m[3] - m[2] for m in chain))
        assert L.best_chain(matches) == best
    assert alnum_words("Ab-c É1") == [b"ab", b"c", "É1".encode()]

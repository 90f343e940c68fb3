import hashlib
import random
import re

import numpy as np
import pytest

from civiclake.llm import automaton_dedup, passages, suffix_dedup


def brute_covered(units, size=50):
    """units: [(id, sequence)] -> list of covered flags."""
    first = {}
    for key, own in units:
        if key is not None:
            for i in range(len(own) - size + 1):
                window = tuple(own[i : i + size]) if not isinstance(own, bytes) else own[i : i + size]
                first[window] = min(key, first.get(window, key))
    out = []
    for key, own in units:
        covered = [False] * len(own)
        for i in range(len(own) - size + 1 if key is not None else 0):
            window = tuple(own[i : i + size]) if not isinstance(own, bytes) else own[i : i + size]
            if first[window] < key:
                covered[i : i + size] = [True] * size
        out.append(covered)
    return out


def brute_bytes(rows):
    units = [(key, (text or "").encode()) for key, text in rows]
    out = []
    for (key, own), covered in zip(units, brute_covered(units)):
        spans = sum(c and (i == 0 or not covered[i - 1]) for i, c in enumerate(covered))
        kept = bytes(b for b, c in zip(own, covered) if not c)
        out.append((key, len(own), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def brute_words(rows):
    units = [(key, re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())) for key, text in rows]
    out = []
    for (key, own), covered in zip(units, brute_covered(units)):
        kept = b" ".join(w for w, c in zip(own, covered) if not c)
        out.append((key, len(own), sum(covered), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def fixture(seed=1):
    rng = random.Random(seed)
    words = [rng.choice(["", "é", "Ü", "漢"]) + "".join(rng.choices("abcdefgh", k=rng.randint(1, 7))) for _ in range(300)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    line, passage = text(12), text(70)
    rows = []
    for n in range(120):
        parts = [text(rng.randint(0, 90))]
        if n % 3 == 0:
            parts.insert(rng.randint(0, 1), passage if n % 2 else " ".join(passage.split()[rng.randint(0, 30) :]))
        if n % 2:
            parts.append(line)
        if n % 5 == 1 and rows:
            own = rng.choice(rows)[1].split()
            if own:
                own[rng.randrange(len(own))] = "edited"
            parts = [" ".join(own)]
        if n % 7 == 2 and rows:
            parts = [rng.choice(rows)[1]]
        rows.append((n * 3, rng.choice([" ", "\n", "  \t"]).join(parts)))
    rows += [(1000, "a" * 400), (1001, "b" + "a" * 150 + "c"), (1002, "ab " * 100), (1003, "ab " * 60 + "x"), (1004, "x y " * 200)]
    rows += [(2000, None), (2001, ""), (2002, " "), (2003, passage[:49]), (None, passage), (9, rows[3][1]), (9, rows[3][1]), (9, text(40))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk, hot", [(4 << 20, 256), (3000, 256), (3000, 2), (3000, 0)])
def test_bytes_and_words_against_brute_force(spark, monkeypatch, chunk, hot):
    monkeypatch.setattr(passages, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(passages, "HOT_MARKS", hot)
    monkeypatch.setattr(passages, "BUCKET_BYTES", 5000)
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS chunk", "'x' AS payload", "2 AS n_bytes")
    assert sorted(map(tuple, suffix_dedup.remove_repeats(df).collect()), key=repr) == brute_bytes(rows)
    assert sorted(map(tuple, automaton_dedup.remove_repeats(df).collect()), key=repr) == brute_words(rows)


def test_windows_around_a_common_phrase_stay(spark, monkeypatch):
    monkeypatch.setattr(passages, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(passages, "HOT_MARKS", 2)
    monkeypatch.setattr(passages, "BUCKET_BYTES", 5000)
    rng = random.Random(8)
    text = lambda n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    phrase = text(45)
    rows = [(n, f"{text(30)} {phrase} {text(30)}") for n in range(40)]
    rows += [(100, f"{text(30)} {phrase} {rows[7][1].split(phrase)[1]}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    counts, sent_passages = [], passages._sent_passages

    def counted(*given):
        sent = sent_passages(*given)
        counts.append(sum(len(passages._unpack(bytes(r.passages))[1]) for r in sent.collect()))
        return sent

    monkeypatch.setattr(passages, "_sent_passages", counted)
    assert sorted(map(tuple, automaton_dedup.remove_repeats(df).collect()), key=repr) == brute_words(rows)
    assert counts[0] <= 2 * (45 + 30)  # the windows of documents 7 and 100; no window of the other 39
    assert sorted(map(tuple, suffix_dedup.remove_repeats(df).collect()), key=repr) == brute_bytes(rows)


def test_copies_in_many_chunks_are_no_crowded_key(spark, monkeypatch):
    monkeypatch.setattr(passages, "CHUNK_BYTES", 500)
    monkeypatch.setattr(passages, "HOT_MARKS", 2)
    rng = random.Random(9)
    copy = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(80))
    df = spark.createDataFrame([(n, copy) for n in range(60)], "doc_id long, text string")
    asked, sent_keys = [], passages._sent_keys

    def counted(chunks, *given):
        asked.append("replies" in chunks.columns)
        return sent_keys(chunks, *given)

    monkeypatch.setattr(passages, "_sent_keys", counted)
    assert [r.n_removed for r in automaton_dedup.remove_repeats(df).orderBy("doc_id").collect()] == [0] + [80] * 59
    assert asked == [False]  # no windows were asked for


def test_payloads_are_not_shuffled(spark):
    df = spark.createDataFrame([(n, "some text " * 30) for n in range(5)], "doc_id long, text string")
    plan = suffix_dedup.remove_repeats(df)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "payload" in line and "FileScan" in line)
    assert "Bucketed: true" in scan
    assert not any("payload" in line and ("Exchange" in line or "Sort " in line) for line in plan.splitlines())


def test_kept_text_and_carried_columns(spark):
    shared = "ä" * 40 + "shared tail of some length"
    df = spark.createDataFrame([(1, "x" + shared, "a"), (2, "é" + shared + "ü", "b")], "doc_id long, text string, lang string")
    got = suffix_dedup.remove_repeats(df, carried=["doc_id", "lang"], with_text=True).orderBy("doc_id").collect()
    assert [(r.doc_id, r.lang, r.kept_text) for r in got] == [(1, "a", "x" + shared), (2, "b", "éü")]


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(df).isEmpty() and automaton_dedup.remove_repeats(df).isEmpty()


def split(flags, made):
    return np.split(flags, np.cumsum([len(m) - 49 for m in made])[:-1])


def test_suffixes_sorted_in_blocks(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_SUFFIXES", 64)
    rng = random.Random(3)
    made = [bytes(rng.choices(b"ab", k=rng.randint(50, 120))) for _ in range(20)] + [b"a" * 130, b"a" * 55]
    made += [m[rng.randint(0, 20) :] + b"zz" for m in made[:10] if len(m) > 75] + [m[:60] for m in made if len(m) > 60]
    made = list(dict.fromkeys(m for m in made if len(m) >= 50))
    ids = np.array([rng.randrange(15) for _ in made])
    for kernel, kind in ((suffix_dedup, "u1"), (automaton_dedup, "u1")):
        got = split(kernel.earlier_windows([np.frombuffer(m, kind) for m in made], ids, 50), made)
        for m, own, flags in zip(made, ids, got):
            for i, flag in enumerate(flags):
                assert flag == any(m[i : i + 50] in other and key < own for other, key in zip(made, ids))


def test_shards_of_the_reference(monkeypatch):
    monkeypatch.setattr(automaton_dedup, "SHARD_WORDS", 90)
    rng = random.Random(5)
    base = [rng.randrange(5) for _ in range(300)]
    made = [np.array(base[a : a + rng.randint(50, 90)], "<u8") for a in rng.sample(range(200), 30)]
    ids = np.arange(30)[::-1].copy()
    for m, own, flags in zip(made, ids, split(automaton_dedup.earlier_windows(made, ids, 50), made)):
        text = ",".join(map(str, m.tolist())) + ","
        for i, flag in enumerate(flags):
            window = ",".join(map(str, m[i : i + 50].tolist())) + ","
            assert flag == any(("," + window) in ("," + ",".join(map(str, o.tolist())) + ",") and k < own for o, k in zip(made, ids))
        assert text


def test_difference_cover():
    cover = suffix_dedup.COVER.tolist()
    period = suffix_dedup.PERIOD
    assert {(a - b) % period for a in cover for b in cover} == set(range(period)) and len(cover) <= 9


def test_ends_of_the_last_passage_rank_behind_all_others():
    rng = np.random.default_rng(5)
    for _ in range(300):
        tail = rng.integers(97, 100, rng.integers(20, 70)).astype(np.uint8)
        made = [np.r_[rng.integers(97, 100, rng.integers(30, 60)).astype(np.uint8), tail] for _ in range(6)]
        ids = rng.integers(0, 4, 6)
        got = suffix_dedup.earlier_windows(made, ids, 50)
        least = {}
        for own, key in zip(made, ids.tolist()):
            for i in range(len(own) - 49):
                window = own[i : i + 50].tobytes()
                least[window] = min(least.get(window, key), key)
        expected = [least[own[i : i + 50].tobytes()] < key for own, key in zip(made, ids.tolist()) for i in range(len(own) - 49)]
        assert got.tolist() == expected

import hashlib
import random
from pathlib import Path

import numpy as np
import pytest
from test_decontaminate import words_of
from test_repeats import brute_covered
from test_simhash import brute_components, brute_fingerprint

import corpus_pipeline
from civiclake.llm import decontaminate, toxicity
from civiclake.llm.queries import ORACLES, QUERIES, VOCABULARY

FOLDER = "/root/testdata/sf0.001"


def brute(documents, kept_ids, items):
    """[(doc_id, text)] after the stages that follow the model's."""
    rows = [(key, text) for key, text in documents if key in kept_ids]
    fingerprints = {key: brute_fingerprint(text) for key, text in rows}
    roots = brute_components(fingerprints)
    rows = [(key, text or "") for key, text in rows if roots[key] == key]
    units = [(key, text.encode()) for key, text in rows]
    rows = [
        (key, bytes(b for b, c in zip(own, covered) if not c).decode("utf-8", "ignore"))
        for (key, own), covered in zip(units, brute_covered(units))
    ]
    phrases = {}
    for item, text in items:
        own = words_of(text)
        for at in range(max(1, len(own) - 9) if own else 0):
            phrases.setdefault(len(own[at : at + 10]), set()).add(tuple(own[at : at + 10]))
    out = []
    for key, text in rows:
        words, hit = words_of(text), set()
        for size, known in phrases.items():
            for at in range(len(words) - size + 1):
                if tuple(words[at : at + size]) in known:
                    hit.update(range(at, at + size))
        spans = decontaminate.merged([(n, n + 1) for n in sorted(hit)])
        raw, kept, at, places = text.encode(), b"", 0, []
        for word in words:
            at = raw.lower().index(word, at)
            places.append((at, at + len(word)))
            at += len(word)
        at = 0
        for first, past in spans:
            kept += raw[at : places[first][0]]
            at = places[past - 1][1]
        out.append((key, (kept + raw[at:]).decode()))
    return out


def test_whole_run_against_brute_force(spark):
    tokenizers = pytest.importorskip("tokenizers")
    if not Path(FOLDER).exists():
        pytest.skip("needs the benchmark tables")
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = toxicity.fit(documents, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    clean = {r.doc_id for r in toxicity.score(documents, model).where("predicted = 0").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    expected = brute([tuple(r) for r in documents.select("doc_id", "text").collect()], clean, items)
    encoder = tokenizers.Tokenizer.from_file(VOCABULARY)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert got.keys() == {key for key, _ in expected}
    for key, text in expected:
        ids = encoder.encode(text, add_special_tokens=False).ids
        row = got[key]
        assert row.ids == ids and row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def write_tables(spark, folder, documents):
    frame = spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long, score int, fp int").selectExpr("*", "1 AS n_bytes", "'k' AS kept_text", "2 AS spans", "3 AS predicted")
    frame.write.parquet(f"{folder}/documents.parquet")
    labels = [(key, 1, int("awful" in (text or ""))) for key, text, *_ in documents if key is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, "one two three four five six seven eight nine ten eleven"), (2, None), (None, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


@pytest.mark.parametrize("rows", [0, 60])
def test_odd_rows_and_extra_columns(spark, tmp_path, rows):
    rng = random.Random(8)
    texts = [" ".join(rng.choices([f"w{n}" for n in range(400)], k=80)) for _ in range(rows)]
    documents = [(n, t + (" awful" * 3 if n % 6 == 0 else ""), "en", None, 5, 1, 2) for n, t in enumerate(texts)]
    if rows:
        leak = texts[1] + " One two; three four five six seven eight nine ten " + texts[2]
        documents += [(500, leak, None, "s", None, None, None), (501, None, None, None, None, 1, 1), (None, " ".join(f"v{n}" for n in range(70)), "en", "s", 1, 1, 1)]
        documents += [documents[3], (502, "", "en", "s", 0, 0, 0), (503, "long " * 30000, "en", "s", 1, 1, 1)]
    write_tables(spark, str(tmp_path), documents)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "fp", "n_bytes", "kept_text", "spans", "predicted"], name
        path = f"{tmp_path}/{name}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    got = {r.doc_id: r for r in docs.collect()}
    if rows:
        assert None in got and 503 in got and len(got) == docs.count()
        assert sum(key in got for key in (501, 502)) == 1  # both are blank: one group
        assert "seven" not in got[500].text
    else:
        assert not got
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == len(got)


def test_every_operator_is_registered():
    names = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert names == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)

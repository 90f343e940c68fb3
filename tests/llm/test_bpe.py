import hashlib
import random

import numpy as np
import pytest

from civiclake.llm import bpe
from civiclake.llm.queries import VOCABULARY

tokenizers = pytest.importorskip("tokenizers")

ODD = [
    "", " ", "\n\n \t", "a", "don't  stop\r\n", "x" * 5000, "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext",
    "é́ß漢字🙂‍👩", "\x00\x85\xa0　", "12 345,678.90", "A-Z_a-z 's 'RE", "ab" * 3000 + " " * 300 + "z",
]


@pytest.fixture(scope="module")
def own():
    with open(VOCABULARY, "rb") as file:
        return bpe.Codec(file.read())


def test_texts_against_the_library(own):
    theirs = tokenizers.Tokenizer.from_file(VOCABULARY)
    rng = random.Random(1)
    letters = "ab 's't\n\t éß漢字🙂12 .,!<|endoftext|>́\x00\x85the in and"
    texts = ODD + ["".join(rng.choices(letters, k=rng.randint(0, 80))) for _ in range(400)]
    for text, many in zip(texts, own.encode_many(texts)):
        ids = theirs.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(many, "<u4").tolist() == ids
        assert own.decode(many) == theirs.decode(ids, skip_special_tokens=False) == text
        assert own.encode(text) == many


def test_tree_and_rows_agree(own):
    rng = random.Random(2)
    pieces = ["".join(rng.choices("etaoin shrdlu", k=rng.randint(1, 60))).encode() for _ in range(500)]
    for width in (64, 128):
        ids, alive = own.merge_rows(pieces, width)
        for piece, row, here in zip(pieces, ids, alive):
            assert row[here].tolist() == own.merge(piece)


def test_leftmost_pair_of_the_smallest_rank():
    tree = bpe.PairTree([5, 3, 9, 3])
    assert tree.leftmost() == 1
    tree.set(1, 7)
    assert tree.leftmost() == 3
    for leaf in range(4):
        tree.set(leaf, 1 << 40)
    assert tree.leftmost() == -1


def test_documents(spark):
    theirs = tokenizers.Tokenizer.from_file(VOCABULARY)
    rows = [(n, text) for n, text in enumerate(ODD)] + [(0, ""), (None, "null id"), (99, None), (100, "word " * 60000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_tokens", "2 AS ids")
    got = bpe.encode_decode(df, VOCABULARY, with_ids=True).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for key, text in rows:
        ids = theirs.encode(text or "", add_special_tokens=False).ids
        assert by[key].ids == ids and by[key].n_tokens == len(ids)
        assert by[key].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert by[key].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.encode_decode(df.limit(0), VOCABULARY).isEmpty()

"""A training corpus from raw documents, stage by stage.

Each stage reads what its predecessor kept and returns the columns of ``documents``; the last one
returns the encoded documents. Null ids and repeated rows follow the operators' rules: rows of one
id share what is decided for the id, and rows without id are judged alone where that is possible.
Extra columns of ``documents`` are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.llm import bpe, decontaminate, simhash, suffix_dedup, toxicity
from civiclake.llm.common import table
from civiclake.llm.queries import VOCABULARY


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; it is fitted on these documents."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document of the smallest id."""
    return simhash.keep_first(docs, shingle_words=3, max_bits=3)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that an earlier document has."""
    names = docs.columns
    # carried under names of their own, which no result column has
    hidden = {c: f"__carried_{n}" for n, c in enumerate(names) if c != "text"}
    plain = docs.select("text", *[F.col(c).alias(h) for c, h in hidden.items()])
    kept = suffix_dedup.remove_repeats(plain, hidden["doc_id"], carried=list(hidden.values()), with_text=True)
    back = [F.col(h).alias(c) for c, h in hidden.items()]
    return _with_text(kept.select(F.col("kept_text").alias("text"), *back), names)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the spans that benchmark phrases cover."""
    return _with_text(decontaminate.cut_contamination(docs, table(spark, sf_dir, "benchmark")), docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids, token counts and digests of the texts that are left."""
    return bpe.encode_decode(docs, VOCABULARY, with_ids=True)


def _with_text(docs: DataFrame, names: list[str]) -> DataFrame:
    if "n_chars" in names:
        docs = docs.withColumn("n_chars", F.length("text").cast("bigint"))
    return docs.select(*names)


STAGES = [
    ("toxicity", without_toxic),
    ("simhash_dedup", without_near_copies),
    ("suffix_dedup", without_repeated_passages),
    ("decontamination", without_benchmark),
    ("bpe", encoded),
]

#: The first stage's model and the last stage's encoder are not SQL; a test holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents after all stages."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs

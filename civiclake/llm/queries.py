"""One query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from civiclake.llm import automaton_dedup, bpe, chat, decontaminate, edit_embedding, filter_audit, licenses, neighbours, oracles, periodic, simhash, suffix_dedup, toxicity, urls
from civiclake.llm.common import table

#: Where public vocabularies are kept; a parameter of the operator.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op5_decontamination": oracles.DECONTAMINATION,
    "op6_suffix_dedup": oracles.SUFFIX_DEDUP,
    "op8_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op9_url_filter": oracles.URL_FILTER,
    "op10_chat": oracles.CHAT,
    "op11_filter_audit": oracles.FILTER_AUDIT,
}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_decode(table(spark, folder, "documents"), VOCABULARY)


@query
def op4_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, folder, "documents")).drop("spans")


@query
def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), shingle_words=3, max_bits=3)


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, folder, "labels")))


@query
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = table(spark, folder, "benchmark")
    return decontaminate.find_contamination(table(spark, folder, "documents"), benchmark, 10).drop("spans")


@query
def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.filter_urls(table(spark, folder, "pages"))


@query
def op10_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_chats(table(spark, folder, "conversations"))


@query
def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, folder, "documents"))


@query
def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return automaton_dedup.remove_repeats(table(spark, folder, "documents"))


@query
def op7_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), k=20, query_divisor=20)


@query
def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.filter_interactions(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.find_runs(table(spark, folder, "documents"), min_words=12, rewrite=periodic.planted)
    return periodic.run_digests(found)


@query
def op12_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return edit_embedding.edited_fingerprints(table(spark, folder, "documents"))

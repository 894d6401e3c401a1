"""The registered queries of this package: one for each operator, on its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeship.llm import (
    bpe, compression, conversation_trie, crf_quality, line_dedup, mixing, pii, ranked_search, secrets, sharding, simhash,
    suffix_dedup, syncmers,
)
from lakeship.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def _on_documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(read_table(spark, sf_dir, "documents"))


def op7_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf_quality.op7_crf_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_monoid_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.op11_monoid_prefix_trie(read_table(spark, sf_dir, "conversations"))


def op13_shared_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return ranked_search.op13_shared_ranked_search(docs, items)


QUERIES: dict[str, Query] = {
    "op1_bootstrapped_pii": _on_documents(pii.op1_bootstrapped_pii),
    "op2_streaming_bpe": _on_documents(bpe.op2_streaming_bpe),
    "op3_closed_syncmers": _on_documents(syncmers.op3_closed_syncmers),
    "op4_prefix_sum_shards": _on_documents(sharding.op4_prefix_sum_shards),
    "op5_low_discrepancy_mix": _on_documents(mixing.op5_low_discrepancy_mix),
    "op6_simhash_pigeonring": _on_documents(simhash.op6_simhash_pigeonring),
    "op7_crf_quality": op7_crf_quality,
    "op8_compression_bands": _on_documents(compression.op8_compression_bands),
    "op9_prefix_doubling_dedup": _on_documents(suffix_dedup.op9_prefix_doubling_dedup),
    "op10_guess_cost_secrets": _on_documents(secrets.op10_guess_cost_secrets),
    "op11_monoid_prefix_trie": op11_monoid_prefix_trie,
    "op12_bloom_line_dedup": _on_documents(line_dedup.op12_bloom_line_dedup),
    "op13_shared_ranked_search": op13_shared_ranked_search,
}
SQL: dict[str, str] = {
    "op11_monoid_prefix_trie": conversation_trie.SQL,
    "op12_bloom_line_dedup": line_dedup.SQL,
    "op13_shared_ranked_search": ranked_search.SQL,
}

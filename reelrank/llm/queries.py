"""The numbered queries and the pipeline, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import convtrie, decontam, langid, lm, packing, quality, sharding, simhash, spelling, suffix, tokencount, topk, urlfilter
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def _documents(op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: op(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_simhash": _documents(simhash.op1_simhash),
    "op2_decontamination": lambda spark, sf_dir: decontam.op2_decontamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
    "op3_suffix_dedup": _documents(suffix.op3_suffix_dedup),
    "op4_lm_scoring": lambda spark, sf_dir: lm.op4_lm_scoring(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op5_quality": lambda spark, sf_dir: quality.op5_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op6_best_fit_packing": _documents(packing.op6_best_fit_packing),
    "op7_exact_topk": lambda spark, sf_dir: topk.op7_exact_topk(table(spark, sf_dir, "embeddings")),
    "op8_token_counts": _documents(tokencount.op8_token_counts),
    "op9_sharding": _documents(sharding.op9_sharding),
    "op10_language_id": _documents(langid.op10_language_id),
    "op11_url_filters": lambda spark, sf_dir: urlfilter.op11_url_filters(table(spark, sf_dir, "pages")),
    "op12_spelling_variants": _documents(spelling.op12_spelling_variants),
    "op13_conversation_trie": lambda spark, sf_dir: convtrie.op13_conversation_trie(table(spark, sf_dir, "conversations")),
}

ORACLES: dict[str, str] = {"op7_exact_topk": topk.OP7_SQL, "op11_url_filters": urlfilter.OP11_SQL,
                           "op12_spelling_variants": spelling.OP12_SQL, "op13_conversation_trie": convtrie.OP13_SQL}

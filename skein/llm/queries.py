"""The queries of this subpackage, by name, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skein.llm import bpe, chat_format, collocations, compression_classifier, html_extract, line_dedup, ngram_join, positional_index, quality_rules, sharding, token_rollup, url_filter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_extract": html_extract.query,
        "op2_compression_classifier": compression_classifier.query,
        "op3_sharding": sharding.query,
        "op4_quality_rules": quality_rules.query,
        "op5_bpe": bpe.query,
        "op6_chat_format": chat_format.query,
        "op7_url_filter": url_filter.query,
        "op8_token_rollup": token_rollup.query,
        "op9_positional_index": positional_index.query,
        "op10_ngram_join": ngram_join.query,
        "op11_collocations": collocations.query,
        "op12_line_dedup": line_dedup.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_chat_format": chat_format.SQL, "op8_token_rollup": token_rollup.SQL, "op11_collocations": collocations.SQL, "op12_line_dedup": line_dedup.SQL}

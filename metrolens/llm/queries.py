"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from metrolens.llm import byte_bpe, collocations, embedding_dedup, exact_dedup, jaccard_join, langid, mixing, packing, pii, prefix_trie, substring_dedup, token_output, warc
from metrolens.llm.common import table


def _over(name: str, query: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(table(spark, sf_dir, name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": _over("documents", mixing.query),
    "op2_exact_dedup": _over("documents", exact_dedup.query),
    "op3_ngram_jaccard_join": _over("documents", jaccard_join.query),
    "op4_pii": _over("documents", pii.query),
    "op5_embedding_dedup": _over("embeddings", embedding_dedup.query),
    "op6_best_fit_packing": _over("documents", packing.query),
    "op7_substring_dedup": _over("documents", substring_dedup.query),
    "op8_warc": _over("pages", warc.query),
    "op9_token_output": _over("documents", token_output.query),
    "op10_language_id": _over("documents", langid.query),
    "op11_byte_bpe": _over("documents", byte_bpe.query),
    "op12_prefix_trie": _over("conversations", prefix_trie.query),
    "op13_collocations": _over("documents", collocations.query),
}

ORACLE: dict[str, str] = {
    "op2_exact_dedup": exact_dedup.ORACLE,
    "op3_ngram_jaccard_join": jaccard_join.ORACLE,
    "op5_embedding_dedup": embedding_dedup.ORACLE,
    "op7_substring_dedup": substring_dedup.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
    "op13_collocations": collocations.ORACLE,
}

"""Registered queries of this package and their SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyfield.llm import (
    bpe,
    brown_lm,
    exact_dedup,
    html_extract,
    lattice_dedup,
    minhash_dedup,
    oracle,
    prefix_trie,
    quality_rules,
    secret_scan,
    source_divergence,
    source_mixing,
    toxicity,
    warc,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_minhash_dedup": minhash_dedup.op1_minhash_dedup,
        "op2_lattice_dedup": lattice_dedup.op2_lattice_dedup,
        "op3_mixing": source_mixing.op3_mixing,
        "op4_warc": warc.op4_warc,
        "op5_html_extract": html_extract.op5_html_extract,
        "op6_toxicity": toxicity.op6_toxicity,
        "op7_brown_lm": brown_lm.op7_brown_lm,
        "op8_secret_scan": secret_scan.op8_secret_scan,
        "op9_bpe": bpe.op9_bpe,
        "op10_quality_rules": quality_rules.op10_quality_rules,
        "op11_exact_dedup": exact_dedup.op11_exact_dedup,
        "op12_source_divergence": source_divergence.op12_source_divergence,
        "op13_prefix_trie": prefix_trie.op13_prefix_trie,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)

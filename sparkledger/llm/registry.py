"""The queries of this subpackage and their SQL, for ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    alignment,
    ann,
    byte_bpe,
    decontaminate,
    licenses,
    lm_score,
    mixing,
    near_dedup,
    pii,
    prefix_trie,
    substring_dedup,
    suffix_dedup,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_near_dedup": near_dedup.op1_near_dedup,
        "op2_mixing": mixing.op2_mixing,
        "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
        "op4_pii": pii.op4_pii,
        "op5_licences": licenses.op5_licences,
        "op6_ann": ann.op6_ann,
        "op7_lm_score": lm_score.op7_lm_score,
        "op8_substring_dedup": substring_dedup.op8_substring_dedup,
        "op9_decontaminate": decontaminate.op9_decontaminate,
        "op10_toxicity": toxicity.op10_toxicity,
        "op11_byte_bpe": byte_bpe.op11_byte_bpe,
        "op12_prefix_trie": prefix_trie.op12_prefix_trie,
        "op13_token_alignment": alignment.op13_token_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_near_dedup": near_dedup.SQL,
        "op2_mixing": mixing.SQL,
        "op8_substring_dedup": substring_dedup.SQL,
        "op9_decontaminate": decontaminate.SQL,
        "op12_prefix_trie": prefix_trie.SQL,
    }

"""The queries of this subpackage, by the names under which they are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm.bpe import op6_bpe
from ledgerline.llm.corpus_sql import OP11_SQL, OP12_SQL, OP13_SQL
from ledgerline.llm.decontamination import op13_decontamination
from ledgerline.llm.fill_in_middle import op12_fill_in_middle
from ledgerline.llm.fingerprints import op10_fingerprints
from ledgerline.llm.html_extraction import op1_html_extraction
from ledgerline.llm.manifest import op11_merkle_manifest
from ledgerline.llm.mixing import op7_mixing
from ledgerline.llm.near_duplicates import op8_minhash_near_dedup
from ledgerline.llm.pii import op4_pii
from ledgerline.llm.quality_classifier import op3_quality_classifier
from ledgerline.llm.quality_rules import op9_quality_rules
from ledgerline.llm.quality_sql import OP9_SQL
from ledgerline.llm.token_counts import op5_token_counts
from ledgerline.llm.url_filters import op2_url_filters
from ledgerline.llm.url_sql import OP2_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_url_filters": op2_url_filters,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_pii": op4_pii,
    "op5_token_counts": op5_token_counts,
    "op6_bpe": op6_bpe,
    "op7_mixing": op7_mixing,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_fingerprints": op10_fingerprints,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_decontamination": op13_decontamination,
}
ORACLE_SQL: dict[str, str] = {
    "op2_url_filters": OP2_SQL,
    "op9_quality_rules": OP9_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op12_fill_in_middle": OP12_SQL,
    "op13_decontamination": OP13_SQL,
}

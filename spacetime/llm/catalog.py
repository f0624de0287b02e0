"""Queries of this subpackage, by the names ``__spark_entry__`` registers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spacetime.llm import collocations, quality_rules, substring_dedup, suffix_dedup
from spacetime.llm.collocations import op12_collocations
from spacetime.llm.decontamination import op5_decontaminate
from spacetime.llm.html_extract import op6_html_extract
from spacetime.llm.language_id import op1_language_id
from spacetime.llm.mixing import op2_mix_sources
from spacetime.llm.quality_rules import op8_quality_rules
from spacetime.llm.secret_scan import op9_secret_scan
from spacetime.llm.simhash import op4_simhash_near_dedup
from spacetime.llm.spelling_variants import op13_spelling_variants
from spacetime.llm.substring_dedup import op3_substring_dedup
from spacetime.llm.suffix_dedup import op10_suffix_dedup
from spacetime.llm.suffix_tree import op11_suffix_tree_scores
from spacetime.llm.token_counts import op7_token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_mix_sources": op2_mix_sources,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_html_extract": op6_html_extract,
    "op7_token_counts": op7_token_counts,
    "op8_quality_rules": op8_quality_rules,
    "op9_secret_scan": op9_secret_scan,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_suffix_tree_scores": op11_suffix_tree_scores,
    "op12_collocations": op12_collocations,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE_SQL: dict[str, str] = {
    "op3_substring_dedup": substring_dedup.ORACLE_SQL,
    "op8_quality_rules": quality_rules.oracle_sql(),
    "op10_suffix_dedup": suffix_dedup.ORACLE_SQL,
    "op12_collocations": collocations.ORACLE_SQL,
}

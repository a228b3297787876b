"""Registered queries of this subpackage and the SQL that checks those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from viewrecon.llm.bpe import op3_bpe
from viewrecon.llm.byte_network import op7_quality_classifier
from viewrecon.llm.hamming import OP9_SQL, op9_topk_search
from viewrecon.llm.html_extract import op1_html_extraction
from viewrecon.llm.line_dedup import OP5_SQL, op5_line_dedup
from viewrecon.llm.mixing import TARGETS_SQL, mixing_targets, op2_mixing
from viewrecon.llm.near_dedup import op8_near_dedup
from viewrecon.llm.quality_rules import COUNTS_SQL, op10_quality_rules, quality_counts
from viewrecon.llm.sharding import op4_sharding, op4_sql
from viewrecon.llm.toxicity import op6_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_html_extraction, op2_mixing, op3_bpe, op4_sharding, op5_line_dedup, op6_toxicity, op7_quality_classifier, op8_near_dedup, op9_topk_search, op10_quality_rules)
}

#: Parts of two operators that SQL can express.
QUERIES |= {f.__name__: f for f in (mixing_targets, quality_counts)}

ORACLES: dict[str, str] = {"op4_sharding": op4_sql(), "op5_line_dedup": OP5_SQL, "op9_topk_search": OP9_SQL, "mixing_targets": TARGETS_SQL, "quality_counts": COUNTS_SQL}

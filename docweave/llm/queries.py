"""Registered queries of the subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from docweave.llm.chat import ORACLE_OP10, op10_chat_formatting
from docweave.llm.clustering import ORACLE_OP13, op13_centroid_clustering
from docweave.llm.decontaminate import op7_decontamination
from docweave.llm.hard_negatives import ORACLE_OP11, op11_hard_negatives
from docweave.llm.language_id import op9_language_id
from docweave.llm.licenses import op6_license_scan
from docweave.llm.near_dedup import op8_minhash_near_dedup
from docweave.llm.packing import op1_packing
from docweave.llm.paragraph_dedup import op3_lines_and_passages, op3_repeated_passages
from docweave.llm.quality import op2_quality_rules
from docweave.llm.sharding import op5_sharding
from docweave.llm.substring_dedup import op4_suffix_array_dedup
from docweave.llm.url_filter import ORACLE_OP12, op12_url_filters

QUERIES = {f.__name__: f for f in (
    op1_packing, op2_quality_rules, op3_repeated_passages, op4_suffix_array_dedup, op5_sharding, op6_license_scan,
    op7_decontamination, op8_minhash_near_dedup, op9_language_id, op10_chat_formatting, op11_hard_negatives,
    op12_url_filters, op13_centroid_clustering)} | {"op3_paragraph_dedup": op3_lines_and_passages}
ORACLES = {"op10_chat_formatting": ORACLE_OP10, "op11_hard_negatives": ORACLE_OP11, "op12_url_filters": ORACLE_OP12,
           "op13_centroid_clustering": ORACLE_OP13}

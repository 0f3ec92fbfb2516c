"""The registered queries of this folder and their SQL."""

from __future__ import annotations

import corpus_pipeline
from voltwatch.llm.byte_bpe import op3_byte_bpe
from voltwatch.llm.host_rules import op9_host_rules
from voltwatch.llm.license_scan import op6_license_scan
from voltwatch.llm.minmax_dedup import op2_minmax_dedup
from voltwatch.llm.packing import op5_packing
from voltwatch.llm.relative_lz import op4_relative_lz
from voltwatch.llm.secret_scan import op7_secret_scan
from voltwatch.llm.source_mixing import SQL as MIXING_SQL
from voltwatch.llm.source_mixing import op13_source_mixing
from voltwatch.llm.substring_index import op1_substring_index
from voltwatch.llm.target_resampling import op11_target_resampling
from voltwatch.llm.token_alignment import op12_token_alignment
from voltwatch.llm.topk_search import op8_topk_search
from voltwatch.llm.weak_labels import op10_quality_classifier

QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_index,
        op2_minmax_dedup,
        op3_byte_bpe,
        op4_relative_lz,
        op5_packing,
        op6_license_scan,
        op7_secret_scan,
        op8_topk_search,
        op9_host_rules,
        op10_quality_classifier,
        op11_target_resampling,
        op12_token_alignment,
        op13_source_mixing,
    )
}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLES: dict[str, str] = {"op13_source_mixing": MIXING_SQL}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

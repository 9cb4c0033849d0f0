"""The operators' queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from docmonitor.llm.chat_format import OP13_SQL, op13_chat_format
from docmonitor.llm.dac import op2_token_id_files
from docmonitor.llm.gam import op8_quality_classifier
from docmonitor.llm.line_dedup import OP5_SQL, op5_line_dedup
from docmonitor.llm.mixing import op1_mix_sources
from docmonitor.llm.multi_index import op9_multi_index_search
from docmonitor.llm.packing import op4_best_fit_packing
from docmonitor.llm.phrases import OP11_SQL, op11_phrase_mining
from docmonitor.llm.quality_rules import op3_quality_rules
from docmonitor.llm.scalar_clusters import OP12_SQL, op12_scalar_clusters
from docmonitor.llm.token_counts import op6_token_counts
from docmonitor.llm.token_groups import op7_token_group_join
from docmonitor.llm.warc import OP10_SQL, op10_warc

QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_token_id_files, op3_quality_rules, op4_best_fit_packing, op5_line_dedup,
    op6_token_counts, op7_token_group_join, op8_quality_classifier,
    op9_multi_index_search, op10_warc, op11_phrase_mining, op12_scalar_clusters,
    op13_chat_format,
)}

ORACLE: dict[str, str] = {
    "op5_line_dedup": OP5_SQL, "op10_warc": OP10_SQL, "op11_phrase_mining": OP11_SQL,
    "op12_scalar_clusters": OP12_SQL, "op13_chat_format": OP13_SQL,
}

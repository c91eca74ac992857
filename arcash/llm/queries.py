"""Registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from arcash.llm import conversations, line_dedup, spelling, warc
from arcash.llm.conversations import op13_conversations
from arcash.llm.decontamination import op6_decontamination
from arcash.llm.licences import op7_licences
from arcash.llm.line_dedup import op8_line_dedup
from arcash.llm.mixing import op12_mixing
from arcash.llm.near_dedup import op2_near_dedup
from arcash.llm.packing import op10_packing
from arcash.llm.quality import op1_quality
from arcash.llm.spelling import op11_spelling
from arcash.llm.token_count import op5_token_counts
from arcash.llm.toxicity import op3_toxicity
from arcash.llm.vector_search import op9_vector_search
from arcash.llm.warc import op4_warc

QUERIES = {
    "op1_quality": op1_quality,
    "op2_near_dedup": op2_near_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_warc": op4_warc,
    "op5_token_counts": op5_token_counts,
    "op6_decontamination": op6_decontamination,
    "op7_licences": op7_licences,
    "op8_line_dedup": op8_line_dedup,
    "op9_vector_search": op9_vector_search,
    "op10_packing": op10_packing,
    "op11_spelling": op11_spelling,
    "op12_mixing": op12_mixing,
    "op13_conversations": op13_conversations,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op4_warc": warc.oracle_sql(),
    "op8_line_dedup": line_dedup.oracle_sql(),
    "op11_spelling": spelling.oracle_sql(),
    "op13_conversations": conversations.oracle_sql(),
}

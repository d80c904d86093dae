"""The subpackage's registered queries and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from smartmaint.llm import conversation_repair, decontamination, licenses, line_dedup, merkle, topk
from smartmaint.llm.chat_format import op5_chat_formatting
from smartmaint.llm.conversation_repair import op11_conversation_repair
from smartmaint.llm.decontamination import op6_benchmark_decontamination
from smartmaint.llm.fingerprints import op13_fingerprints
from smartmaint.llm.licenses import op7_license_scan
from smartmaint.llm.line_dedup import op2_line_dedup
from smartmaint.llm.merkle import op12_merkle_manifest
from smartmaint.llm.packing import op1_packing
from smartmaint.llm.pii import op3_pii
from smartmaint.llm.shards import op10_token_shards
from smartmaint.llm.simhash import op8_simhash_near_dedup
from smartmaint.llm.topk import op4_exact_topk
from smartmaint.llm.toxicity import op9_toxicity

QUERIES = {
    "op1_packing": op1_packing,
    "op2_line_dedup": op2_line_dedup,
    "op3_pii": op3_pii,
    "op4_exact_topk": op4_exact_topk,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_license_scan": op7_license_scan,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_token_shards": op10_token_shards,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_fingerprints": op13_fingerprints,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": line_dedup.ORACLE,
    "op4_exact_topk": topk.ORACLE,
    "op6_benchmark_decontamination": decontamination.ORACLE,
    "op7_license_scan": licenses.ORACLE,
    "op11_conversation_repair": conversation_repair.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
}

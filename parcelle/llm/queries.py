"""The corpus queries, and the SQL that checks those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from parcelle.llm import chat, collocations, decontaminate, licences, main_text, maxent, near_dedup, packing, passages, pii, quality, ranked_search, secrets

QUERIES = {
    "op1_near_dedup": near_dedup.op1_near_dedup,
    "op2_main_text": main_text.op2_main_text,
    "op3_personal_data": pii.op3_personal_data,
    "op4_chat_repair": chat.op4_chat_repair,
    "op5_best_fit_packing": packing.op5_best_fit_packing,
    "op6_maxent_score": maxent.op6_maxent_score,
    "op7_licence_scan": licences.op7_licence_scan,
    "op8_secret_scan": secrets.op8_secret_scan,
    "op9_quality_rules": quality.op9_quality_rules,
    "op10_benchmark_decontamination": decontaminate.op10_benchmark_decontamination,
    "op11_ranked_search": ranked_search.op11_ranked_search,
    "op12_phrase_collocations": collocations.op12_phrase_collocations,
    "op13_repeated_passages": passages.op13_repeated_passages,
    "pipeline": corpus_pipeline.run,
}

CHECKS: dict[str, str] = {
    "op11_ranked_search": ranked_search.OP11_SQL,
    "op12_phrase_collocations": collocations.OP12_SQL,
    "op13_repeated_passages": passages.OP13_SQL,
}

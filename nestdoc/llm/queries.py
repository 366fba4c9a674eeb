"""Registered queries of this package, and the SQL that states the same where SQL can."""

from __future__ import annotations

from nestdoc.llm import chat, decontaminate, jaccard, langid, licences, mix, packing, pages, periods, quality, search, suffixes, toxicity

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_chat_format": chat.op2_chat_format,
    "op3_main_text": pages.op3_main_text,
    "op4_quality_rules": quality.op4_quality_rules,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_licence_scan": licences.op6_licence_scan,
    "op7_jaccard_join": jaccard.op7_jaccard_join,
    "op8_mix_sources": mix.op8_mix_sources,
    "op9_repeated_passages": suffixes.op9_repeated_passages,
    "op10_language_id": langid.op10_language_id,
    "op11_periodic_runs": periods.op11_periodic_runs,
    "op12_ranked_search": search.op12_ranked_search,
    "op13_packing": packing.op13_packing,
}

SQL = {
    "op2_chat_format": chat.ORACLE,
    "op5_decontaminate": decontaminate.ORACLE,
    "op7_jaccard_join": jaccard.ORACLE,
    "op9_repeated_passages": suffixes.ORACLE,
    "op12_ranked_search": search.ORACLE,
}

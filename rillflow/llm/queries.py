"""The training-data queries by name, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from rillflow.llm import chat, collocation, language, mixing, packing, quality, simhash, substring, tokencount, topk, toxicity, urls, whitening

QUERIES = {
    "op1_quality_rules": quality.op1_quality_rules,
    "op2_topk": topk.op2_topk,
    "op3_chat": chat.op3_chat,
    "op4_simhash": simhash.op4_simhash,
    "op5_substring_dedup": substring.op5_substring_dedup,
    "op6_packing": packing.op6_packing,
    "op7_language": language.op7_language,
    "op8_url_filters": urls.op8_url_filters,
    "op9_mixing": mixing.op9_mixing,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_token_counts": tokencount.op11_token_counts,
    "op12_collocations": collocation.op12_collocations,
    "op13_whitening": whitening.op13_whitening,
}

ORACLE = {"op2_topk": topk.OP2_SQL, "op3_chat": chat.OP3_SQL, "op9_mixing": mixing.OP9_SQL,
          "op12_collocations": collocation.OP12_SQL}

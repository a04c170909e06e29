"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from starlot.llm import chat, decontam, idfiles, licences, near, packing, passages, quality, repair, secrets, toxicity, trie, warc

QUERIES = {
    "op1_secret_spans": secrets.op1_secret_spans,
    "op2_mixture_packing": packing.op2_mixture_packing,
    "op3_benchmark_leaks": decontam.op3_benchmark_leaks,
    "op4_context_mixing_ids": idfiles.op4_context_mixing_ids,
    "op5_line_quality": quality.op5_line_quality,
    "op6_chat_turns": chat.op6_chat_turns,
    "op7_warc_bundles": warc.op7_warc_bundles,
    "op8_toxicity_scores": toxicity.op8_toxicity_scores,
    "op9_near_duplicates": near.op9_near_duplicates,
    "op10_licence_notices": licences.op10_licence_notices,
    "op11_structure_repair": repair.op11_structure_repair,
    "op12_prefix_trie": trie.op12_prefix_trie,
    "op13_repeated_passages": passages.op13_repeated_passages,
}

ORACLE = {
    "op6_chat_turns": chat.SQL,
    "op5_line_quality": quality.SQL,
    "op7_warc_bundles": warc.SQL,
    "op10_licence_notices": licences.SQL,
    "op11_structure_repair": repair.SQL,
    "op12_prefix_trie": trie.SQL,
    "op13_repeated_passages": passages.SQL,
}

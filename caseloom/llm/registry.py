"""The queries of this package by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from caseloom.llm import chat, decontaminate, embedding_links, licenses, line_dedup, mixing, near_duplicates, periodic_runs, prefix_trie, quality, token_counts, token_files, warc

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_warc": warc.op3_warc,
    "op4_embedding_links": embedding_links.op4_embedding_links,
    "op5_mixing": mixing.op5_mixing,
    "op6_chat_preferences": chat.op6_chat_preferences,
    "op7_near_duplicates": near_duplicates.op7_near_duplicates,
    "op8_token_output": token_files.op8_token_output,
    "op9_licenses": licenses.op9_licenses,
    "op10_quality": quality.op10_quality,
    "op11_token_counts": token_counts.op11_token_counts,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}
ORACLE_SQL: dict[str, str] = {
    "op3_warc": warc.OP3_SQL,
    "op4_embedding_links": embedding_links.OP4_SQL,
    "op5_mixing": mixing.OP5_SQL,
    "op6_chat_preferences": chat.OP6_SQL,
    "op9_licenses": licenses.OP9_SQL,
    "op13_prefix_trie": prefix_trie.OP13_SQL,
}

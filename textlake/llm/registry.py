"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from . import chat_format, conversation_repair, decontaminate, language_id, mixing, ngram_join, periodic_runs, quality_rules, sentence_pieces, token_counts, toxicity, url_filter, warc

QUERIES = {
    "op1_mix_sources": mixing.query,
    "op2_language_id": language_id.query,
    "op3_toxicity": toxicity.query,
    "op4_url_filter": url_filter.query,
    "op5_decontaminate": decontaminate.query,
    "op6_chat_format": chat_format.query,
    "op7_ngram_join": ngram_join.query,
    "op8_warc": warc.query,
    "op9_token_counts": token_counts.query,
    "op10_quality_rules": quality_rules.query,
    "op11_conversation_repair": conversation_repair.query,
    "op12_sentence_pieces": sentence_pieces.query,
    "op13_periodic_runs": periodic_runs.query,
}
SQL = {
    "op1_mix_sources": mixing.SQL,
    "op4_url_filter": url_filter.SQL,
    "op6_chat_format": chat_format.SQL,
    "op7_ngram_join": ngram_join.SQL,
    "op8_warc": warc.SQL,
    "op10_quality_rules": quality_rules.SQL,
    "op11_conversation_repair": conversation_repair.SQL,
}

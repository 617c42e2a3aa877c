"""The operators' queries over the test tables, and SQL they must agree with."""

from shoplake.llm import (
    bpe, chat, conversations, decontamination, jaccard, language, lines, lm_score, quality, secrets, token_counts, toxicity,
    vector_codes,
)

QUERIES = {
    "op1_chat_formatting": chat.query,
    "op3_token_counts": token_counts.query,
    "op5_toxicity": toxicity.query,
    "op10_lm_score": lm_score.query,
    "op2_line_dedup": lines.query,
    "op6_language_id": language.query,
    "op7_quality_rules": quality.query,
    "op4_ngram_jaccard_join": jaccard.query,
    "op8_benchmark_decontamination": decontamination.query,
    "op9_bpe": bpe.query,
    "op11_secret_scans": secrets.query,
    "op12_conversation_repair": conversations.query,
    "op13_vector_codes": vector_codes.query,
}

ORACLES = {
    "op1_chat_formatting": chat.ORACLE,
    "op2_line_dedup": lines.ORACLE,
    "op4_ngram_jaccard_join": jaccard.ORACLE,
    "op8_benchmark_decontamination": decontamination.ORACLE,
    "op12_conversation_repair": conversations.ORACLE,
    "op13_vector_codes": vector_codes.ORACLE,
}

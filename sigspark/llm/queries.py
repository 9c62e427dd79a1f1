"""Registry of the text operators' queries and SQL."""

from __future__ import annotations

from . import chat, contamination, jaccard, language, lloyd, media, merges, pieces, quality, secrets, suffix_dedup, warc

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_quality_classifier": quality.op2_quality_classifier,
    "op3_media_columns": media.op3_media_columns,
    "op4_decontamination": contamination.op4_decontamination,
    "op5_sentencepiece": pieces.op5_sentencepiece,
    "op6_suffix_array_dedup": suffix_dedup.op6_suffix_array_dedup,
    "op7_language_id": language.op7_language_id,
    "op8_chat_formatting": chat.op8_chat_formatting,
    "op9_jaccard_join": jaccard.op9_jaccard_join,
    "op10_secret_scans": secrets.op10_secret_scans,
    "op11_bpe": merges.op11_bpe,
    "op12_lloyd": lloyd.op12_lloyd,
}

#: Further queries of an operator, over the table that has the rest of its evidence.
MORE = {"op7_language_id_pages": language.op7_language_id_pages}

ORACLE = {
    "op1_warc": warc.OP1_SQL,
    "op4_decontamination": contamination.OP4_SQL,
    "op6_suffix_array_dedup": suffix_dedup.OP6_SQL,
    "op8_chat_formatting": chat.OP8_SQL,
    "op9_jaccard_join": jaccard.OP9_SQL,
    "op10_secret_scans": secrets.OP10_SQL,
    "op12_lloyd": lloyd.OP12_SQL,
}

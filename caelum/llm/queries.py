"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from caelum.llm import (
    decontaminate,
    exact_search,
    language_id,
    line_dedup,
    near_dup,
    packing,
    quality,
    quotes,
    sentence_pieces,
    spelling,
    token_counts,
    warc,
    whitening,
)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_quality": quality.op3_quality,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_warc": warc.op5_warc,
    "op6_exact_search": exact_search.op6_exact_search,
    "op7_language_id": language_id.op7_language_id,
    "op8_near_dup": near_dup.op8_near_dup,
    "op9_quotes": quotes.op9_quotes,
    "op10_sentence_pieces": sentence_pieces.op10_sentence_pieces,
    "op11_spelling": spelling.op11_spelling,
    "op12_packing": packing.op12_packing,
    "op13_whitening": whitening.op13_whitening,
}

ORACLES: dict[str, str] = {
    "op1_line_dedup": line_dedup.SQL,
    "op5_warc": warc.SQL,
    "op6_exact_search": exact_search.SQL,
    "op9_quotes": quotes.SQL,
}

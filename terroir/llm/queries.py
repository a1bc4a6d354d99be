"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from terroir.llm import bpe, chat, divergence, exact_dedup, lexical, licenses, mixing, pages, phrases, simhash, suffix_dedup, token_file, toxicity

QUERIES = {
    "op1_byte_bpe": bpe.op1_byte_bpe,
    "op2_mixing": mixing.op2_mixing,
    "op3_license_scan": licenses.op3_license_scan,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_token_file": token_file.op5_token_file,
    "op6_suffix_dedup": suffix_dedup.op6_suffix_dedup,
    "op7_chat_format": chat.op7_chat_format,
    "op8_simhash": simhash.op8_simhash,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_fingerprints": phrases.op10_fingerprints,
    "op11_html_text": pages.op11_html_text,
    "op12_source_divergence": divergence.op12_source_divergence,
    "op13_lexical_search": lexical.op13_lexical_search,
}

SQL = {
    "op2_mixing": mixing.SQL,
    "op3_license_scan": licenses.SQL,
    "op4_exact_dedup": exact_dedup.SQL,
    "op7_chat_format": chat.SQL,
    "op11_html_text": pages.SQL,
    "op12_source_divergence": divergence.SQL,
    "op13_lexical_search": lexical.SQL,
}

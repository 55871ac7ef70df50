"""The corpus operators' queries over the given tables, and their SQL where SQL can express them."""

from stayscope.llm import chat, divergence, exact_dedup, licenses, mixing, neighbours, packing, pages, periodic, quality, secrets, similar, toxicity

QUERIES = {
    "op1_source_mix": mixing.op1_source_mix,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_nnls_packing": packing.op3_nnls_packing,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_quality": quality.op5_quality,
    "op6_chat_format": chat.op6_chat_format,
    "op7_main_text": pages.op7_main_text,
    "op8_nearest_neighbours": neighbours.op8_nearest_neighbours,
    "op9_similar_documents": similar.op9_similar_documents,
    "op10_secret_scan": secrets.op10_secret_scan,
    "op11_license_scan": licenses.op11_license_scan,
    "op12_word_runs": periodic.op12_word_runs,
    "op13_source_divergence": divergence.op13_source_divergence,
}

ORACLE_SQL = {
    "op1_source_mix": mixing.OP1_SQL,
    "op2_exact_dedup": exact_dedup.OP2_SQL,
    "op6_chat_format": chat.OP6_SQL,
    "op11_license_scan": licenses.OP11_SQL,
    "op13_source_divergence": divergence.OP13_SQL,
}

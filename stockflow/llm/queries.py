"""Registered queries of the operators: name -> (DataFrame function of (spark, sf_dir), SQL twin or None)."""

from stockflow.llm import bpe, chat, ctw, decontaminate, jaccard, langid, merkle, packing, quality, records, token_counts, topk, whitening

QUERIES = {
    "op1_token_counts": (token_counts.op1_token_counts, None),
    "op2_exact_top_k": (topk.op2_exact_top_k, topk.OP2_SQL),
    "op3_language_id": (langid.op3_language_id, None),
    "op4_chat_examples": (chat.op4_chat_examples, chat.OP4_SQL),
    "op5_ngram_jaccard": (jaccard.op5_ngram_jaccard, None),
    "op6_decontaminate": (decontaminate.op6_decontaminate, decontaminate.OP6_SQL),
    "op7_language_model": (ctw.op7_language_model, None),
    "op8_byte_bpe": (bpe.op8_byte_bpe, None),
    "op9_quality": (quality.op9_quality, None),
    "op10_token_records": (records.op10_token_records, None),
    "op11_merkle_manifest": (merkle.op11_merkle_manifest, merkle.OP11_SQL),
    "op12_packing": (packing.op12_packing, None),
    "op13_whitening": (whitening.op13_whitening, None),
}

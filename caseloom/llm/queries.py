"""The queries of the training-data operators, and their SQL where there is some."""

from caseloom.llm import ann, exact_dedup, html_text, langid, mixing, pii, sentencepiece_fst, sharding, simhash, toxicity

QUERIES = {
    "op1_pii": pii.op1,
    "op2_exact_dedup": exact_dedup.op2,
    "op3_mixing": mixing.op3,
    "op4_toxicity": toxicity.op4,
    "op5_html_text": html_text.op5,
    "op6_sharding": sharding.op6,
    "op7_simhash": simhash.op7,
    "op8_sentencepiece": sentencepiece_fst.op8,
    "op9_nearest": ann.op9,
    "op10_language": langid.op10,
}

ORACLE = {
    "op2_exact_dedup": exact_dedup.OP2_SQL,
}

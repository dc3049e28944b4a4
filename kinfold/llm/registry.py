"""The queries of this subpackage and their SQL."""

from kinfold.llm import gru_lm, html_template, mixing, near_dedup, pieces, pii, quality_classifier, quality_rules, topk, warc

QUERIES = {
    "op1_minhash_dedup": near_dedup.op1_minhash_dedup,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_html_template": html_template.op3_html_template,
    "op4_topk": topk.op4_topk,
    "op5_gru_lm": gru_lm.op5_gru_lm,
    "op6_mixing": mixing.op6_mixing,
    "op7_warc": warc.op7_warc,
    "op8_pii": pii.op8_pii,
    "op9_pieces": pieces.op9_pieces,
    "op10_quality_pu": quality_classifier.op10_quality_pu,
}
ORACLES = {"op4_topk": topk.OP4_SQL, "op6_mixing": mixing.OP6_SQL, "op7_warc": warc.OP7_SQL}

"""Registered queries of this subpackage and their SQL."""

from . import chat, jaccard, langid, licenses, mixing, neardup, negatives, oracles, packing, pages, runs, secrets, token_counts, topk

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_neardup": neardup.op2_neardup,
    "op3_secrets": secrets.op3_secrets,
    "op4_mixing": mixing.op4_mixing,
    "op5_jaccard": jaccard.op5_jaccard,
    "op6_chat": chat.op6_chat,
    "op7_licenses": licenses.op7_licenses,
    "op8_topk": topk.op8_topk,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_language_id": langid.op10_language_id,
    "op11_negatives": negatives.op11_negatives,
    "op12_pages": pages.op12_pages,
    "op13_runs": runs.op13_runs,
}
ORACLES = {
    "op2_neardup": oracles.OP2_SQL,
    "op4_mixing": mixing.OP4_SQL,
    "op5_jaccard": oracles.OP5_SQL,
    "op6_chat": oracles.OP6_SQL,
    "op8_topk": topk.OP8_SQL,
    "op11_negatives": negatives.OP11_SQL,
    "op13_runs": runs.OP13_SQL,
}

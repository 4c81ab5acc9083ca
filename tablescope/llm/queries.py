"""The registered queries of this subpackage, and the SQL of those SQL can express."""

from . import align, caps, chat, langid, licenses, packing, quality, repair, repeats, secrets, simhash, tokens, toxicity

QUERIES = {
    "op1_repeats": repeats.op1_repeats,
    "op2_bpe": tokens.op2_bpe,
    "op3_caps": caps.op3_caps,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_packing": packing.op5_packing,
    "op6_language": langid.op6_language,
    "op7_chat": chat.op7_chat,
    "op8_secrets": secrets.op8_secrets,
    "op9_quality": quality.op9_quality,
    "op10_simhash": simhash.op10_simhash,
    "op11_alignment": align.op11_alignment,
    "op12_repair": repair.op12_repair,
    "op13_licenses": licenses.op13_licenses,
}
ORACLES = {**chat.ORACLES}

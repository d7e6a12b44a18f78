"""The queries of this subpackage by name, and their SQL where SQL can express them."""

from __future__ import annotations

from . import ann, decontam, htmltext, langid, lm, packing, quality, sharding, simhash, substring

QUERIES = {
    "op1_reshard": sharding.op1_reshard,
    "op2_simhash": simhash.op2_simhash,
    "op3_substring": substring.op3_substring,
    "op4_lm": lm.op4_lm,
    "op5_quality": quality.op5_quality,
    "op6_nearest": ann.op6_nearest,
    "op7_decontam": decontam.op7_decontam,
    "op8_pack": packing.op8_pack,
    "op9_html": htmltext.op9_html,
    "op10_langid": langid.op10_langid,
}
ORACLES: dict[str, str] = {}

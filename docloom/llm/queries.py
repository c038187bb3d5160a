"""The registered query of each corpus operator, and SQL where SQL can express it."""

from . import bpe, langid, licenses, lm, packing, quality, rules, simhash, sketch, token_orc

QUERIES = {
    "op1_token_orc": token_orc.query,
    "op2_sketch": sketch.query,
    "op3_simhash": simhash.query,
    "op4_quality": quality.query,
    "op5_bpe": bpe.query,
    "op6_rules": rules.query,
    "op7_licenses": licenses.query,
    "op8_lm": lm.query,
    "op9_langid": langid.query,
    "op10_packing": packing.query,
    "rules_ablation": rules.ablation_query,
}
ORACLE_SQL: dict[str, str] = {"op6_rules": rules.SQL, "rules_ablation": rules.ABLATION_SQL}

"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from meterlake.llm import classifier, exact, html_text, jaccard, lm_scores, mixing, packing, periodic, reshard, rules, spelling, suffixes, toxicity

QUERIES = {
    "op1_lm_scores": lm_scores.op1_registered,
    "op2_min_cost_resharding": reshard.op2_min_cost_resharding,
    "op3_quality_rules": rules.op3_quality_rules,
    "op4_ngram_jaccard_join": jaccard.op4_ngram_jaccard_join,
    "op5_quality_classifier": classifier.op5_quality_classifier,
    "op6_exact_dedup": exact.op6_exact_dedup,
    "op7_mixing": mixing.op7_mixing,
    "op8_suffix_array_dedup": suffixes.op8_suffix_array_dedup,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_best_fit_packing": packing.op10_best_fit_packing,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_periodic_runs": periodic.op12_periodic_runs,
    "op13_html_text": html_text.op13_html_text,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op3_quality_rules": rules.op3_sql(),
    "op4_ngram_jaccard_join": jaccard.OP4_SQL,
    "op6_exact_dedup": exact.OP6_SQL,
    "op11_spelling_variants": spelling.OP11_SQL,
}

"""Name -> query and name -> oracle SQL of the operators and the pipeline."""

from __future__ import annotations

import corpus_pipeline

from . import bpe, decontaminate, katz, licenses, merkle, ngram_join, perplexity, pii, prefix_trie, quality_net, style_tree, substrings, warc

QUERIES = {
    "op1_quality_net": quality_net.op1_quality_net,
    "op2_ngram_join": ngram_join.op2_ngram_join,
    "op3_perplexity_rules": perplexity.op3_perplexity_rules,
    "op4_license_scan": licenses.op4_license_scan,
    "op5_substring_dedup": substrings.op5_substring_dedup,
    "op6_pii_tagger": pii.op6_pii_tagger,
    "op7_style_tree": style_tree.op7_style_tree,
    "op8_byte_bpe": bpe.op8_byte_bpe,
    "op9_warc_bundles": warc.op9_warc_bundles,
    "op10_decontamination": decontaminate.op10_decontamination,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_katz_backoff": katz.op13_katz_backoff,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op2_ngram_join": ngram_join.ORACLE,
    "op5_substring_dedup": substrings.ORACLE,
    "op9_warc_bundles": warc.ORACLE,
    "op10_decontamination": decontaminate.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
    "op13_katz_backoff": katz.ORACLE,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

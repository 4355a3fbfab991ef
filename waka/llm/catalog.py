"""Registry of the training-data queries and their SQL."""

from __future__ import annotations

from waka.llm import decontamination, fingerprints, language_id, licenses, manifest, mixing, ngram_join, repeats, secrets, sharding, spelling, token_count, toxicity

QUERIES = {f.__name__: f for f in (
    sharding.op1_sharding,
    decontamination.op2_decontamination,
    language_id.op3_language_id,
    licenses.op4_license_scan,
    toxicity.op5_toxicity,
    secrets.op6_secret_scan,
    mixing.op7_mixing,
    token_count.op8_token_count,
    ngram_join.op9_ngram_join,
    fingerprints.op10_fingerprints,
    spelling.op11_spelling_variants,
    repeats.op12_substring_dedup,
    manifest.op13_merkle_manifest,
)}
ORACLES = {
    "op1_sharding": sharding.ORACLE,
    "op4_license_scan": licenses.ORACLE,
    "op7_mixing": mixing.ORACLE,
    "op9_ngram_join": ngram_join.ORACLE,
    "op11_spelling_variants": spelling.ORACLE,
    "op12_substring_dedup": repeats.ORACLE,
    "op13_merkle_manifest": manifest.ORACLE,
}

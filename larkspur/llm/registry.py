"""The registered queries of this subpackage and the SQL that gives the same rows, where SQL can."""

import corpus_pipeline
from larkspur.llm import dartminhash, decontam, divergence, filters, hnsw, langid, licenses, mixing, sharding, suffixes, tokens, toolcalls, urls

QUERIES = {
    "op1_url_filter": urls.query,
    "op2_tool_links": toolcalls.query,
    "op3_decontamination": decontam.query,
    "op4_kd_shards": sharding.query,
    "op5_hnsw_near_dups": hnsw.query,
    "op6_dart_minhash": dartminhash.query,
    "op7_mix_sources": mixing.query,
    "op8_token_counts": tokens.query,
    "op9_language_id": langid.query,
    "op10_suffix_dedup": suffixes.query,
    "op11_filter_audit": filters.query,
    "op12_source_divergence": divergence.query,
    "op13_license_scan": licenses.query,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_url_filter": urls.ORACLE_SQL,
    "op2_tool_links": toolcalls.ORACLE_SQL,
    "op7_mix_sources": mixing.ORACLE_SQL,
    "op11_filter_audit": filters.ORACLE_SQL,
    "op12_source_divergence": divergence.ORACLE_SQL,
}

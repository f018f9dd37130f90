"""The registered queries of the subpackage and their reference SQL."""

from __future__ import annotations

from ridemart.llm import (
    licenses,
    mixing,
    packing,
    periodic_runs,
    quality_rules,
    resampling,
    sharding,
    simhash,
    suffix_dedup,
    token_files,
    url_filter,
    vector_search,
    warc,
)

QUERIES = {
    "op1_url_filter": url_filter.query,
    "op2_source_mix": mixing.query,
    "op3_simhash": simhash.query,
    "op4_top_k": vector_search.query,
    "op5_quality_rules": quality_rules.query,
    "op6_packing": packing.query,
    "op7_token_files": token_files.query,
    "op8_sharding": sharding.query,
    "op9_warc": warc.query,
    "op10_licenses": licenses.query,
    "op11_suffix_dedup": suffix_dedup.query,
    "op12_periodic_runs": periodic_runs.query,
    "op13_resampling": resampling.query,
}

ORACLES = {
    "op1_url_filter": url_filter.ORACLE,
    "op4_top_k": vector_search.ORACLE,
    "op9_warc": warc.ORACLE,
    "op10_licenses": licenses.ORACLE,
    "op13_resampling": resampling.ORACLE,
}

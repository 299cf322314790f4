"""Operators for building language-model training data, and their named queries."""

from cohortlens.llm import (
    bpe,
    exact,
    filter_audit,
    inner_products,
    langid,
    line_crf,
    mixing,
    prefix_hash,
    sharding,
    simhash,
    substring,
    token_counts,
    vector_codes,
)

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_language_mixture": langid.op2_language_mixture,
    "op3_substring_dedup": substring.op3_substring_dedup,
    "op4_line_quality": line_crf.op4_line_quality,
    "op5_exact_dedup": exact.op5_exact_dedup,
    "op6_prefix_fingerprints": prefix_hash.op6_prefix_fingerprints,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_simhash": simhash.op8_simhash,
    "op9_bpe": bpe.op9_bpe,
    "op10_sharding": sharding.op10_sharding,
    "op11_top_products": inner_products.op11_top_products,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL = {
    "op1_mix_sources": mixing.ORACLE_SQL,
    "op3_substring_dedup": substring.ORACLE_SQL,
    "op5_exact_dedup": exact.ORACLE_SQL,
    "op11_top_products": inner_products.ORACLE_SQL,
    "op12_vector_codes": vector_codes.ORACLE_SQL,
    "op13_filter_audit": filter_audit.ORACLE_SQL,
}

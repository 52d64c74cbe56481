"""The registered queries of this subpackage, and their SQL where SQL can say it."""

from logweir.llm import (
    decontamination,
    importance,
    jaccard_join,
    line_rules,
    mixing,
    periodic,
    quality,
    severity,
    sharding,
    substrings,
    token_counts,
    url_lists,
    warc,
)

QUERIES = {
    "op1_pivotal_mix": mixing.op1_pivotal_mix,
    "op2_line_frequency": line_rules.op2_line_frequency,
    "op3_two_tier_counts": token_counts.op3_two_tier_counts,
    "op4_ordinal_severity": severity.op4_ordinal_severity,
    "op5_set_relations": jaccard_join.op5_set_relations,
    "op6_positional_index": decontamination.op6_positional_index,
    "op7_warc_round_trip": warc.op7_warc_round_trip,
    "op8_digest_array": url_lists.op8_digest_array,
    "op9_feistel_shards": sharding.op9_feistel_shards,
    "op10_subword_quality": quality.op10_subword_quality,
    "op11_recompression_runs": periodic.op11_recompression_runs,
    "op12_crc_importance": importance.op12_crc_importance,
    "op13_suffix_subtrees": substrings.op13_suffix_subtrees,
}

ORACLES = {
    "op2_line_frequency": line_rules.OP2_SQL,
    "op5_set_relations": jaccard_join.OP5_SQL,
    "op6_positional_index": decontamination.OP6_SQL,
    "op7_warc_round_trip": warc.OP7_SQL,
    "op8_digest_array": url_lists.OP8_SQL,
    "op11_recompression_runs": periodic.OP11_SQL,
    "op12_crc_importance": importance.OP12_SQL,
    "op13_suffix_subtrees": substrings.OP13_SQL,
}

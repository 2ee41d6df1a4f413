"""The operators of this package as queries, and the DuckDB statements for them."""

from pulseboard.llm import (collocations, langid, licenses, merkle, mixing, packing, pii,
                            positional, quality, quotes, repeats, simhash, spotsigs)

QUERIES = {f.__name__: f for f in (
    quality.op1_rule_ledger, quotes.op2_quotation_linking, licenses.op3_signature_rules,
    simhash.op4_deletion_variants, langid.op5_string_kernel, mixing.op6_poisson_mixing,
    pii.op7_bootstrapped_pii, repeats.op8_prefix_free_parsing,
    packing.op9_hierarchical_packing, spotsigs.op10_spotsigs,
    positional.op11_positional_index, collocations.op12_quotient_filters,
    merkle.op13_merkle_manifest)}

STATEMENTS = {"op1_rule_ledger": quality.SQL, "op6_poisson_mixing": mixing.SQL,
              "op11_positional_index": positional.SQL,
              "op12_quotient_filters": collocations.SQL,
              "op13_merkle_manifest": merkle.SQL}

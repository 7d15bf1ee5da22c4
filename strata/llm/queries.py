"""Registered queries of the operators; SQL twins where SQL can say the same."""

from strata.llm.capfilters import op10_cap_filters
from strata.llm.fim import op11_fim
from strata.llm.langid import op3_language
from strata.llm.mainparts import op2_host_paths
from strata.llm.oracle import ORACLE
from strata.llm.packing import op7_packing
from strata.llm.postings import op1_postings
from strata.llm.prefixtrie import op13_prefix_trie
from strata.llm.secretscan import op12_secrets
from strata.llm.simhash import op5_simhash
from strata.llm.substring import op8_substring
from strata.llm.tokencounts import op9_token_counts
from strata.llm.tokenfiles import op6_token_files
from strata.llm.wordtable import op4_word_table

QUERIES = {
    "op1_postings": op1_postings,
    "op2_host_paths": op2_host_paths,
    "op3_language": op3_language,
    "op4_word_table": op4_word_table,
    "op5_simhash": op5_simhash,
    "op6_token_files": op6_token_files,
    "op7_packing": op7_packing,
    "op8_substring": op8_substring,
    "op9_token_counts": op9_token_counts,
    "op10_cap_filters": op10_cap_filters,
    "op11_fim": op11_fim,
    "op12_secrets": op12_secrets,
    "op13_prefix_trie": op13_prefix_trie,
}

__all__ = ["ORACLE", "QUERIES"]

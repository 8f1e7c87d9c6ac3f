"""Registered queries of this subpackage and, where SQL can say it, their oracles."""

from verdictlake.llm.common import Query
from verdictlake.llm.exact_search import OP4_SQL, op4_exact_top_k
from verdictlake.llm.forest_search import op6_forest_search
from verdictlake.llm.language import op7_language_id
from verdictlake.llm.lexical import OP12_SQL, op12_lexical_search
from verdictlake.llm.licenses import OP9_SQL, op9_license_scan
from verdictlake.llm.mixing import OP8_SQL, op8_mix_sources
from verdictlake.llm.packing import op3_pack_sequences
from verdictlake.llm.periodic import op13_periodic_runs
from verdictlake.llm.secrets import OP10_SQL, op10_secret_scan
from verdictlake.llm.signature_join import op5_jaccard_components
from verdictlake.llm.substrings import op2_substring_dedup
from verdictlake.llm.token_files import op1_token_files
from verdictlake.llm.trie_bpe import op11_bpe_round_trip

QUERIES: dict[str, Query] = {
    "op1_token_files": op1_token_files,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_pack_sequences": op3_pack_sequences,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_jaccard_components": op5_jaccard_components,
    "op6_forest_search": op6_forest_search,
    "op7_language_id": op7_language_id,
    "op8_mix_sources": op8_mix_sources,
    "op9_license_scan": op9_license_scan,
    "op10_secret_scan": op10_secret_scan,
    "op11_bpe_round_trip": op11_bpe_round_trip,
    "op12_lexical_search": op12_lexical_search,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {
    "op4_exact_top_k": OP4_SQL.strip(),
    "op8_mix_sources": OP8_SQL.strip(),
    "op9_license_scan": OP9_SQL.strip(),
    "op10_secret_scan": OP10_SQL.strip(),
    "op12_lexical_search": OP12_SQL.strip(),
}

"""The registered queries of the operators, and their DuckDB SQL."""

from rewardseg.llm.alignment import op12_token_alignment
from rewardseg.llm.conversations import op11_conversation_trie, op11_sql
from rewardseg.llm.language import op10_language
from rewardseg.llm.licenses import op9_licenses
from rewardseg.llm.mixing import op4_mixing, op4_sql
from rewardseg.llm.packing import op5_packing
from rewardseg.llm.permutations import op2_permutation_search
from rewardseg.llm.pii import op13_personal_data
from rewardseg.llm.quality import op6_quality
from rewardseg.llm.simhash import op3_simhash
from rewardseg.llm.spotsigs import op7_spotsigs
from rewardseg.llm.token_files import op8_token_files
from rewardseg.llm.urls import op1_sql, op1_url_filter

QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_permutation_search": op2_permutation_search,
    "op3_simhash": op3_simhash,
    "op4_mixing": op4_mixing,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_spotsigs": op7_spotsigs,
    "op8_token_files": op8_token_files,
    "op9_licenses": op9_licenses,
    "op10_language": op10_language,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_token_alignment": op12_token_alignment,
    "op13_personal_data": op13_personal_data,
}
ORACLE_SQL = {"op1_url_filter": op1_sql(), "op4_mixing": op4_sql(), "op11_conversation_trie": op11_sql()}

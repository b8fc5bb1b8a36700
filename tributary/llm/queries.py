"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from tributary.llm.bpe import op8_bpe
from tributary.llm.conversation_trie import OP11_SQL, op11_conversation_trie
from tributary.llm.embedding_dedup import op10_embedding_dedup
from tributary.llm.html_extraction import op2_html_extraction
from tributary.llm.jaccard_join import op9_jaccard_join
from tributary.llm.line_dedup import OP7_SQL, op7_line_dedup
from tributary.llm.mixing import op4_mixing, op4_sql
from tributary.llm.periodic_runs import op12_periodic_runs
from tributary.llm.quality_classifier import op5_quality_classifier
from tributary.llm.quality_rules import op1_quality_rules
from tributary.llm.shared import importable
from tributary.llm.token_counts import op6_token_counts
from tributary.llm.token_files import op13_token_files
from tributary.llm.toxicity import op3_toxicity


def _query(build):
    def run(spark, sf_dir):
        importable(spark)
        return build(spark, sf_dir)

    return run


QUERIES = {name: _query(build) for name, build in {
    "op1_quality_rules": op1_quality_rules,
    "op2_html_extraction": op2_html_extraction,
    "op3_toxicity": op3_toxicity,
    "op4_mixing": op4_mixing,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_token_counts": op6_token_counts,
    "op7_line_dedup": op7_line_dedup,
    "op8_bpe": op8_bpe,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_files": op13_token_files,
}.items()}

# The other operators are not expressible in SQL; tests/llm holds them against
# brute-force versions, exact round trips or held-out labels.
ORACLE = {
    "op4_mixing": op4_sql(),
    "op7_line_dedup": OP7_SQL,
    "op11_conversation_trie": OP11_SQL,
}

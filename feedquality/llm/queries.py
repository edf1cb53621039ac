"""One query for each operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from feedquality.llm.bpe import op10_byte_bpe
from feedquality.llm.byte_cnn import op7_byte_cnn
from feedquality.llm.decontaminate import OP5_SQL, op5_decontaminate
from feedquality.llm.jaccard_join import op3_jaccard_join
from feedquality.llm.line_dedup import OP6_SQL, op6_line_dedup
from feedquality.llm.packing import op13_packing
from feedquality.llm.prefix_trie import OP11_SQL, op11_prefix_trie
from feedquality.llm.quality_rules import op9_quality_rules
from feedquality.llm.quote_links import OP2_SQL, op2_quote_links
from feedquality.llm.secret_scan import op1_secret_scan
from feedquality.llm.token_counts import op8_token_counts
from feedquality.llm.url_filter import OP4_SQL, op4_url_filter
from feedquality.llm.whitening import op12_whitening

QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_quote_links, op3_jaccard_join, op4_url_filter, op5_decontaminate, op6_line_dedup,
    op7_byte_cnn, op8_token_counts, op9_quality_rules, op10_byte_bpe,
    op11_prefix_trie, op12_whitening, op13_packing)}

ORACLE = {"op2_quote_links": OP2_SQL, "op4_url_filter": OP4_SQL, "op5_decontaminate": OP5_SQL,
          "op6_line_dedup": OP6_SQL, "op11_prefix_trie": OP11_SQL}

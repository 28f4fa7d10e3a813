"""Registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from .decontaminate import op8_benchmark_leaks
from .license_scan import op10_license_scan
from .line_dedup import OP6_SQL, op6_line_dedup
from .ngram_join import op7_ngram_join
from .packing import op9_mixture_packing
from .periodic_runs import op13_periodic_runs
from .quality_rules import op1_quality_rules
from .sharding import op5_rendezvous_shards
from .token_alignment import op11_token_alignment
from .token_files import op4_token_files
from .url_filter import op2_url_filter
from .vector_graph import op12_vector_graphs
from .warc import op3_warc_archives

QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_url_filter, op3_warc_archives, op4_token_files, op5_rendezvous_shards, op6_line_dedup,
    op7_ngram_join, op8_benchmark_leaks, op9_mixture_packing, op10_license_scan,
    op11_token_alignment, op12_vector_graphs, op13_periodic_runs)}

SQL = {
    "op6_line_dedup": OP6_SQL,
}

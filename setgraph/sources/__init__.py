"""Sources and sinks."""

from .readers import (EDGE_SCHEMA, parse_edges, parse_sets, read_edges, read_edges_checked, read_lines, read_sets,
                      read_sets_checked)
from .sinks import (kv_line, pair_line, path_line, read_kv, read_pairs, read_paths, read_sorted, write_kv, write_pairs,
                    write_paths, write_sorted)
from .tables import order_edges, table, text_sets

__all__ = [
    "EDGE_SCHEMA", "kv_line", "order_edges", "pair_line", "parse_edges", "parse_sets", "path_line",
    "read_edges", "read_edges_checked", "read_kv", "read_lines", "read_pairs", "read_paths", "read_sets",
    "read_sets_checked", "read_sorted", "table", "text_sets", "write_kv", "write_pairs", "write_paths", "write_sorted",
]

"""Column-level functions (Catalyst built-ins only)."""

from .paths import double_string, path_string
from .sets import (EPS, check_threshold, jaccard, min_partner_size, prefix_length,
                   required_overlap)
from .text import (LINE_BREAK, TERM_DELIMITERS, TERM_SPLIT_REGEX, split_lines,
                   tokenize)

__all__ = [
    "EPS", "LINE_BREAK", "TERM_DELIMITERS", "TERM_SPLIT_REGEX", "check_threshold",
    "double_string", "jaccard", "min_partner_size", "path_string", "prefix_length",
    "required_overlap", "split_lines", "tokenize",
]

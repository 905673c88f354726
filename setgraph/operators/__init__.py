"""DataFrame -> DataFrame operators."""

from .edges import incoming_edge_avg, min_edges, reverse_adjacency
from .paths import assemble_paths, prepare_edges, shortest_distances, shortest_paths_to
from .setsim import (filter_by_signature, overlap_candidates, prefix_tokens, rank_encode, rank_tokens, set_records,
                     set_signatures, set_similarity_join, similarity_candidates, token_frequencies, token_ranks, verify_pairs)
from .text import (contexts, cooccurrence, cooccurrence_stripes, flatten_stripes, merge_stripes,
                   stripes_from_pairs, terms, word_count)

__all__ = [
    "assemble_paths", "contexts", "cooccurrence", "cooccurrence_stripes", "flatten_stripes",
    "merge_stripes", "incoming_edge_avg", "min_edges", "prefix_tokens", "rank_encode", "rank_tokens", "prepare_edges", "reverse_adjacency",
    "filter_by_signature", "overlap_candidates", "set_records", "set_signatures", "set_similarity_join", "shortest_distances", "shortest_paths_to",
    "similarity_candidates", "stripes_from_pairs", "terms", "token_frequencies", "token_ranks",
    "verify_pairs", "word_count",
]

"""Structured Streaming entry points.

The original jobs are one-shot batch jobs; the only operator that keeps its
meaning on an unbounded input is the term count (a single aggregation), so it
is offered on streams as well.  Co-occurrence, edge, path and similarity
operators need whole inputs (several chained aggregations or iteration) and
are batch-only.
"""

from .counts import stream_word_count, write_counts

__all__ = ["stream_word_count", "write_counts"]

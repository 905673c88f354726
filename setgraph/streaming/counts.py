"""Running term counts over a stream of text rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.text import word_count


def stream_word_count(stream: DataFrame, col: str = "text") -> DataFrame:
    """``term, n``: running counts over a streaming DataFrame (same plan as the
    batch :func:`setgraph.operators.word_count`; state is one row per term)."""
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame (spark.readStream...)")
    return word_count(stream, col)


def write_counts(counts: DataFrame, checkpoint_location: str, sink: str,
                 name: str = "term_counts", mode: str = "update", **options) -> StreamingQuery:
    """Start the count query; ``checkpoint_location`` must be on a shared,
    fault-tolerant file system on a cluster (it holds offsets and state).  ``sink``
    is a streaming format; ``memory`` holds the whole table on the driver and is
    for tests."""
    w = counts.writeStream.outputMode(mode).format(sink).option("checkpointLocation", checkpoint_location)
    if sink == "memory":
        w = w.queryName(name)
    for k, v in options.items():
        w = w.option(k, v)
    return w.start()

import os
import tempfile

import pytest

from setgraph.operators import word_count
from setgraph.streaming import stream_word_count, write_counts

from .conftest import SF_SMALL, rows


def test_stream_word_count_equals_batch(spark):
    src = f"{SF_SMALL}/benchmark.parquet"
    schema = spark.read.parquet(src).schema
    d = tempfile.mkdtemp(prefix="setgraph-stream-")
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "benchmark.parquet").parquet(SF_SMALL)
    q = write_counts(stream_word_count(stream), os.path.join(d, "ckpt"), sink="memory", mode="complete", name="wc_test")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = rows(spark.table("wc_test"))
    assert got == rows(word_count(spark.read.parquet(src)))


def test_rejects_batch_input(spark):
    with pytest.raises(ValueError):
        stream_word_count(spark.createDataFrame([("a",)], "text string"))

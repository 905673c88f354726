"""The corpus pipeline over ``documents``: five stages, each one operator of
:mod:`setgraph.llm` with its production parameters.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; between stages the rows are written as Parquet to the shared folder and
read again.  All stages but the last return the columns of ``documents``.

* language_id: texts without a letter, and texts whose words have a best language of a
  mean probability below one half, go; texts of several languages stay.
* line_dedup: repeated lines are cut out of the texts; a text that has no words left goes.
* near_dedup: of each group of near-duplicates one row stays, that of the least id.
* decontaminate: rows that hold a benchmark item go.
* tokenize: the piece numbers of every text, checked to decode to it again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from setgraph.llm.common import prepare, read
from setgraph.llm.decontaminate import drop_contaminated
from setgraph.llm.langid import keep_identified
from setgraph.llm.line_dedup import drop_repeated_lines
from setgraph.llm.minhash import drop_near_duplicates
from setgraph.llm.sentencepiece import encode_texts
from setgraph.session import checkpoint_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return encode_texts(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("tokenize", tokenize),
]

# The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents`` of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs

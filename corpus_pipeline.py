"""The corpus pipeline: each stage takes (spark, docs, sf_dir) and returns the documents that go on.

The last stage gives one row for each document that is left: doc_id, n_tokens, ids_sha256, decoded_sha256, position (its
place in the mix) and ids (its tokens). Defined results: a null text is empty and fails the quality rules; rows without a
doc_id go through all stages as documents of their own; rows that repeat a doc_id and its text stay or go together;
further columns are carried to the last stage, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from varaq.llm.byte_bpe import tokenise
from varaq.llm.common import delete, scratch, shared_dir
from varaq.llm.minhash import keep_one_of_each
from varaq.llm.mixing import in_mixed_order
from varaq.llm.pii import sanitise
from varaq.llm.quality import keep_good

STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("pii", sanitise),
    ("mixing", in_mixed_order),
    ("byte_bpe", tokenise),
]

#: Learned rules and merges cannot be written in SQL; tests hold each stage's operator against SQL, a plain version or a
#: library, and run() against the operators one after the other, with the order of the mix.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written as Parquet and read again. What a stage reads goes once its
    own result is written; the last result stays in spark.checkpoint.dir, for the returned frame to read."""
    folder = shared_dir(spark, f"pipeline-{uuid.uuid4().hex[:8]}")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs

"""A training corpus from `documents`: known languages, no near copies, no repeated passages, no benchmark text, as ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written and read again for the next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from trackloom.llm import decontaminate, lang_id, simhash, substring, word_table
from trackloom.llm.common import fold
from trackloom.llm.queries import held_out, tokenizer_path
from trackloom.session import shared_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn the languages from the stage's own documents; drop texts without letters or without a language."""
    model = lang_id.train(docs.where(~held_out(fold("doc_id", 3) == 1)))
    return lang_id.keep_known(docs, model)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near copies the document with the smallest id stays."""
    return simhash.drop_near_copies(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut paragraphs and passages that an earlier document holds; the documents stay."""
    return substring.remove_repeats(docs)


def benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which a benchmark window occurs."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode what is left and prove the round trip: doc_id, n_tokens and digests of ids and decoded text."""
    return word_table.round_trip(docs, tokenizer_path())


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("benchmark_text", benchmark_text),
    ("token_ids", token_ids),
]

#: SQL has no SimHash, Bloom filter or BPE; tests/llm holds the pipeline against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table `documents`, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/trackloom/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs

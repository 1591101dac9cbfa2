"""A corpus pipeline over ``documents``, stage by stage.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
one's docs.  Every stage works on all rows that its predecessor kept, and all
but the last return the columns of ``documents``.  A null text stays null and
counts as empty; rows with a null doc_id are never duplicates of anything;
extra columns are carried along up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from forkcast.llm import bpe_automaton, decontam, lsh_forest, quality_pu, secret_scan
from forkcast.llm.queries import tokenizer_path
from forkcast.session import materialize


def good_quality(spark, docs, sf_dir):
    """Documents that the quality classifier scores 0.3 or more."""
    return quality_pu.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), least=0.3)


def one_of_each_group(spark, docs, sf_dir):
    """One document (the smallest id) of each group of near duplicates, similarity 0.8 or more."""
    return lsh_forest.deduplicated(docs, least_percent=80)


def without_benchmark(spark, docs, sf_dir):
    """Documents that leak no benchmark item."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark, docs, sf_dir):
    """All documents, secrets replaced in their texts; n_chars follows the text."""
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def token_ids(spark, docs, sf_dir):
    """doc_id, n_tokens, ids of all documents, and digests of the ids and of what they decode to."""
    return bpe_automaton.digests(docs, tokenizer_path(), keep_ids=True)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("tokens", token_ids),
]

#: No SQL can train the classifier or run the tokenizer; tests/llm/test_pipeline.py has brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs

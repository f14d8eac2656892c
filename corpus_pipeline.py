"""Corpus pipeline: quality rules, near copies, benchmark passages, then token ids.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the last
return the columns of ``documents``. Nulls, empty texts, repeated rows, empty tables and
further columns are handled as the operators' docstrings say: rows with a null or empty
text fall to the quality rules, of rows with one id at most one stays, and further columns are
carried along until the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from nearspark.llm import bpe, decontaminate, jaccard, quality
from nearspark.llm.scratch import Scratch
from nearspark.sources.tables import scan_table

TOKENIZER = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.accepted(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return jaccard.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.clean(docs, scan_table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's token ids, and the digest of their decoded text."""
    return bpe.digests(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", bpe_encoding),
]

#: Byte-pair encoding cannot be written in SQL; tests/llm compares the rows with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = scan_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.put(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)

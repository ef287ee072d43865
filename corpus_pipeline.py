"""The corpus pipeline: quality rules, toxicity, near duplicates, mixing, BPE. Each stage works on all that the one before kept.

Each function of STAGES takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``docs``. ``run`` writes each stage's result to the shared folder and reads it again.

Defined results: a null text counts as empty, and the quality rules reject it, so later stages see texts with words; null
sources are a source of their own, null doc_ids take part in all stages; repeated rows are copies, of which one stays; of ties
between equal doc_ids in a group of near duplicates one row stays; texts of any length are read whole; an empty table gives
an empty result in every stage; further columns pass through, whatever their names. Without labels every document has the
same score of 0.5, which rejects all: the pipeline needs labels.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from docloom.llm.bpe import bpe_digests
from docloom.llm.common import cut, table
from docloom.llm.jaccard_join import representatives
from docloom.llm.mixing import mixed_documents
from docloom.llm.quality import cleaned
from docloom.llm.toxicity import clean_documents


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines that their host repeats too often."""
    return cleaned(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5. The classifier learns from the labelled documents that reach this stage."""
    return clean_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles have a similarity of 0.8 or more."""
    return representatives(docs, n=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as their source's target takes them."""
    return mixed_documents(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document of the mix: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return bpe_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality_stage), ("toxicity", toxicity_stage), ("n-gram Jaccard join", near_duplicate_stage), ("mixing", mixing_stage), ("BPE", bpe_stage)]

#: SQL cannot express the classifier or the join's components; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)

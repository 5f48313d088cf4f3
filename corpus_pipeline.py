"""The corpus pipeline: quality, exact and near duplicates, benchmark leaks, tokens.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor
kept. The first four return the columns of ``docs`` for the rows that stay; the last
returns one row of token digests for each document. A decision names a row by its
``doc_id`` and text, so rows that repeat a ``doc_id`` are decided one by one.

Edge cases, as in the operators: a null text is an empty one; empty texts equal each other
and stay once; rows that repeat both id and text become one in the exact stage; other
columns pass through; an empty table passes through empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stellate.llm.bpe import encode_documents, token_digests
from stellate.llm.common import discard, read, staged, survivors
from stellate.llm.decontam import decontaminate
from stellate.llm.exact import exact_groups
from stellate.llm.near import near_groups
from stellate.llm.quality import score_sites


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the site-aware classifier accepts."""
    return survivors(docs, score_sites(docs, read(spark, sf_dir, "labels")).where("accepted"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of equal texts: the longest, then the smallest id."""
    return survivors(docs, exact_groups(docs).where("kept"), once=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the smallest id."""
    return survivors(docs, near_groups(docs).where("kept"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return survivors(docs, decontaminate(docs, read(spark, sf_dir, "benchmark")).where("n_hit = 0"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return token_digests(encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: The classifier and the tokenizer have no SQL form; tests/llm hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = before = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        docs = staged(stage(spark, before, sf_dir), f"pipeline-{name}")
        if i:  # only the last copy of the corpus stays, for the rows returned
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)

"""Corpus pipeline: toxicity, SimHash near duplicates, personal data, mixing, packing.

``run`` applies the stages to ``documents``; each stage's rows are written as Parquet in the shared folder
and read again as the next one's documents.  All stages but the last return the columns of
``documents``; columns beyond them are not carried on.

Rows that repeat an id are rows of their own: one stays of each SimHash group, the mix shares copies among them.  Null texts
count as empty and stay null; rows without an id are judged, mixed and packed like others and stand in no SimHash group.  Ties are broken by value, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from longtab.llm import mixing, packing, pii, simhash, toxicity
from longtab.llm.common import clipped, table
from longtab.llm.queries import added_tokens, tokenizer_path
from longtab.session import cut_lineage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that operator 7 predicts toxic go; rows without text stay unless empty texts are toxic."""
    docs = clipped(docs, COLUMNS)
    return toxicity.accepted(docs, toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id stays of each SimHash group (rows without an id stay)."""
    return simhash.one_per_group(clipped(docs, COLUMNS))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the text is replaced by its kind; n_chars follows."""
    docs = clipped(docs, COLUMNS)
    return pii.redacted(docs, pii.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(clipped(docs, COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place."""
    return packing.packed(clipped(docs, COLUMNS), tokenizer_path(), added=added_tokens())


STAGES = [("toxicity", drop_toxic), ("simhash", drop_near_duplicates), ("pii", redact_pii), ("mixing", mix_sources),
          ("packing", pack_sequences)]

# Learned models and approximate packing are beyond SQL; tests hold the operators and every stage against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

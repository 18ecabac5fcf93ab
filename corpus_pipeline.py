"""A corpus pipeline: each stage calls one operator on what the stage before kept.

Stages, in order: quality rules, near-duplicates, benchmark decontamination,
personal data, packing. A stage takes ``(spark, docs, sf_dir)`` and returns a
DataFrame; ``run`` writes it as Parquet in the shared folder and reads it again
as the next stage's ``docs``. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodload.llm import decontaminate, minhash, packing, pii, quality
from periodload.llm.frames import read, written
from periodload.llm.queries import BYTE_BPE, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule go, and those of rejected hosts."""
    return quality.good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest doc_id."""
    return minhash.remove_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.remove_documents(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts becomes its kind in brackets; n_chars follows the text."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents and their places in training sequences."""
    return packing.pack(written(packing.token_pieces(docs, tokenizer_path(BYTE_BPE)), "pieces"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("sequence_packing", sequence_packing),
]

#: SQL can't express byte-level BPE, nor best-fit packing: tests compare the
#: stages with plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Empty tables give an empty result; each stage's
    operator states what it does with nulls, ties and repeated rows."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

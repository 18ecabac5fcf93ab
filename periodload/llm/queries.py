"""The operators over their whole tables, with production parameters: one
query ``opN_<name>`` each, and its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_run_id, staging_root
from . import decontaminate, exactdedup, licenses, merkle, minhash, packing, pii, quality, resample, token_counts, tokenfile, toxicity, urlgraph
from .frames import read

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
CONTEXT_TOKENS = 4096
URL_RULES = (
    "allow org/",
    "block example.org/es/",
    "block example.org/en/1",
    "allow com/fr/",
    "block com/de/",
)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contamination_digest(decontaminate.find_contamination(docs, read(spark, sf_dir, "benchmark")))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(read(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data_digest(pii.find_personal_data(read(spark, sf_dir, "documents").select("doc_id", "text")))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(read(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE))
    return packing.pack(packing.written(pieces, "pieces"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    measured = quality.written(quality.measure(docs).drop("text"), "measured")
    counts = [F.col("quality")[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")]
    return quality.judge(measured).select("doc_id", *counts, "kept")


def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{staging_root(spark)}/llm/tokens-{new_run_id()}"
    tokenfile.write_token_file(read(spark, sf_dir, "documents"), path, tokenizer_path(BYTE_BPE))
    return tokenfile.written(tokenfile.read_token_file(spark, path), "decoded")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(read(spark, sf_dir, "documents"), tokenizer_path(PIECES))
    return counted.withColumn("over_limit", F.col("n_tokens") > CONTEXT_TOKENS)


def op10_url_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urlgraph.judge_urls(read(spark, sf_dir, "pages").select("page_id", "url", "html"), urlgraph.parse_rules(URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.exact_duplicates(read(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_decontamination, op2_toxicity, op3_licenses, op4_pii, op5_packing,
        op6_minhash, op7_quality, op8_token_file, op9_token_counts, op10_url_graph,
        op11_resampling, op12_exact_dedup, op13_merkle,
    )
}
SQL: dict[str, str] = {
    "op1_decontamination": decontaminate.SQL,
    "op6_minhash": minhash.SQL,
    "op7_quality": quality.SQL,
    "op10_url_graph": urlgraph.sql(urlgraph.parse_rules(URL_RULES)),
    "op11_resampling": resample.SQL,
    "op12_exact_dedup": exactdedup.SQL,
    "op13_merkle": merkle.SQL,
}

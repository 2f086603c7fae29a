"""One query for each operator, over whole tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import chat_format as _chat
from tidewater.llm import conversation_repair as _repair
from tidewater.llm import decontaminate as _decontaminate
from tidewater.llm import fingerprints as _prints
from tidewater.llm import language_id as _lang
from tidewater.llm import merkle as _merkle
from tidewater.llm import ngram_join as _join
from tidewater.llm import packing as _packing
from tidewater.llm import quality_classifier as _quality
from tidewater.llm import quality_rules as _rules
from tidewater.llm import suffix_dedup as _suffix
from tidewater.llm import token_counts as _tokens
from tidewater.llm import url_filter as _urls
from tidewater.llm.common import read

# A fitted model, EM, retrieval, hashing or a tokenizer decides these queries' rows: held against brute force or a library in tests/llm.
WITHOUT_SQL = ("op1_quality_classifier", "op2_quality_rules", "op3_retrieval_packing", "op6_ngram_jaccard_join", "op8_language_id",
               "op9_suffix_dedup", "op10_token_counts", "op11_document_fingerprints")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quality.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules.quality_rules(read(spark, sf_dir, "documents"))


def op3_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packing.digests(_packing.pack(read(spark, sf_dir, "documents")))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                  "conv_id bigint, turn bigint, role string, text string")
    return _chat.digests(_chat.format_conversations(turns.union(extra)))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decontaminate.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _join.jaccard_classes(read(spark, sf_dir, "documents"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _urls.judge(read(spark, sf_dir, "pages"), _urls.rules_frame(spark, _urls.RULES))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lang.language_id(read(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suffix.suffix_dedup(read(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tokens.token_counts(read(spark, sf_dir, "documents"), limit=4096)


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prints.edited_fingerprints(read(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merkle.document_proofs(read(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repair.Repair(_repair.damaged(read(spark, sf_dir, "conversations")), "copies").digests()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_quality_classifier, op2_quality_rules, op3_retrieval_packing, op4_chat_formatting, op5_decontamination,
        op6_ngram_jaccard_join, op7_url_filters, op8_language_id, op9_suffix_dedup, op10_token_counts,
        op11_document_fingerprints, op12_merkle_manifest, op13_conversation_repair)}


def oracle_sql() -> dict[str, str]:
    return {"op4_chat_formatting": _chat.oracle(), "op5_decontamination": _decontaminate.oracle(),
            "op7_url_filters": _urls.oracle(), "op12_merkle_manifest": _merkle.oracle(),
            "op13_conversation_repair": _repair.oracle()}

"""The registered queries opN_<name>, thin over the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, decontaminate, langid, linededup, ngramtrie, quality, simhash, sketch, toxicity, urltree
from tessera.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.held_out(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_url_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urltree.judge(table(spark, sf_dir, "pages"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digests(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramtrie.held_out(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digests(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(bpe.VOCABULARY))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.held_out(table(spark, sf_dir, "documents"))


def op10_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.edited(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_url_tree, op3_line_dedup, op4_quality, op5_decontaminate, op6_ngram_trie, op7_simhash, op8_bpe, op9_language_id, op10_sketch)}


def oracle_sql() -> dict[str, str]:
    return {"op2_url_tree": urltree.ORACLE, "op5_decontaminate": decontaminate.ORACLE}

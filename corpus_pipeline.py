"""The corpus pipeline: stages over `documents`, each written as Parquet and read again as the next one's input.

Documents that toxicity scoring rejects go; repeated blocks of lines go from the later documents; of near duplicates the
first document stays; documents with benchmark passages go; the rest is encoded and decoded. A stage gets whatever its
predecessor kept, and all but the last return the columns of documents, extra ones too.

Every stage judges rows, not ids: rows of one doc_id, or of none, with different texts are different documents. A null
text is the empty text (and stays null where its row stays). An empty table passes through as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, decontaminate, linededup, nearcopies, toxicity
from tessera.llm.common import Scratch, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows whose text isn't predicted toxic, learned from all labels. Repeated rows are judged alike and stay repeated; null and empty texts stay."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, without the runs of lines that an earlier document has too. Order is by doc_id, null first, then by the text's hash; rows equal in both keep the same text."""
    return linededup.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the smallest doc_id (null ids come last), then of the smallest hash of its text; of equal rows one. Texts without words are copies of each other."""
    return nearcopies.keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows in whose own text no window of a benchmark item occurs; repeated rows stay repeated."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each row: its ids, as a digest, and what they decode to; a null text has no ids."""
    return bpe.digests(docs, public_tokenizers.path(bpe.VOCABULARY))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("line_dedup", lines),
    ("simhash", near_duplicates),
    ("decontaminate", benchmark),
    ("bpe", encoded),
]
#: Components of near copies and fitted models are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over documents; the last one's rows."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch.cut(docs)
            if k:
                scratch.drop(k - 1)
    return docs

"""Retrieval quality: first hits, recall and reciprocal rank, and how alike the members of a heading are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import cosine

# What recall at k, reciprocal rank and recall of mixed-language queries are held against.
THRESHOLDS = {"recall": 0.6, "mrr": 0.5, "ko_en_recall": 0.4}


def first_hits(seeds: DataFrame, hits: DataFrame) -> DataFrame:
    """seeds (query_id, expected_chunk_ids, ..) with hit_rank, the rank of the first hit (query_id, chunk_id, rank) that is expected."""
    expected = seeds.select("query_id", F.explode("expected_chunk_ids").alias("chunk_id")).distinct()
    best = hits.join(expected, ["query_id", "chunk_id"]).groupBy("query_id").agg(F.min("rank").alias("hit_rank"))
    return seeds.join(best, "query_id", "left")


def judged(ranked: DataFrame, recall_k: int = 5, mrr_k: int = 10) -> DataFrame:
    """ranked with recalled and reciprocal_rank."""
    rank = F.col("hit_rank")
    return ranked.withColumn("recalled", F.coalesce(rank <= recall_k, F.lit(False))).withColumn("reciprocal_rank", F.when(rank <= mrr_k, 1.0 / rank).otherwise(F.lit(0.0)))


def metrics(rows: DataFrame) -> DataFrame:
    """(category, lang_mix, seed_count, recall, mrr) over all queries (both null), categories and languages, in one pass."""
    both = rows.select(F.explode(F.array(F.struct(F.lit("all").alias("by"), F.lit(None).cast("string").alias("category"), F.lit(None).cast("string").alias("lang_mix")), F.struct(F.lit("category").alias("by"), F.col("category"), F.lit(None).cast("string").alias("lang_mix")), F.struct(F.lit("lang").alias("by"), F.lit(None).cast("string").alias("category"), F.col("lang_mix")))).alias("g"), "recalled", "reciprocal_rank")
    grouped = both.groupBy("g.by", "g.category", "g.lang_mix").agg(F.count("*").alias("seed_count"), F.round(F.avg(F.col("recalled").cast("double")), 6).alias("recall"), F.round(F.avg("reciprocal_rank"), 6).alias("mrr"))
    return grouped


def totals(rows: DataFrame) -> DataFrame:
    """One row: seed_count, recall, mrr and whether they pass; no query at all gives zeros."""
    out = rows.agg(F.count("*").alias("seed_count"), F.round(F.coalesce(F.avg(F.col("recalled").cast("double")), F.lit(0.0)), 6).alias("recall"), F.round(F.coalesce(F.avg("reciprocal_rank"), F.lit(0.0)), 6).alias("mrr"))
    return out.withColumn("passed", (F.col("recall") >= THRESHOLDS["recall"]) & (F.col("mrr") >= THRESHOLDS["mrr"]))


def pairwise(points: DataFrame, tie: str = "chunk_id") -> DataFrame:
    """(a, b, similarity) of every two of a few stated points."""
    a = points.select(F.col(tie).alias("a"), F.col("vector").alias("va"))
    b = points.select(F.col(tie).alias("b"), F.col("vector").alias("vb"))
    return a.join(F.broadcast(b), F.col("a") < F.col("b")).select("a", "b", F.round(cosine(F.col("va"), F.col("vb")), 6).alias("similarity"))


def bias(targets: DataFrame, hits: DataFrame, pairs: DataFrame, share: float = 0.3, distance: float = 0.01) -> DataFrame:
    """One row: how often two or more targets stand together among a query's hits, their mean distance, and whether either tells a bias."""
    together = hits.groupBy("query_id").agg(F.collect_set("chunk_id").alias("ids")).join(F.broadcast(targets.agg(F.collect_set("chunk_id").alias("targets"))))
    rows = together.agg(F.round(F.avg((F.size(F.array_intersect("ids", "targets")) >= 2).cast("double")), 6).alias("co_occurrence"))
    mean = pairs.agg(F.round(F.avg(1 - F.col("similarity")), 6).alias("mean_distance"))
    return rows.join(F.broadcast(mean)).withColumn("biased", (F.col("co_occurrence") >= share) | (F.col("mean_distance") < distance))

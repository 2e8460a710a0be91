"""Checks of documents: distributions, percentiles, ids, expected counts, set comparisons, schema versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import nearest_rank, presence

# Versions of the document's schema.
OLD_VERSION, NEW_VERSION = "1.1.2", "1.2.0"


def latest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row, by order, of each key: how a dimension is built whose names may stand several times. One grouping, reduced before the shuffle."""
    found = rows.groupBy(*keys).agg(F.max_by(F.struct(*rows.columns), order).alias("row__"))
    return found.select("row__.*")


def earliest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row, by order, of each key."""
    found = rows.groupBy(*keys).agg(F.min_by(F.struct(*rows.columns), order).alias("row__"))
    return found.select("row__.*")


def distributions(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(name, value, n) of each column's values, nulls as a value of their own: one pass over the rows, one shuffle."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns)))
    return rows.select(pairs.alias("p")).groupBy("p.name", "p.value").agg(F.count("*").alias("n"))


def token_stats(rows: DataFrame, value: str = "token_estimate") -> DataFrame:
    """One row: count, min, max, mean (cut to a whole number), and p50, p95, p99 by nearest rank.

    The values are counted by value first, so what comes together is the distinct values with running counts, not the rows."""
    counts = rows.groupBy(F.col(value).cast("long").alias("v")).agg(F.count("*").alias("n")).where("v is not null")
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("count"), F.min("v").alias("min"), F.max("v").alias("max"), F.sum(F.col("v") * F.col("n")).alias("sum"))
    running = counts.withColumn("upto", F.sum("n").over(Window.orderBy("v")))  # a row for each distinct value
    at = lambda p: F.bround((F.col("count") - 1) * F.lit(float(p)) / 100.0).cast("long")
    pick = lambda p: F.coalesce(F.min(F.when(F.col("upto") > at(p), F.col("v"))), F.lit(0)).alias(f"p{p}")
    zero = lambda c: F.coalesce(F.first(c), F.lit(0)).alias(c)
    every = whole.join(running, F.lit(True), "left").groupBy("count").agg(zero("min"), zero("max"), F.coalesce(F.floor(F.first("sum") / F.greatest(F.first("count"), F.lit(1))), F.lit(0)).alias("mean"), pick(50), pick(95), pick(99))
    return every.select("count", "min", "max", "mean", "p50", "p95", "p99")


def suffixed(chunks: DataFrame) -> DataFrame:
    """(standard_id, n) of first parts whose id ends in their paragraph id and #source_idx."""
    ends = F.endswith("chunk_id", F.concat("paragraph_id", F.lit("#"), F.col("source_idx").cast("string")))
    return chunks.where(presence(F.col("paragraph_id")).isNotNull() & (F.col("chunk_index") == 0) & ends).groupBy("standard_id").agg(F.count("*").alias("n"))


def id_report(chunks: DataFrame) -> DataFrame:
    """One row: chunks, distinct ids, duplicated ids, parts of splits."""
    by = chunks.groupBy("chunk_id").agg(F.count("*").alias("n"), F.count(F.when(F.col("chunk_of") > 1, 1)).alias("s"))
    return by.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("chunks"), F.count("*").alias("distinct_ids"), F.count(F.when(F.col("n") > 1, 1)).alias("duplicate_count"), F.coalesce(F.sum("s"), F.lit(0)).alias("split_chunks"))


def expected_counts(documents: DataFrame, collection: Column) -> DataFrame:
    """(collection, expected): a point for each chunk and one for each document."""
    return documents.groupBy(collection.alias("collection")).agg((F.sum(F.size("chunks")) + F.count("*")).alias("expected"))


def compared(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(collection, expected, n, passed) of both sides' counts."""
    return expected.join(actual, "collection", "full").select("collection", F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("n", F.lit(0)).alias("n"), (F.coalesce("expected", F.lit(0)) == F.coalesce("n", F.lit(0))).alias("passed"))


def missing(wanted: DataFrame, there: DataFrame, key: str) -> DataFrame:
    """The keys that are wanted and not there."""
    return wanted.select(key).distinct().join(there.select(key), key, "left_anti")


def missing_fields(rows: DataFrame, expected: dict[str, str]) -> list[str]:
    """Names of columns that rows lack or have in another type than expected, in order: what a written table is checked for."""
    there = dict(rows.dtypes)
    return sorted(name for name, kind in expected.items() if there.get(name) != kind)


def missing_members(rows: DataFrame, expected: str, actual: str, out: str = "lacking") -> DataFrame:
    """rows with what an array of expected names has and an array of actual ones lacks, sorted; null counts as none."""
    none = F.array().cast("array<string>")
    return rows.withColumn(out, F.array_sort(F.array_except(F.coalesce(expected, none), F.coalesce(actual, none))))


def same_set(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_distinct(a)) == F.array_sort(F.array_distinct(b))


def migrated(documents: DataFrame) -> DataFrame:
    """documents (schema_version, chunks array<struct>) at the new version, with special_appendix_name behind appendix_index in each chunk; `outcome` tells what was done.

    Documents of the new version stay, so do those of any other, which are reported. Chunks that have the field keep it."""
    fields = documents.schema["chunks"].dataType.elementType.fieldNames()
    old = F.col("schema_version") == OLD_VERSION
    out = documents
    if "special_appendix_name" not in fields:

        def widened(c: Column) -> Column:
            parts = []
            for f in fields:
                parts.append(c[f].alias(f))
                if f == "appendix_index":
                    parts.append(F.lit(None).cast("string").alias("special_appendix_name"))
            return F.struct(*parts)

        out = out.withColumn("chunks", F.transform("chunks", widened))
    outcome = F.when(old, F.lit("migrated")).when(F.col("schema_version") == NEW_VERSION, F.lit("already")).otherwise(F.lit("unexpected"))
    return out.withColumn("outcome", outcome).withColumn("schema_version", F.when(old, F.lit(NEW_VERSION)).otherwise(F.col("schema_version")))


def percentile(values: Column, percent: float) -> Column:
    """The nearest-rank percentile of an array column."""
    return nearest_rank(F.array_sort(values), percent)

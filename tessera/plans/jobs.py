"""The engine's jobs: convert documents to Markdown, ingest Markdown to documents and points, evaluate retrieval."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import TokenCount, estimated_tokens
from tessera.model.profiles import COLLECTION_BY_STANDARD, DEFAULT_COLLECTION, PROFILES, collection_of
from tessera.operators import chunks as C
from tessera.operators import evaluate, search, validate
from tessera.operators import points as P
from tessera.operators.numbering import unknown_ratio
from tessera.operators.render import files, write_files
from tessera.operators.split import SOFT_LIMIT, split_oversized
from tessera.operators.structure import blocks
from tessera.operators.styles import with_styles
from tessera.sources import documents, markdown
from tessera.sources.docx import body_table_blocks, raw_blocks, read_docx


def structured(spark: SparkSession, path: str, family: str) -> DataFrame:
    """Structured blocks of the family's files below a path."""
    profile = PROFILES[family]
    styled = with_styles(read_docx(spark, path, descend=profile.descends), read_docx(spark, path, "styles"))
    raw = body_table_blocks(styled) if profile.body_table else raw_blocks(styled)
    return blocks(raw, read_docx(spark, path, "nums"), read_docx(spark, path, "levels"), profile)


def convert(spark: SparkSession, path: str, family: str, out: str, most_unknown: float = 0.05) -> DataFrame:
    """Files of Markdown below out. The share of unknown numbering is checked before anything is written; too large a share raises."""
    made = structured(spark, path, family)
    gate = unknown_ratio(made, most_unknown).first()
    if not gate["passed"]:
        sample = [r["text"] for r in made.where("kind = 'unknown_numbering'").orderBy("source_file", "idx").limit(3).collect()]
        raise ValueError(f"[UNKNOWN_NUMBERING] {gate['unknown']} of {gate['n']} blocks, such as {sample}")
    rendered = files(made, PROFILES[family])
    write_files(rendered, out)
    return rendered


def parsed(spark: SparkSession, folder: str, family: str, tokens: TokenCount = estimated_tokens, limit: int = SOFT_LIMIT) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(standards, chunks, links, summaries) of the family's Markdown files: assembled, without leaks, with unique ids, split under the limit."""
    profile = PROFILES[family]
    standards = markdown.standards(markdown.documents(markdown.read_markdown(spark, folder, family)))
    lines = markdown.lines(standards)
    raw = C.framework_rows(lines) if profile.table_rows else C.raw_chunks(lines)
    made = C.assembled(raw, profile, tokens)
    made = made.where(~C.leaks(F.col("kind"), F.col("section"), F.col("content_text")))
    made = C.unique(split_oversized(C.resolved_collisions(made), limit, tokens))
    return standards.drop("body", "file_name"), made, C.links(made), C.summaries(raw)


def ingest(
    spark: SparkSession, folder: str, family: str, store: P.PointStore | None = None, client: P.Client | None = None, cache: P.EmbeddingCache | None = None, dim: int = P.DIM,
    default_collection: str = DEFAULT_COLLECTION, batch: int = P.BATCH, dry_run: bool = False, prune: bool = True, told: list | None = None,
) -> DataFrame:
    """Documents of the family's Markdown files; with a store and a client also their points, embedded through the cache and merged, a collection at a time.

    Only texts that the cache lacks are sent, once: their vectors are written to the cache before points are made of it.
    Without a cache of the caller's there is one beside the store. A dry run fills the cache and writes no point. told, if given,
    gets a dict of counts for each collection."""
    standards, chunks, links, summaries = parsed(spark, folder, family)
    made = documents.nested(standards, chunks, links, summaries)
    if store is None or client is None:
        return made
    cache = cache or P.EmbeddingCache(spark, f"{store.root}/_embeddings")
    points = P.chunk_points(chunks, standards).unionByName(P.summary_points(standards, summaries)).persist()
    try:
        text = F.when(F.col("vector_role") == "summary", P.truncated(F.col("content_text"))).otherwise(F.col("content_text"))
        _, wanted = P.requested(points.select(F.lit("passage").alias("role"), text.alias("text")), cache.read())
        cache.add(P.embedded(wanted, client, dim, batch))
        if dry_run:
            return made
        vectors = P.with_vectors(points, cache.read()).withColumn("collection", collection_of(F.col("standard_id"), default_collection)).persist()
        for row in vectors.select("collection").distinct().collect():  # a few named collections
            counts = store.upsert(row["collection"], vectors.where(F.col("collection") == row["collection"]).drop("collection"), prune)
            if told is not None:
                told.append({"collection": row["collection"], **counts})
        vectors.unpersist()
    finally:
        points.unpersist()
    return made


def ingest_all(spark: SparkSession, folder: str, store: P.PointStore, client: P.Client, families: list[str] | None = None, out: str | None = None, **options) -> DataFrame:
    """Ingests families of a folder one after another, goes on where one fails, and gives a row for each: (family, points, drift, pruned, failed, reason, elapsed). out: a folder for the JSON documents."""
    rows = []
    for family in families or list(PROFILES):
        began, told, reason = time.time(), [], None
        try:
            made = ingest(spark, folder, family, store, client, told=told, **options)
            if out is not None:
                documents.write_documents(made, f"{out}/{family}")
        except Exception as e:  # one family's fault doesn't stop the others; it is told in the row
            reason = str(e).splitlines()[0][:300]
        total = lambda k: sum(t[k] for t in told)  # noqa: B023, E731
        rows.append((family, total("points"), total("drift"), total("pruned"), int(reason is not None), reason, round(time.time() - began, 3)))
    return spark.createDataFrame(rows, "family string, points long, drift long, pruned long, failed int, reason string, elapsed double")


def run_metrics(results: DataFrame) -> DataFrame:
    """One row of totals over runs (standard_id, points, failed, drift, pruned, elapsed)."""
    return results.agg(F.count("*").alias("standards"), F.sum("points").alias("points"), F.count(F.when(F.col("failed") > 0, 1)).alias("failed_standards"), F.sum("drift").alias("drift"), F.sum("pruned").alias("pruned"), F.round(F.sum("elapsed"), 3).alias("elapsed"))


#: Settings of an ingest that need its points to be written, with their defaults.
UPSERT_OPTIONS = {"collection": DEFAULT_COLLECTION, "batch_size": P.BATCH, "store": None, "client": None, "cache": None, "metrics_out": None, "dry_run": False, "prune_stale": False}


def check_options(upsert: bool, **options) -> None:
    """Raises where an option that only writing points uses is set without writing them, or isn't known."""
    unknown = sorted(set(options) - set(UPSERT_OPTIONS))
    if unknown:
        raise ValueError(f"[OPTION] unknown: {unknown}")
    used = [k for k, v in options.items() if v is not UPSERT_OPTIONS[k] and v != UPSERT_OPTIONS[k]]
    if not upsert and used:
        raise ValueError(f"[OPTION] upsert is required for: {', '.join(used)}")


def targets(spark: SparkSession, only: str | None = None) -> DataFrame:
    """(ordinal, standard_id, collection) of the families with one document, in their order; `only` names a standard or a collection."""
    rows = [(i, s, c) for i, (s, c) in enumerate(COLLECTION_BY_STANDARD.items()) if only in (None, s, c)]
    if not rows:
        raise ValueError(f"[TARGET] unknown: {only!r}; known: {sorted([*COLLECTION_BY_STANDARD, *COLLECTION_BY_STANDARD.values()])}")
    return spark.createDataFrame(rows, "ordinal int, standard_id string, collection string")


def skipped(files: DataFrame, made: DataFrame) -> DataFrame:
    """(standard_id) of files (file_name) that no document (standard.standard_id) was made of."""
    named = files.select(F.regexp_replace("file_name", r"\.md$", "").alias("standard_id"))
    return named.join(made.select(F.col("standard.standard_id").alias("standard_id")), "standard_id", "left_anti")


def write_metrics(row: DataFrame, path: str) -> None:
    """A one-row result as a JSON file in a folder, nulls written out."""
    row.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def embedded_queries(texts: DataFrame, client: P.Client, dim: int = P.DIM) -> DataFrame:
    """texts (query_id, query_text, ..) with query_vector, by the model for queries; equal texts are embedded once."""
    rows, wanted = P.requested(texts.withColumn("role", F.lit("query")).withColumn("text", F.col("query_text")), None)
    vectors = P.embedded(wanted, client, dim).select("cache_key", F.col("vector").alias("query_vector"))
    return rows.join(vectors, "cache_key").drop("cache_key", "role", "text", "model", "tiktoken_tokens")


def evaluate_golden(seeds: DataFrame, points: DataFrame, client: P.Client, dim: int = P.DIM, recall_k: int = 5, mrr_k: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(judged seeds, metrics by category and language, totals) of golden seeds over the passages of points."""
    asked = embedded_queries(seeds, client, dim)
    hits = search.search(asked.select("query_id", "query_vector"), points.where("vector_role = 'passage'"), max(recall_k, mrr_k))
    rows = evaluate.judged(evaluate.first_hits(seeds, hits), recall_k, mrr_k)
    return rows, evaluate.metrics(rows), evaluate.totals(rows)


def smoke(queries: DataFrame, points: DataFrame, client: P.Client, dim: int = P.DIM, n: int = 3, k: int = 5) -> tuple[DataFrame, DataFrame]:
    """The nearest summaries and passages of queries (query_id, query_text), as reports."""
    asked = embedded_queries(queries, client, dim).select("query_id", "query_vector")
    first, second = search.two_stage(asked, points.where("vector_role = 'summary'"), points.where("vector_role = 'passage'"), n, k)
    return search.shown(first), search.shown(second)


def answer(queries: DataFrame, points: DataFrame, client: P.Client, model: Callable[[str, str], str] | None = None, dim: int = P.DIM, n: int = 3, k: int = 5) -> list[dict]:
    """Context of each query from the nearest standards of all collections and their passages; with a model (question, context) also its answer.

    The queries are a user's few, so their contexts are brought to the driver, where the model is called."""
    asked = embedded_queries(queries, client, dim)
    vectors = asked.select("query_id", "query_vector")
    standards = search.across(vectors, points.where("vector_role = 'summary'"), n)
    wanted = standards.select("query_id", "standard_id", "collection").distinct()
    # collections share no standards, so a standard's passages are its collection's
    near = search.nearest(vectors, points.where("vector_role = 'passage'"), k, "standard_id", wanted)
    passages = search.reranked(search.top(near, ["query_id", "standard_id"], k).drop("rank"))
    rows = search.context(asked.select("query_id", "query_text"), standards, passages).join(asked.select("query_id", "query_text"), "query_id")
    return [{"query_id": r["query_id"], "context": r["context"], "answer": model(r["query_text"], r["context"]) if model else None} for r in rows.collect()]


def service_answer(url: str, key: str | None = None, model: str = "answer", system: str = "") -> Callable[[str, str], str]:
    """A model for answer() behind a chat service: POST {model, messages} gives {choices: [{message: {content}}]}."""

    def call(question: str, context: str) -> str:
        messages = ([{"role": "system", "content": system}] if system else []) + [{"role": "user", "content": f"{context}\n\n{question}"}]
        return P.posted(url, key, {"model": model, "messages": messages})["choices"][0]["message"]["content"]

    return call


def migrate(spark: SparkSession, folder: str, out: str) -> DataFrame:
    """JSON documents of a folder at the schema's new version, written to out; (file's standard, outcome) of each."""
    made = validate.migrated(documents.read_documents(spark, folder)).persist()
    documents.write_documents(made.drop("outcome"), out)
    return made.select(F.col("standard.standard_id").alias("standard_id"), "outcome")

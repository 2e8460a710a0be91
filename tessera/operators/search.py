"""Nearest neighbours by cosine, in one or two stages, for all queries at once, and context for a language model."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tessera.functions.columns import cosine

#: Queries of one block, about; a block is broadcast.
MAX_QUERIES = 10_000
#: Bytes of the vectors of a block of queries.
BLOCK_BYTES = 32 << 20
#: Scores that a task makes at once; scores that it remembers, k for each query and group; hits of one batch of output, about.
TILE_SCORES, FLOOR_SCORES, OUT_ROWS = 1 << 20, 4 << 20, 20_000
CONTEXT_CHARS, PASSAGE_CHARS = 12_000, 1_200


def scored(queries: DataFrame, points: DataFrame) -> DataFrame:
    """Every query (query_id, query_vector) with every point (vector, ..) and their cosine, as score, to six places.

    The queries are a stated set; they are counted and broadcast in blocks of at most about MAX_QUERIES, and each block is
    held against the points as these are read, so that nothing but best hits is ever shuffled by top()."""
    blocks = max(1, -(-queries.count() // MAX_QUERIES))
    out = None
    for k in range(blocks):
        block = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == k)
        held = block.groupBy().agg(F.collect_list(F.struct("query_id", "query_vector")).alias("queries"))
        each = points.join(F.broadcast(held)).select("*", F.explode("queries").alias("q")).drop("queries")
        part = each.select(F.col("q.query_id").alias("query_id"), *points.columns, F.round(cosine(F.col("q.query_vector"), F.col("vector")), 6).alias("score"))
        out = part if out is None else out.unionByName(part)
    return out


def top(hits: DataFrame, keys: list[str], k: int, tie: str = "chunk_id", score: str = "score") -> DataFrame:
    """The k best hits of each group with rank, by score and then by id. Spark limits groups before the shuffle too."""
    w = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(tie))
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def nearest(queries: DataFrame, points: DataFrame, k: int, by: str | None = None, allowed: DataFrame | None = None, tie: str = "chunk_id") -> DataFrame:
    """Rows of points, without their vectors, with query_id and score, that hold every query's k best by score and then by tie: candidates for top().

    by: a column of points, of whose values each has its own k best; allowed: (query_id, by), the values that a query
    looks at. Each Arrow batch of points is multiplied with TILE_SCORES / its rows queries at a time, and only what is among
    the k best of the batch, and not under the k best of the task so far, leaves the task. A block's vectors are bounded by BLOCK_BYTES."""
    kind = queries.schema["query_id"].dataType
    at, width = points.columns.index("vector"), queries.agg(F.max(F.size("query_vector")).alias("d"), F.count("*").alias("n")).first()
    size = max(1, BLOCK_BYTES // (8 * max(1, width["d"] or 1)))
    blocks = max(1, -(-width["n"] // size))
    kept = [i for i, c in enumerate(points.columns) if i != at]
    schema = StructType([StructField("query_id", kind), *(points.schema.fields[i] for i in kept), StructField("score", DoubleType())])
    group_at, tie_at = None if by is None else points.columns.index(by), points.columns.index(tie) if tie in points.columns else None
    out = None
    for number in range(blocks):
        mine = lambda df: df if blocks == 1 else df.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == number)  # noqa: B023, E731
        rows = mine(queries).select("query_id", F.col("query_vector").cast("array<double>").alias("v")).toArrow()  # a block
        if not rows.num_rows:
            continue
        ids = rows.column(0).combine_chunks()
        q = rows.column(1).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
        looks: dict | None = None
        if allowed is not None:
            place, looks = {x: i for i, x in enumerate(ids.to_pylist())}, {}
            for r in mine(allowed).select("query_id", by).distinct().collect():  # a few for each query of a block
                looks.setdefault(r[by], []).append(place[r["query_id"]])
        shipped = queries.sparkSession.sparkContext.broadcast((ids, q, looks))

        def run(batches, shipped=shipped):
            names, q, looks = shipped.value
            norm = np.linalg.norm(q, axis=1)
            q = np.divide(q, norm[:, None], out=np.zeros_like(q), where=norm[:, None] > 0)
            floors: dict = {}  # the k best scores so far of each query, by group: what is under them can't be a hit
            for batch in batches:
                if not batch.num_rows:
                    continue
                order = np.arange(batch.num_rows) if tie_at is None else pc.array_sort_indices(batch.column(tie_at)).to_numpy()
                if tie_at is not None and (nulls := batch.column(tie_at).null_count):  # Spark sorts them first
                    order = np.roll(order, nulls)
                p = batch.column(at).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)[order].astype(np.float64)
                length = np.linalg.norm(p, axis=1)
                np.divide(p, length[:, None], out=p, where=length[:, None] > 0)
                rest = batch.select(kept)
                if sum(x.size for x in floors.values()) > FLOOR_SCORES:
                    floors.clear()
                groups: dict = {None: order}
                if group_at is not None:
                    values, groups = batch.column(group_at).to_pylist(), {}
                    for i, at_row in enumerate(order.tolist()):
                        groups.setdefault(values[at_row], []).append(i)
                found: list = []
                for value, members in groups.items():
                    asked = np.arange(len(q)) if looks is None else np.array(looks.get(value, []), np.int64)
                    if not len(asked):
                        continue
                    if group_at is None:
                        held, rows_at = p, order
                    else:
                        held, rows_at = p[members], order[members]
                    if value not in floors:
                        floors[value] = np.full((len(asked), k), -np.inf)
                    step = max(1, TILE_SCORES // len(held))
                    for start in range(0, len(asked), step):
                        some = asked[start : start + step]
                        query, point, s = best(q[some] @ held.T, floors[value][start : start + step], k)
                        found.append((some[query], rows_at[point], s))
                        if sum(len(x[2]) for x in found) >= OUT_ROWS:
                            yield made(names, rest, found, schema)
                            found = []
                if found:
                    yield made(names, rest, found, schema)

        part = points.where(F.col("vector").isNotNull()).mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else scored(queries, points).drop("vector")


def best(scores: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, score to six places) of the k best of each row of scores, equal ones by their place, that aren't under the row of floor, which gets them."""
    low = floor.min(axis=1)
    near = scores >= low[:, None] - 1e-6  # before rounding
    if np.count_nonzero(near) > 4 * k * len(scores) and scores.shape[1] > k:
        near &= scores >= np.partition(scores, -k, axis=1)[:, -k, None] - 1e-6
    query, point = np.nonzero(near)
    s = np.round(scores[query, point], 6)
    ranked = np.lexsort((point, -s, query))
    query, point, s = query[ranked], point[ranked], s[ranked]
    place = np.arange(len(query)) - np.searchsorted(query, query)
    taken = (place < k) & (s >= low[query])
    query, point, s, place = query[taken], point[taken], s[taken], place[taken]
    rows = np.unique(query)
    fresh = np.full((len(scores), k), -np.inf)
    fresh[query, place] = s
    floor[rows] = np.sort(np.concatenate([floor[rows], fresh[rows]], axis=1), axis=1)[:, -k:]
    return query, point, s


def made(names: pa.Array, rest: pa.RecordBatch, found: list, schema: StructType) -> pa.RecordBatch:
    """Hits (query, point, score) as a batch of the schema."""
    query, point, s = (np.concatenate(x) for x in zip(*found, strict=True))
    return pa.RecordBatch.from_arrays([names.take(pa.array(query)), *rest.take(pa.array(point)).columns, pa.array(s)], names=schema.fieldNames())


def search(queries: DataFrame, points: DataFrame, k: int, where: Column | None = None, tie: str = "chunk_id") -> DataFrame:
    """The k nearest points of each query; where filters points before anything is compared."""
    return top(nearest(queries, points if where is None else points.where(where), k, tie=tie), ["query_id"], k, tie)


def two_stage(queries: DataFrame, summaries: DataFrame, passages: DataFrame, n: int = 3, k: int = 5, per_standard: bool = False, tie: str = "chunk_id") -> tuple[DataFrame, DataFrame]:
    """The n nearest summaries of each query, and the k nearest passages of their standards: together, or of each standard."""
    first = search(queries, summaries, n, tie=tie)
    wanted = first.groupBy("query_id", "standard_id").agg(F.min("rank").alias("standard_rank"))
    second = nearest(queries, passages, k, "standard_id", wanted, tie)
    return first, top(second, ["query_id", "standard_id"] if per_standard else ["query_id"], k, tie)


def across(queries: DataFrame, points: DataFrame, n: int, tie: str = "chunk_id") -> DataFrame:
    """The n nearest of each collection, then the n nearest of those of all collections."""
    each = top(nearest(queries, points, n, "collection", tie=tie), ["query_id", "collection"], n, tie).drop("rank")
    return top(each, ["query_id"], n, tie)


def reranked(hits: DataFrame, tie: str = "chunk_id") -> DataFrame:
    """Hits of several groups of a query with one rank over all."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc(tie))
    return hits.withColumn("rank", F.row_number().over(w))


def shown(hits: DataFrame, chars: int = 180, places: int = 6) -> DataFrame:
    """Hits as a report: rank, rounded score, and the beginning of the text in one line."""
    return hits.select("query_id", "rank", F.round("score", places).alias("score"), "chunk_id", "standard_id", "kind", "section", F.array_join("heading_trail", " > ").alias("heading"), F.translate(F.substring("content_text", 1, chars), "\n", " ").alias("content_preview"))


def context(queries: DataFrame, standards: DataFrame, passages: DataFrame, max_chars: int = CONTEXT_CHARS, passage_chars: int = PASSAGE_CHARS) -> DataFrame:
    """(query_id, context): a text with a query's standards and passages in order of rank, each passage and the whole within limits."""
    four = lambda c: F.format_number(c, 4)  # noqa: E731  # rounds the exact value, half to even
    preview = F.translate(F.substring("content_text", 1, 500), "\n", " ")
    head = F.concat(F.lit("- score="), four(F.col("score")), F.lit(" standard_id="), "standard_id", F.lit(" collection="), "collection")
    s_text = F.when(preview != "", F.concat(head, F.lit("\n  summary: "), preview)).otherwise(head)
    named = lambda name, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{name}="), c))
    meta = F.concat_ws("; ", F.concat(F.lit("score="), four(F.col("score"))), F.concat(F.lit("standard_id="), "standard_id"), F.concat(F.lit("kind="), "kind"), named("section", F.col("section")), named("paragraph_id", F.col("paragraph_id")), named("special_appendix_name", F.col("special_appendix_name")))
    trail = F.array_join(F.filter("heading_trail", lambda h: h != ""), " > ")
    p_text = F.concat_ws("\n", F.concat(F.lit("\n### ["), "chunk_id", F.lit("]")), meta, F.when(trail != "", F.concat(F.lit("heading: "), trail)), F.substring("content_text", 1, passage_chars))
    gather = lambda df, text, out: df.groupBy("query_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", text.alias("t")))), lambda x: x["t"]), "\n").alias(out))
    rows = queries.select("query_id", "query_text").join(gather(standards, s_text, "s"), "query_id", "left").join(gather(passages, p_text, "p"), "query_id", "left")
    whole = F.concat_ws("\n", F.lit("# Audit Standards RAG Context"), F.concat(F.lit("사용자 질문: "), "query_text"), F.lit(""), F.lit("## 1. 기준서 후보"), F.col("s"), F.lit(""), F.lit("## 2. 검색된 근거 문단"), F.col("p"))
    cut = F.when(F.length(whole) > max_chars, F.concat(F.substring(whole, 1, max_chars), F.lit("\n\n[TRUNCATED]"))).otherwise(whole)
    return rows.select("query_id", cut.alias("context"))

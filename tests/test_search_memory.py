"""What a task of a search holds and sends: tiles of scores, and the k best of a batch."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.operators import search

DIM = 8


class Points:
    """In place of points: keeps the function that a task would run."""

    def __init__(self, df):
        self.columns, self.schema = df.columns, df.schema

    def where(self, _):
        return self

    def mapInArrow(self, run, schema):  # noqa: N802
        self.run = run
        return self


def vectors(spark, n, name):
    made = F.transform(F.sequence(F.lit(1), F.lit(DIM)), lambda i: F.sin(F.col("id") * (i + 0.37)).cast("float"))
    return spark.range(n).select(F.col("id").alias("query_id" if name == "query_vector" else "chunk_id"), (F.col("id") % 4).alias("collection"), made.alias(name))


#: k and the grouping of a query.
SEARCHES = {"retrieval_eval_grouped": (11, None), "context_builder": (5, None), "knn_topk": (5, None), "knn_filtered_topk": (6, None)}


@pytest.mark.parametrize("name", sorted(SEARCHES))
def test_a_task_holds_tiles_of_scores(spark, name):
    k, by = SEARCHES[name]
    points = Points(vectors(spark, 1, "vector"))
    search.nearest(vectors(spark, 3000, "query_vector").select("query_id", "query_vector"), points, k, by)
    ids = np.arange(8000)
    v = pa.FixedSizeListArray.from_arrays(pa.array(np.sin(ids[:, None] * (np.arange(DIM) + 1.37)).astype(np.float32).reshape(-1)), DIM).cast(pa.list_(pa.float32()))
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids % 4), v], names=["chunk_id", "collection", "vector"])
    tracemalloc.start()
    rows = sum(b.num_rows for b in points.run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 3000 * k * (4 if by else 1) and peak < 100e6  # all scores are 192 MB, and were held several times over


def test_equal_scores_leave_the_task_k_times(spark):
    same = spark.range(4000).select(F.format_string("c%05d", 4000 - F.col("id")).alias("chunk_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("vector")).coalesce(1)
    asked = spark.range(3).select(F.col("id").alias("query_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("query_vector"))
    near = search.nearest(asked, same, 5)
    assert near.count() == 15
    assert sorted(r[0] for r in search.top(near, ["query_id"], 5).where("query_id = 1").select("chunk_id").collect()) == [f"c{i:05d}" for i in range(1, 6)]


def test_tiles_and_batches_give_all_hits(spark, monkeypatch):
    monkeypatch.setattr(search, "TILE_SCORES", 50)
    points, asked = vectors(spark, 700, "vector").repartition(3), vectors(spark, 40, "query_vector").select("query_id", "query_vector")
    points = points.withColumn("vector", F.when(F.col("chunk_id") % 5 == 0, F.array(*[F.lit(1.0).cast("float")] * DIM)).otherwise(F.col("vector")))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "60")
    try:
        rows = lambda df: sorted(map(tuple, df.select("query_id", "collection", "chunk_id", "score", "rank").collect()))
        every = search.scored(asked, points).drop("vector")
        assert rows(search.search(asked, points, 7)) == rows(search.top(every, ["query_id"], 7))
        assert rows(search.top(search.nearest(asked, points, 3, "collection"), ["query_id", "collection"], 3)) == rows(search.top(every, ["query_id", "collection"], 3))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")

"""Continuous ingest: each micro-batch of changed points is merged into the store by id, so a repeated batch changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.points import PointStore, one_each


def merge_stream(points: DataFrame, store: PointStore, collection: str, checkpoint: str, prune: bool = False) -> StreamingQuery:
    """Starts merging a stream of points, all that is there now, into a collection."""

    def merge(batch: DataFrame, epoch: int) -> None:
        batch = one_each(batch, "point_id").persist()
        try:
            if not batch.isEmpty():
                store.upsert(collection, batch, prune)
        finally:
            batch.unpersist()

    return points.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def deduplicated(points: DataFrame, at: str, late: str = "10 minutes") -> DataFrame:
    """A stream's first row of each id within the watermark."""
    return points.withWatermark(at, late).dropDuplicatesWithinWatermark(["point_id"])

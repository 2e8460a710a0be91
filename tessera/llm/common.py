"""What the operators of this subpackage share: reading tables, cutting lineage in the shared folder, ASCII case folding."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import gc
import string
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where it is unset (a session without a cluster), the warehouse, which they share too."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return found or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


class Scratch:
    """Tables written to the shared folder to cut lineage; drop() deletes those that no plan reads any more, and all go when the driver's Python ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.key, self.tables = f"{name}_{uuid.uuid4().hex}", []
        self.spark, self.root, self.made = spark, f"{shared_dir(spark)}/tessera/{self.key}", 0
        atexit.register(self._clean)

    def cut(self, df: DataFrame) -> DataFrame:
        """df as written and read again: a lost executor costs a reread, not a recomputation."""
        path = f"{self.root}/{self.made}"
        self.made += 1
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, key: str, buckets: int) -> DataFrame:
        """df as written, in buckets by a hash of key, and read again: joins by key with what is partitioned alike don't shuffle it."""
        path, name = f"{self.root}/{self.made}", f"tessera_{self.key}_{self.made}"
        self.made += 1
        self.tables.append(name)
        df.write.bucketBy(buckets, key).format("parquet").option("path", path).saveAsTable(name)
        return self.spark.table(name)

    def drop(self, *numbers: int) -> None:
        for n in numbers:
            self._delete(f"{self.root}/{n}")

    def _delete(self, name: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def _clean(self) -> None:
        with contextlib.suppress(Exception):  # the session may have ended before
            for name in self.tables:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self._delete(self.root)


def fold(text: Column) -> Column:
    """A-Z lower-cased, all else as it is. Where every character is ASCII, lower() does the same and is faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of doc_id as text, modulo n: the folds of the contracts. A null doc_id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def sampled(df: DataFrame, key: Column, bound: int) -> DataFrame:
    """At most about bound rows (three standard deviations over it at most), chosen by a hash of key; all rows of a smaller df.

    For fitting classifiers only. The number of rows is counted once."""
    n = df.count()
    if n <= bound:
        return df
    return df.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < int(bound / n * (1 << 30)))


#: Bytes of a side that may be broadcast, once they have been measured.
BROADCAST_BYTES = 64 << 20


def measured(df: DataFrame) -> int:
    """About the bytes of df's rows in memory: 16 for each value, 8 for each element of an array, and the bytes of its text."""
    size = F.lit(16 * len(df.columns)).cast("long")
    for f in df.schema:
        kind = f.dataType.simpleString()
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif kind == "array<string>":
            size = size + F.coalesce(F.octet_length(F.array_join(f.name, "........")), F.lit(0))
        elif kind.startswith("array"):
            size = size + 8 * F.greatest(F.size(f.name), F.lit(0))
    return int(df.agg(F.sum(size)).first()[0] or 0)


def small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """df, marked for broadcast if its rows were measured to have at most that many bytes; else as it is, for a shuffled join with the same rows. df is read once more: a written table."""
    return F.broadcast(df) if measured(df) <= most else df


#: Bytes of an Arrow batch that goes to a Python worker, and the setting's default, which is replaced.
BATCH_BYTES, BATCH_KEY, BATCH_DEFAULT = "4m", "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def small_batches(spark: SparkSession) -> None:
    """Bounds what a Python worker and its Arrow buffers hold of a text column, unless the session has its own bound."""
    if spark.conf.get(BATCH_KEY) in (BATCH_DEFAULT, "64m", "64MB"):
        spark.conf.set(BATCH_KEY, BATCH_BYTES)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, a function of a task's batches, giving the memory that it has freed back to the system at its end.

    Python workers are kept for later tasks, of other operators too; what one has grown to would add to what the next needs."""

    @functools.wraps(run)
    def inner(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(AttributeError, OSError):  # where the C library has it
                ctypes.CDLL(None).malloc_trim(0)

    return inner

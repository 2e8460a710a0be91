"""The point store: embeddings through a cache, points with payloads, merging, drift and pruning.

Tables are Parquet, partitioned by what queries filter on. A collection is a row of segments: a write adds one, which holds
all points of the standards that it touches, and takes effect with the marker of its list of standards; so a writer that
dies leaves what was there, and what isn't touched isn't rewritten. There is one writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from urllib import error, request

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.columns import TokenCount, cache_key, content_hash, estimated_tokens, utc_now, uuid5
from tessera.operators.chunks import summary_text

DIM, BATCH, HARD_LIMIT, SUMMARY_LIMIT = 4096, 32, 4000, 3950
SUMMARY_KIND = "standard_summary"
CACHE_SCHEMA = "cache_key string, role string, model string, vector array<float>, tiktoken_tokens int, solar_tokens int, embedded_at string, embedded_sha1 string"
#: Texts to vectors and, if the service tells, the tokens of the whole call.
Client = Callable[[list[str], str], tuple[list[list[float]], int | None]]


class AuthError(RuntimeError):
    """A service refuses the credentials; calls aren't repeated."""


def model_for(role: Column) -> Column:
    return F.when(role == "passage", "embedding-passage").otherwise("embedding-query")


def hash_client(dim: int = DIM) -> Client:
    """A client that needs no service: pseudo-random vectors of length one, by the text's hash."""

    def call(texts: list[str], model: str) -> tuple[list[list[float]], int | None]:
        import hashlib

        import numpy as np

        out = []
        for text in texts:
            v = np.random.default_rng(int.from_bytes(hashlib.sha256(f"{model}:{text}".encode()).digest()[:8], "big")).standard_normal(dim)
            out.append((v / np.linalg.norm(v)).astype(np.float32).tolist())
        return out, None

    return call


def posted(url: str, key: str | None, body: dict, timeout: float = 60.0) -> dict:
    """A JSON service's answer; refused credentials raise AuthError."""
    head = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {key}"} if key else {})
    try:
        with request.urlopen(request.Request(url, json.dumps(body).encode(), head), timeout=timeout) as answer:
            return json.load(answer)
    except error.HTTPError as e:
        if e.code in (401, 403):
            raise AuthError(f"[AUTH] {e.code} from {url}") from e
        raise


def service_client(url: str, key: str | None = None, timeout: float = 60.0) -> Client:
    """A client of an embedding service: POST {model, input: texts} gives {data: [{index, embedding}], usage: {total_tokens}}."""

    def call(texts: list[str], model: str) -> tuple[list[list[float]], int | None]:
        answer = posted(url, key, {"model": model, "input": texts}, timeout)
        rows = sorted(answer["data"], key=lambda r: r["index"])
        return [r["embedding"] for r in rows], (answer.get("usage") or {}).get("total_tokens")

    return call


def requested(texts: DataFrame, cache: DataFrame | None, tokens: TokenCount = estimated_tokens, limit: int = HARD_LIMIT) -> tuple[DataFrame, DataFrame]:
    """texts (role, text, ..) with model, cache_key and tiktoken_tokens; and the distinct ones that the cache lacks. A text over the limit raises."""
    n = tokens(F.col("text"))
    told = F.concat(F.lit("[OVERFLOW] tokens: "), n.cast("string"))
    rows = texts.withColumn("model", model_for(F.col("role"))).withColumn("tiktoken_tokens", F.when(n <= limit, n).otherwise(F.raise_error(told).cast("int")))
    rows = rows.withColumn("cache_key", cache_key(F.col("model"), F.col("role"), F.col("text")))
    wanted = rows.select("cache_key", "role", "model", "text", "tiktoken_tokens").dropDuplicates(["cache_key"])
    return rows, wanted if cache is None else wanted.join(cache.select("cache_key"), "cache_key", "left_anti")


def embedded(wanted: DataFrame, client: Client, dim: int = DIM, batch: int = BATCH, tries: int = 3, wait: float = 1.0) -> DataFrame:
    """Cache rows of the texts that are wanted, in calls of at most batch texts of a model.

    A call that fails is tried again after 1, 2, .. times wait seconds, refused credentials aren't; a vector of another
    length raises. A call's token total is dealt out by the texts' own estimates, rounded half to even."""
    now = utc_now()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import time

        for b in batches:
            rows = b.to_pylist()
            for model in sorted({r["model"] for r in rows}):
                same = [r for r in rows if r["model"] == model]
                for at in range(0, len(same), batch):
                    part = same[at : at + batch]
                    for k in range(tries):
                        try:
                            vectors, total = client([r["text"] for r in part], model)
                            break
                        except AuthError:
                            raise
                        except Exception:
                            if k + 1 == tries:
                                raise
                            time.sleep(wait * 2**k)
                    bad = [len(v) for v in vectors if len(v) != dim]
                    if bad or len(vectors) != len(part):
                        raise ValueError(f"[DIM] vectors of {bad or len(vectors)}, not {dim}")
                    whole = sum(r["tiktoken_tokens"] for r in part)
                    dealt = [None if total is None or not whole else round(total * r["tiktoken_tokens"] / whole) for r in part]
                    columns = [pa.array([r[c] for r in part], pa.string()) for c in ("cache_key", "role", "model", "text")]
                    columns += [pa.array(vectors, pa.list_(pa.float32())), pa.array([r["tiktoken_tokens"] for r in part], pa.int32()), pa.array(dealt, pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, names=["cache_key", "role", "model", "text", "vector", "tiktoken_tokens", "solar_tokens"])

    made = wanted.select("cache_key", "role", "model", "text", "tiktoken_tokens").mapInArrow(run, "cache_key string, role string, model string, text string, vector array<float>, tiktoken_tokens int, solar_tokens int")
    return made.select("cache_key", "role", "model", "vector", "tiktoken_tokens", "solar_tokens", now.alias("embedded_at"), content_hash(F.col("text")).alias("embedded_sha1"))


def upserted(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old with the rows of new in place of those of equal key. A key that new has twice keeps one row, the greatest."""
    last = new.groupBy(key).agg(F.max(F.struct(*[c for c in new.columns if c != key])).alias("r")).select(key, "r.*") if _orderable(new) else new.dropDuplicates([key])
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(last.select(*new.columns))


def _orderable(df: DataFrame) -> bool:
    return not any("map<" in t for _, t in df.dtypes)


def embed_stats(calls: DataFrame) -> DataFrame:
    """One row of totals over calls (cached boolean, tiktoken_tokens, solar_tokens): cached ones count as hits alone."""
    fresh = F.when(~F.col("cached"), F.col("tiktoken_tokens"))
    solar = F.when(~F.col("cached"), F.col("solar_tokens"))
    ratio = F.when(fresh > 0, solar / fresh)
    sums = calls.agg(
        F.count(F.when(F.col("cached"), 1)).alias("cached_hits"), F.coalesce(F.sum(fresh), F.lit(0)).alias("total_tiktoken_tokens"), F.coalesce(F.sum(solar), F.lit(0)).alias("total_solar_tokens"),
        F.count(solar).alias("solar_samples"), F.coalesce(F.max(F.abs(solar - fresh)), F.lit(0)).alias("max_abs_gap"), F.round(F.coalesce(F.max(ratio), F.lit(0.0)), 6).alias("max_ratio"),
    )
    return sums.withColumn("mean_ratio", F.round(F.when(F.col("total_tiktoken_tokens") > 0, F.col("total_solar_tokens") / F.col("total_tiktoken_tokens")).otherwise(F.lit(0.0)), 6))


def prorated(items: DataFrame, keys: list[str], total: str, share: str, out: str) -> DataFrame:
    """items with a batch's total dealt out by each one's share, rounded half to even."""
    whole = F.sum(share).over(Window.partitionBy(*keys))
    return items.withColumn(out, F.when(whole > 0, F.bround(F.col(total) * F.col(share) / whole)).cast("long"))


def packed_vector(vector: Column) -> Column:
    """A vector as float32, the store's type."""
    return vector.cast("array<float>")


def checked_dim(vector: Column, dim: int = DIM) -> Column:
    v = packed_vector(vector)
    return F.when(F.size(v) == dim, v).otherwise(F.raise_error(F.concat(F.lit("[DIM] length "), F.size(v).cast("string"))).cast("array<float>"))


def truncated(text: Column, limit: int = SUMMARY_LIMIT, tokens: TokenCount = estimated_tokens) -> Column:
    """A text cut to a number of tokens by its density of them, for embedding only."""
    n = tokens(text)
    return F.when(n <= limit, text).otherwise(F.substring(text, F.lit(1), F.floor(F.length(text) * F.lit(limit) / n).cast("int")))


STANDARD = ["standard_id", "standard_no", "source_file", "authority_base"]


def chunk_points(chunks: DataFrame, standards: DataFrame) -> DataFrame:
    """Payloads of chunks, with point_id and vector_role `passage`."""
    std = standards.select(*STANDARD)
    return chunks.join(std, "standard_id").select(
        uuid5(F.col("chunk_id")).alias("point_id"), F.lit("passage").alias("vector_role"), *STANDARD, "chunk_id", "paragraph_id", "kind", "section", "appendix_index", "heading_trail", "heading_trail_hash",
        "parent_paragraph_id", "is_application_guidance", "authority", "token_estimate", "chunk_index", "chunk_of", "source_idx", "special_appendix_name", "part_of", "content_text", "content_markdown",
        "table_cells", "embedded_at", "embedding_model", content_hash(F.col("content_text")).alias("content_text_hash"),
    )


def summary_points(standards: DataFrame, summaries: DataFrame) -> DataFrame:
    """Payloads of standards' summaries, one each, with vector_role `summary`; a standard without a summary has its name."""
    text = summary_text(F.col("standard_id"), F.col("standard_title"), F.col("scope_text"), F.col("definitions_text"))
    rows = standards.join(summaries.select("standard_id", "scope_text", "definitions_text"), "standard_id", "left").withColumn("content_text", text).withColumn("chunk_id", F.concat("standard_id", F.lit(":summary")))
    none = lambda t, c: F.lit(None).cast(t).alias(c)
    return rows.select(
        uuid5(F.col("chunk_id")).alias("point_id"), F.lit("summary").alias("vector_role"), *STANDARD, "chunk_id", none("string", "paragraph_id"), F.lit(SUMMARY_KIND).alias("kind"), none("string", "section"),
        none("int", "appendix_index"), F.array().cast("array<string>").alias("heading_trail"), F.substring(F.sha1(F.concat(F.lit("summary:"), "standard_id").cast("binary")), 1, 8).alias("heading_trail_hash"),
        none("string", "parent_paragraph_id"), F.lit(False).alias("is_application_guidance"), F.col("authority_base").alias("authority"), F.lit(0).alias("token_estimate"), F.lit(0).alias("chunk_index"),
        F.lit(1).alias("chunk_of"), F.lit(-1).alias("source_idx"), none("string", "special_appendix_name"), none("string", "part_of"), "content_text", F.col("content_text").alias("content_markdown"),
        none("array<array<string>>", "table_cells"), none("string", "embedded_at"), none("string", "embedding_model"), content_hash(F.col("content_text")).alias("content_text_hash"),
    )


def with_vectors(points: DataFrame, cache: DataFrame) -> DataFrame:
    """points with their vectors, by cache key, never by position; a point whose text isn't cached raises."""
    text = F.when(F.col("vector_role") == "summary", truncated(F.col("content_text"))).otherwise(F.col("content_text"))
    model = F.lit("embedding-passage")
    rows = points.withColumn("key__", cache_key(model, F.lit("passage"), text))
    got = cache.select(F.col("cache_key").alias("key__"), "vector", F.col("embedded_at").alias("at__"), F.col("model").alias("model__"))
    rows = rows.join(got, "key__", "left")
    vector = F.when(F.col("vector").isNotNull(), F.col("vector")).otherwise(F.raise_error(F.concat(F.lit("[EMBEDDING] none for "), "chunk_id")).cast("array<float>"))
    return rows.withColumn("vector", vector).withColumn("embedded_at", F.col("at__")).withColumn("embedding_model", F.col("model__")).drop("key__", "at__", "model__")


def drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """(point_id, chunk_id, old_hash, new_hash) of points whose content changed; where a hash is missing nothing is told."""
    o = old.select("point_id", F.col("content_text_hash").alias("old_hash"))
    return new.select("point_id", "chunk_id", F.col("content_text_hash").alias("new_hash")).join(o, "point_id").where("old_hash <> new_hash").select("point_id", "chunk_id", "old_hash", "new_hash")


def stale(old: DataFrame, new: DataFrame) -> DataFrame:
    """The points of new's standards that new lacks."""
    of = old.join(new.select("standard_id").distinct(), "standard_id", "left_semi")
    return of.join(new.select("point_id"), "point_id", "left_anti")


def merged(old: DataFrame, new: DataFrame, prune: bool = True) -> DataFrame:
    """old with new's points in place of those of equal id and, if asked for, without the stale ones."""
    kept = old.join(new.select("point_id"), "point_id", "left_anti")
    if prune:
        kept = kept.join(new.select("standard_id").distinct(), "standard_id", "left_anti")
    return kept.unionByName(one_each(new, "point_id"), allowMissingColumns=True)


def one_each(rows: DataFrame, key: str) -> DataFrame:
    """A row for each key: of several the greatest by all columns that have an order, so that a repeated run takes the same."""
    if not _orderable(rows):
        return rows.dropDuplicates([key])
    return rows.groupBy(key).agg(F.max(F.struct(*[c for c in rows.columns if c != key])).alias("row__")).select(key, "row__.*").select(*rows.columns)


class PointStore:
    """Collections of points below a root: COLLECTION/seg-N/points, partitioned by standard, and COLLECTION/seg-N/standards, the standards that the segment holds whole.

    A segment is there once its list of standards is. A standard's points are those of its last segment."""

    #: Segments above which a write rewrites all into one.
    SEGMENTS = 20

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, collection: str) -> str:
        return f"{self.root}/{collection}"

    def segments(self, collection: str) -> list[int]:
        here, fs = self._fs(self.path(collection))
        if not fs.exists(here):
            return []
        names = [x.getPath().getName() for x in fs.listStatus(here)]
        return sorted(int(n[4:]) for n in names if n.startswith("seg-") and fs.exists(self._fs(f"{self.path(collection)}/{n}/standards/_SUCCESS")[0]))

    def exists(self, collection: str) -> bool:
        return bool(self.segments(collection))

    def ensure(self, collection: str, schema) -> None:
        """An empty collection, unless it is there."""
        if not self.exists(collection):
            self._add(collection, self.spark.createDataFrame([], schema), self.spark.createDataFrame([], "standard_id string"))

    def _add(self, collection: str, points: DataFrame, standards: DataFrame, alone: bool = False) -> None:
        """A new segment with the points of standards; alone: the segments before it go."""
        before = self.segments(collection)
        at = f"{self.path(collection)}/seg-{max(before, default=0) + 1:08d}"
        points.write.mode("overwrite").partitionBy("standard_id").parquet(f"{at}/points")
        there, fs = self._fs(f"{at}/points")
        if not any(x.isDirectory() for x in fs.listStatus(there)):  # without points there is no file; one without rows has the columns
            self.spark.createDataFrame([], points.schema).write.mode("overwrite").parquet(f"{at}/points")
        standards.select("standard_id").distinct().coalesce(1).write.mode("overwrite").parquet(f"{at}/standards")
        for n in before if alone else ():
            p, fs = self._fs(f"{self.path(collection)}/seg-{n:08d}")
            fs.delete(p, True)

    def read(self, collection: str) -> DataFrame:
        """The points of a collection. Each standard is looked up in its last segment; the list of standards is small and goes by broadcast."""
        numbers = self.segments(collection)
        if not numbers:
            raise ValueError(f"[COLLECTION] none: {collection}")
        at = lambda n, part: self.spark.read.parquet(f"{self.path(collection)}/seg-{n:08d}/{part}")
        typed = lambda n: at(n, "points").withColumn("standard_id", F.col("standard_id").cast("string"))
        if len(numbers) == 1:
            return typed(numbers[0])
        parts, owners = None, None
        for n in numbers:
            part, owner = typed(n).withColumn("segment__", F.lit(n)), at(n, "standards").withColumn("segment__", F.lit(n))
            parts = part if parts is None else parts.unionByName(part, allowMissingColumns=True)
            owners = owner if owners is None else owners.unionByName(owner)
        last = owners.groupBy("standard_id").agg(F.max("segment__").alias("segment__"))
        return parts.join(F.broadcast(last), ["standard_id", "segment__"], "left_semi").drop("segment__")

    def replace(self, collection: str, points: DataFrame) -> None:
        """The collection becomes points; what was there stays until they are written."""
        self._add(collection, points, points, alone=True)

    def drop(self, collection: str) -> None:
        p, fs = self._fs(self.path(collection))
        fs.delete(p, True)

    def upsert(self, collection: str, new: DataFrame, prune: bool = True) -> dict[str, int]:
        """Merges new's points; the counts of what was written, changed in content and pruned. Writing the same again changes nothing.

        Only the standards of new, and those that its points were in, are rewritten. new is read several times: a written table, or one that is persisted."""
        points = new.select("point_id").distinct().count()
        if not self.exists(collection):
            self.replace(collection, one_each(new, "point_id"))
            return {"points": points, "drift": 0, "pruned": 0}
        old = self.read(collection)
        touched = new.select("standard_id").union(old.join(new.select("point_id"), "point_id", "left_semi").select("standard_id")).distinct()
        told = {"points": points, "drift": drift(old, new).count(), "pruned": stale(old, new).count() if prune else 0}
        if len(self.segments(collection)) >= self.SEGMENTS:
            self.replace(collection, merged(old, new, prune))
        else:
            self._add(collection, merged(old.join(F.broadcast(touched), "standard_id", "left_semi"), new, prune), touched)
        return told

    def count(self, collection: str, where: Column | None = None) -> int:
        rows = self.read(collection)
        return (rows if where is None else rows.where(where)).count()

    def scan(self, collection: str, standard: str) -> DataFrame:
        return self.read(collection).where(F.col("standard_id") == standard)

    def get(self, collection: str, ids: DataFrame) -> DataFrame:
        return self.read(collection).join(ids.select("point_id").distinct(), "point_id", "left_semi")


def verified(points: DataFrame, dim: int, expected: DataFrame | None = None) -> DataFrame:
    """One row for each collection: n, bad_dim, duplicate ids, and whether the count is as expected (collection, expected)."""
    by = points.groupBy("collection").agg(F.count("*").alias("n"), F.count(F.when(F.size("vector") != dim, 1)).alias("bad_dim"), (F.count("*") - F.countDistinct("point_id")).alias("duplicates"))
    if expected is None:
        return by.withColumn("passed", (F.col("bad_dim") == 0) & (F.col("duplicates") == 0))
    out = by.join(expected, "collection", "full").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.withColumn("passed", (F.col("n") == F.col("expected")) & (F.coalesce("bad_dim", F.lit(0)) == 0) & (F.coalesce("duplicates", F.lit(0)) == 0))


class EmbeddingCache:
    """Cache rows as Parquet, partitioned by role, at a path in any store. A table that can't be read is moved aside and a new one begun."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.store = spark, path.rstrip("/"), PointStore(spark, path)

    def read(self) -> DataFrame:
        """The rows; none if there is no table or if it can't be read."""
        self._recovered()
        here, fs = self.store._fs(self.path)
        if fs.exists(here):
            try:
                rows = self.spark.read.schema(CACHE_SCHEMA).parquet(self.path)
                rows.agg(F.count("vector"), F.max("cache_key")).collect()  # reads every file, so a broken one shows
                return rows
            except Exception:
                stamp = self.spark.range(1).select(F.date_format(F.current_timestamp(), "yyyyMMdd'T'HHmmss'Z'").alias("t")).first()["t"]
                fs.rename(here, self.store._fs(f"{self.path}.corrupt.{stamp}")[0])
        return self.spark.createDataFrame([], CACHE_SCHEMA)

    def add(self, rows: DataFrame) -> DataFrame:
        """Adds rows, which are read once, and gives them as they are stored; a key that is there already is replaced. New rows alone are appended, without rewriting the table."""
        columns = [c.split(" ")[0] for c in CACHE_SCHEMA.split(", ")]
        staged = f"{self.path}.staged"
        rows.select(*columns).write.mode("overwrite").parquet(staged)
        fresh = self.spark.read.schema(CACHE_SCHEMA).parquet(staged)
        fresh = one_each(fresh, "cache_key")
        old = self.read()
        if old.join(fresh.select("cache_key"), "cache_key", "left_semi").isEmpty():
            fresh.write.mode("append").partitionBy("role").parquet(self.path)
            return fresh
        upserted(old, fresh, "cache_key").select(*columns).write.mode("overwrite").partitionBy("role").parquet(f"{self.path}.next")
        here, fs = self.store._fs(self.path)
        before, _ = self.store._fs(f"{self.path}.before")
        fs.delete(before, True)
        fs.rename(here, before)
        fs.rename(self.store._fs(f"{self.path}.next")[0], here)
        fs.delete(before, True)
        return fresh

    def _recovered(self) -> None:
        """Where a writer died between two renames, the table that it had written, or else the one before, takes its place."""
        here, fs = self.store._fs(self.path)
        if not fs.exists(here):
            for name in ("next", "before"):
                there, _ = self.store._fs(f"{self.path}.{name}")
                if fs.exists(self.store._fs(f"{self.path}.{name}/_SUCCESS")[0]):
                    fs.rename(there, here)
                    return

    def get(self, role: str, texts: DataFrame) -> DataFrame:
        """The cached rows of texts (text) in a role."""
        model = model_for(F.lit(role))
        keys = texts.select(cache_key(model, F.lit(role), F.col("text")).alias("cache_key")).distinct()
        return self.read().where(F.col("role") == role).join(keys, "cache_key", "left_semi")

"""Threshold-scaled fingerprints, with DataFrame operations only.

A text's sketch keeps every hash of its 5-word shingles that lies below a fixed fraction of the hash range, and the
least hash of all, so that no text with a word has an empty sketch. Sketches of two texts are samples by the same rule,
which makes containment and resemblance plain set counts, however unequal the texts, and the union of sketches the
sketch of the union.

Nulls: a null text is the empty text, whose sketch is empty; two empty sketches are alike (1), an empty and another are
not (0). Texts of fewer words than a shingle are one shingle. Documents follow each other by doc_id, rows of equal
doc_id by their text's hash; a null doc_id comes first. Equal rows get equal results. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, fold

WORDS = 5
#: Hashes below 2**-SCALE of the range are kept.
SCALE = 2
#: Documents of a bucket of consecutive ids; more where there are over BUCKET ** 2, as buckets and their sizes both grow with the root of the documents.
BUCKET = 1_000


def word_hashes(text: Column) -> Column:
    return F.transform(F.filter(F.split(fold(text), r"[\x20\x09-\x0D]+"), lambda w: w != ""), lambda w: F.xxhash64(w))


def shingle_hashes(hashed: Column) -> Column:
    """The shingles' hashes from the words' hashes; hashed must be a column, not an expression, as it is read by index."""
    each = F.transform(F.sequence(F.lit(1), F.size(hashed) - (WORDS - 1)), lambda i: F.xxhash64(*(F.element_at(hashed, i + k) for k in range(WORDS))))
    return F.when(F.size(hashed) >= WORDS, each).when(F.size(hashed) > 0, F.array(F.xxhash64(hashed))).otherwise(F.array().cast("array<bigint>"))


def below(hashes: Column, scale: int = SCALE) -> Column:
    """The distinct hashes below the threshold; as unsigned numbers they are all positive."""
    return F.array_distinct(F.filter(hashes, lambda h: F.shiftrightunsigned(h, 64 - scale) == 0))


def kept(found: Column, hashes: Column) -> Column:
    """The sketch of shingle hashes from those below the threshold, ascending; the least hash, by the unsigned order, stands in for none."""
    flip = F.lit(-(1 << 63))
    least = F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(flip))).bitwiseXOR(flip)
    return F.when((F.size(found) > 0) | (F.size(hashes) == 0), F.sort_array(found)).otherwise(F.array(least))


def with_sketch(df: DataFrame, text: str, out: str, scale: int = SCALE) -> DataFrame:
    """df with column out, the sketch of the texts in a column. Each step is a projection of its own, so that no step is computed twice."""
    a, b, c = f"{out}__words", f"{out}__shingles", f"{out}__below"
    df = df.withColumn(a, word_hashes(F.coalesce(text, F.lit(""))))
    df = df.withColumn(b, shingle_hashes(F.col(a))).drop(a)
    df = df.withColumn(c, below(F.col(b), scale))
    return df.withColumn(out, kept(F.col(c), F.col(b))).drop(b, c)


def resemblance(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes of two sketches."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both / F.greatest(F.size(a) + F.size(b) - both, F.lit(1)))


def containment(a: Column, b: Column) -> Column:
    """The share of a's hashes that b has."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.lit(1)))


def merged(a: Column, b: Column, scale: int = SCALE) -> Column:
    """The sketch of two texts' shingles together."""
    both = F.array_union(a, b)
    return kept(below(both, scale), both)


def bounds(keys: DataFrame, parts: int) -> list[tuple]:
    """The first key (there, id, h) of each of about parts ranges of keys, ascending. The keys are sorted into ranges on the executors; the driver gets a row for each range."""
    ranged = Scratch(keys.sparkSession, "sketch").cut(keys.repartitionByRange(parts, "there", "id", "h").withColumn("part", F.spark_partition_id()))
    firsts = ranged.groupBy("part").agg(F.min(F.struct("there", "id", "h")).alias("first")).select("first.*").orderBy("there", "id", "h")
    return [tuple(r) for r in firsts.collect()]


def bucket_of(key: Column, first: Column, n: int) -> Column:
    """The last of the n ascending first keys that isn't above the key, counted from 0, by bisection."""
    steps = F.array(*(F.lit(1 << power) for power in reversed(range(n.bit_length()))))  # first[low] <= key, or low is 0, from step to step
    return F.aggregate(steps, F.lit(0), lambda low, step: F.when((low + step < n) & (F.get(first, low + step) <= key), low + step).otherwise(low))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and next_text, the text of the document that follows by doc_id; after the last comes the first.

    Documents are dealt to buckets of consecutive keys (id and text's hash, so that rows of one id may lie in several).
    A bucket also gets a copy of the first row of the next one, as a guard behind its last, so that the neighbour is found within a bucket."""
    text = F.coalesce("text", F.lit(""))
    plain = docs.select("doc_id", text.alias("text"), F.struct(F.col("doc_id").isNotNull().alias("there"), F.col("doc_id").alias("id"), F.xxhash64(text).alias("h")).alias("key"))
    n = docs.count()
    parts = math.ceil(n / max(BUCKET, math.isqrt(n)))
    if parts > 1:
        found = bounds(plain.select("key.*"), parts)
        kind = docs.schema["doc_id"].dataType.simpleString()
        listed = json.dumps([{"there": t, "id": i, "h": h} for t, i, h in found], default=str)
        first = F.from_json(F.lit(listed), f"array<struct<there:boolean,id:{kind},h:bigint>>")  # folded to a literal of 24 bytes a bucket
        plain = plain.withColumn("bucket", bucket_of(F.col("key"), first, len(found)))
        guards = plain.where(F.get(first, F.col("bucket")) == F.col("key")).withColumn("bucket", F.pmod(F.col("bucket") - 1, F.lit(len(found))))
    else:
        plain = plain.withColumn("bucket", F.lit(0))
        least = plain.agg(F.min("key").alias("least"))
        guards = plain.join(F.broadcast(least), F.col("key") == F.col("least"), "left_semi")
    rows = plain.withColumn("guard", F.lit(0)).unionByName(guards.withColumn("guard", F.lit(1)))
    order = Window.partitionBy("bucket").orderBy("guard", "key")
    return rows.withColumn("next_text", F.lead("text").over(order)).where("guard = 0").select("doc_id", "text", "next_text")


def edited(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars long, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, containment_edited, sketch_size."""
    pairs = with_next(docs)
    half = F.floor(F.length("text") / 2).cast("int")
    rows = pairs.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next_text"), F.lit(1), half)))
    for text, out in (("text", "own"), ("edited", "other"), ("next_text", "following")):
        rows = with_sketch(rows, text, out)
    digest = lambda c: F.md5(F.array_join(c, ",").cast("binary"))
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        digest("own").alias("fingerprint"),
        digest("other").alias("edited_fingerprint"),
        resemblance(F.col("own"), F.col("other")).alias("near_edited"),
        resemblance(F.col("own"), F.col("following")).alias("near_next"),
        containment(F.col("own"), F.col("other")).alias("containment_edited"),
        F.size("own").cast("long").alias("sketch_size"),
    )

"""SimHash fingerprints and near-duplicate components through BK-trees.

A fingerprint's bits are majority votes over the XXH64 of the text's 3-word shingles. Distinct fingerprints within
`RADIUS` bits are linked. Two of 64 bits that differ leave one of three bit ranges equal, so every link lies within a
shard of fingerprints that share a range's value; a shard that grows large is split again by ranges of the bits that
remain, which loses no link either. The shards are searched through BK-trees: children are keyed by the Hamming
distance to their parent, and a search follows the edges within the radius only. The trees of all shards in a task are
built and searched level by level on arrays. Each task gives one row per fingerprint and shard (its representative in
the shard), never the pairs; the representatives are joined to components by repeated minima, with lineage cut in the
shared folder.

Nulls: a null text is the empty text; texts without words have fingerprint zero. A null doc_id counts as no document
when components are named. Copies meet in one fingerprint before any link is sought; equal rows stay equal rows. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, lean, small_batches

SEED, WORDS, RADIUS = 42, 3, 2
#: Shards of more fingerprints are split by the bits that remain.
SPLIT = 2048
#: Rows of a fingerprint from which it is hot.
HOT = 100_000
#: Pairs of a searched fingerprint and a tree node that are held at once.
FRONTIER = 1 << 20
#: Three ranges of the bits, and of each range's rest again three: (shift, width) pieces.
RANGES = ((0, 21), (21, 21), (42, 22))
BITS = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def shingle_hashes(words: list[bytes]) -> list[int]:
    """The hash of each shingle of words, repeats included; of fewer words that of the whole sequence."""
    digest = xxhash.xxh64_intdigest
    if len(words) <= WORDS:
        return [digest(b" ".join(words), SEED)] if words else []
    return [digest(b"%b %b %b" % x, SEED) for x in zip(words, words[1:], words[2:], strict=False)]


def majority(hashes: list[int]) -> int:
    """A number whose bits are set where more than half of the hashes have them; 0 of none."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], ">u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes)).tobytes(), "big") if hashes else 0


def fingerprint(text: str | None) -> int:
    """The fingerprint of one text."""
    return majority(shingle_hashes((text or "").encode().lower().split()))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp long: the fingerprint's 64 bits as a signed number."""

    @lean
    def run(batches):
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ b).view(np.uint16).reshape(-1, 4)
    return BITS[x].sum(1, dtype=np.int64)


class Forest:
    """BK-trees over the shards of an array; equal shard numbers stand together. A fingerprint is a node; node i's
    children stand in `child` under keys parent * 65 + distance, in order."""

    def __init__(self, values: np.ndarray, shard: np.ndarray):
        n = len(values)
        self.values, first = values, np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if n else np.zeros(0, np.int64)
        self.root = np.repeat(first, np.diff(np.r_[first, n]))
        waiting = np.setdiff1d(np.arange(n), first, assume_unique=True)
        at = self.root[waiting]
        keys, nodes = [], []
        while len(waiting):
            key = at * 65 + distance(values[waiting], values[at])
            order = np.argsort(key, kind="stable")
            waiting, key = waiting[order], key[order]
            new = np.r_[True, key[1:] != key[:-1]]
            node = waiting[np.flatnonzero(new)][np.cumsum(new) - 1]
            keys.append(key[new])
            nodes.append(waiting[new])
            waiting, at = waiting[~new], node[~new]
        key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        order = np.argsort(key)
        self.keys, self.child = key[order], (np.concatenate(nodes) if nodes else np.zeros(0, np.int64))[order]

    def links(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of different nodes of a shard within the radius, in blocks; each pair at least once."""
        for start in range(0, len(self.values), FRONTIER // 8):
            query = np.arange(start, min(start + FRONTIER // 8, len(self.values)))
            work = [(query, self.root[query])]
            while work:
                query, node = work.pop()
                if len(query) > FRONTIER:
                    half = len(query) // 2
                    work += [(query[:half], node[:half]), (query[half:], node[half:])]
                    continue
                d = distance(self.values[query], self.values[node])
                near = (d <= radius) & (query > node)
                if near.any():
                    yield query[near], node[near]
                low = np.searchsorted(self.keys, node * 65 + np.maximum(d - radius, 0))
                count = np.searchsorted(self.keys, node * 65 + np.minimum(d + radius, 64), side="right") - low
                if total := int(count.sum()):
                    skip = np.repeat(np.cumsum(count) - count, count)
                    work.append((np.repeat(query, count), self.child[np.arange(total) - skip + np.repeat(low, count)]))


def representatives(values: np.ndarray, shard: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint the index of the first one that it reaches within its shard."""
    label = np.arange(len(values))
    pairs = [(a.copy(), b.copy()) for a, b in Forest(values, shard).links(radius)]
    if not pairs:
        return label
    a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        while (label[label] != label).any():
            label = label[label]
        if (label == before).all():
            return label


def _part(fp: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))


def _thirds(pieces: tuple[tuple[int, int], ...]) -> list[tuple[tuple[int, int], ...]]:
    """The bits of pieces in three ranges of about equal size, each as pieces."""
    bits = [s + i for s, w in pieces for i in range(w)]
    size = -(-len(bits) // 3)
    out = []
    for part in (bits[k : k + size] for k in range(0, len(bits), size)):
        runs = []
        for bit in part:
            if runs and runs[-1][0] + runs[-1][1] == bit:
                runs[-1][1] += 1
            else:
                runs.append([bit, 1])
        out.append(tuple((s, w) for s, w in runs))
    return out


def _value(fp: Column, pieces: tuple[tuple[int, int], ...]) -> Column:
    value, below = F.lit(0).cast("long"), 0
    for shift, width in pieces:
        value = value.bitwiseOR(F.shiftleft(_part(fp, shift, width), below))
        below += width
    return value


def shards(distinct: DataFrame, scratch: Scratch, split: int = SPLIT) -> DataFrame:
    """(k1 int, v1 long, k2 int, v2 long: the shard; fp long), shards with two fingerprints at least.

    A level-two shard fixes at least 35 of 64 bits."""
    first = distinct.select("fp", F.explode(F.array(*(F.struct(F.lit(k).alias("k1"), _part(F.col("fp"), s, w).alias("v1")) for k, (s, w) in enumerate(RANGES)))).alias("x")).select("x.*", "fp")
    sizes = scratch.cut(first.groupBy("k1", "v1").agg(F.count("*").alias("n")).where("n > 1"))
    known = first.join(sizes, ["k1", "v1"])
    plain = known.where(F.col("n") <= split).select("k1", "v1", F.lit(0).alias("k2"), F.lit(0).cast("long").alias("v2"), "fp")
    again = []
    for k in range(3):
        rest = tuple(r for j, r in enumerate(RANGES) if j != k)
        for j, pieces in enumerate(_thirds(rest)):
            again.append(F.struct(F.lit(k).alias("for"), F.lit(j + 1).alias("k2"), _value(F.col("fp"), pieces).alias("v2")))
    large = known.where(F.col("n") > split).select("k1", "v1", "fp", F.explode(F.filter(F.array(*again), lambda x: x["for"] == F.col("k1"))).alias("x"))
    return plain.unionByName(large.select("k1", "v1", "x.k2", "x.v2", "fp"))


def links(sharded: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): a fingerprint and its representative in a shard, where they differ."""

    @lean
    def run(batches):
        held: list[np.ndarray] = []

        def done(rows: np.ndarray) -> pa.RecordBatch:
            key, fp = rows[:, :4], rows[:, 4]
            new = np.r_[True, (key[1:] != key[:-1]).any(1)] if len(rows) else np.zeros(0, bool)
            to = representatives(np.ascontiguousarray(fp), np.cumsum(new), radius)
            other = to != np.arange(len(fp))
            return pa.RecordBatch.from_arrays([pa.array(fp[other]), pa.array(fp[to[other]])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
            if held and len(held[-1]):
                rows = np.concatenate([*held, rows])
            last = np.flatnonzero((rows[:, :4] != rows[-1, :4]).any(1))
            cut = int(last[-1]) + 1 if len(last) else 0  # the last shard may go on in the next batch
            held = [rows[cut:]]
            if cut:
                yield done(rows[:cut])
        if held and len(held[-1]):
            yield done(held[-1])

    key = ["k1", "v1", "k2", "v2"]
    return sharded.repartition(*key).sortWithinPartitions(*key, "fp").select(*key, "fp").mapInArrow(run, "a long, b long")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root): each node of the edges (a, b) with the least node of its component.

    Alternates large-star and small-star steps: each round's join is a grouping by node, and a node's neighbours are
    reduced to a minimum before the shuffle; rounds grow with the logarithm of the largest component."""
    edges = scratch.cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    number = scratch.made - 1
    before = None
    while True:
        # large star: neighbours above a node go to the least neighbour
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: neighbours below a node, and itself, go to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        edges = scratch.cut(small)
        scratch.drop(number)
        number = scratch.made - 1
        state = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def near_duplicates(docs: DataFrame, radius: int = RADIUS, split: int = SPLIT, hot: int = HOT) -> DataFrame:
    """doc_id, fp long, component_id: the smallest doc_id that is reachable through linked fingerprints.

    Fingerprints of over hot rows (that of the texts without words, those of much copied ones) are joined by broadcast:
    there are at most a row of them for hot rows of docs, and their copies need not meet in one task."""
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = scratch.cut(fingerprints(docs))
    distinct = scratch.cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")))
    roots = components(links(shards(distinct.select("fp"), scratch, split), radius), scratch)
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", "rows", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    member = scratch.cut(named.join(least, "root").select("fp", "rows", "component_id"))
    often = F.broadcast(member.where(F.col("rows") > hot).select(F.col("fp").alias("h_fp"), F.col("component_id").alias("h_id")))
    seldom = member.where(F.col("rows") <= hot).select(F.col("fp").alias("s_fp"), F.col("component_id").alias("s_id"))
    known = marked.join(often, marked["fp"] == often["h_fp"], "left").select("doc_id", "fp", "h_fp", "h_id")
    there = known.where("h_fp is not null").select("doc_id", "fp", F.col("h_id").alias("component_id"))
    rest = known.where("h_fp is null").join(seldom, F.col("fp") == F.col("s_fp")).select("doc_id", "fp", F.col("s_id").alias("component_id"))
    return there.unionByName(rest)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint as 16 hexadecimal digits, component_id."""
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each component, as it is: that of the smallest doc_id, then of the smallest hash of its text; of rows equal in both the first by all columns.

    Rows without a doc_id come last. A component is of fingerprints, so rows of one id in different components are each kept."""
    scratch = Scratch(docs.sparkSession, "keepfirst")
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"))
    named = scratch.cut(near_duplicates(docs.select(F.struct("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th")).alias("doc_id"), "text")))
    kept = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id.doc_id").isNull().alias("none"), F.col("doc_id.doc_id").alias("id"), F.col("doc_id.th").alias("th"))).alias("k"))
    kept = kept.select(F.col("k.id").alias("k_id"), F.col("k.th").alias("k_th")).distinct()
    rows = rows.join(kept.hint("merge"), F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("th") == F.col("k_th")), "left_semi")
    return rows.groupBy("doc_id", "th").agg(F.min("row").alias("row")).select("row.*")

"""Near copies by SimHash links, banded MinHash and exact similarity, for the corpus pipeline.

Two texts are near copies if the sets of their shingles of `WORDS` words have a Jaccard similarity of `LEAST` or more;
a text of fewer words is one shingle. Texts of equal words meet in one key first. Candidates are the links that the
BK-trees of SimHash fingerprints find and, as texts of that similarity often differ in more bits than such trees can be
searched for, the keys that share a band: each key has `BANDS` bands of `ROWS` least hashes, which loses a pair of
similarity s with probability (1 - s**ROWS)**BANDS: 0.00008 at 0.8, less above. Every link is a pair whose sets were
compared exactly.

A bucket is the keys of one band's value. Up to `PAIRED` keys are all compared. In a larger one each key is compared with
the key that has the most company in all its buckets (an original among its copies) and with the least key. Most keys of a
bucket are then in one component; those that aren't are its strays. The large buckets of one main component are a scope,
which has a head (of that component's keys the one with the most company). What each key of the scope shares with the
head and what it has besides, its rest, is found exactly. A stray and another key of the scope can be similar only if
their rests share a shingle, or if the sizes of shares and rests allow it without; the pairs of both kinds are found by
joins on the rests' shingles and on the sizes, and compared. So every pair of a bucket is compared, known to be connected,
or known not to be similar enough, nothing is capped, and a group of copies doesn't cost the square of its size.

Words are split at ASCII white space, A-Z lower-cased. Nulls: a null text is the empty text, and all texts without words are
copies. A null doc_id counts as no document when the first of a component is named. An empty table gives an empty result.
Other columns are carried along, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import simhash
from tessera.llm.common import Scratch, lean, small_batches
from tessera.llm.simhash import components

WORDS, LEAST = 5, 0.8
ROWS, BANDS = 4, 18
#: Keys of a bucket that are all compared with each other.
PAIRED = 16
#: Shingles that are hashed at once.
BLOCK = 1 << 12
SEED = 42
_random = np.random.default_rng(SEED)
FACTORS = _random.integers(0, 1 << 63, ROWS * BANDS, np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _random.integers(0, 1 << 63, ROWS * BANDS, np.uint64)
STEPS = _random.integers(0, 1 << 63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)


def split(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingles(words: list[bytes]) -> np.ndarray:
    """The distinct 64-bit hashes of the shingles, ascending; of no words, that of the empty shingle."""
    digest = xxhash.xxh64_intdigest
    if len(words) <= WORDS:
        return np.array([digest(b" ".join(words), SEED)], np.uint64)
    known = {w: digest(w, SEED) for w in set(words)}
    ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = len(words) - WORDS + 1
    value = np.zeros(n, np.uint64)
    for k in range(WORDS):
        value = (value ^ ids[k : k + n]) * STEPS[k]
        value ^= value >> np.uint64(32)
    return np.unique(value)


def bands(found: np.ndarray) -> np.ndarray:
    """The value of each band of a set's least hashes."""
    least = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), BLOCK):
        part = found[at : at + BLOCK]
        for k in range(ROWS * BANDS):
            value = part * FACTORS[k] + OFFSETS[k]
            least[k] = min(least[k], (value ^ (value >> np.uint64(32))).min())
    out = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        out = (out ^ row) * STEPS[0]
        out ^= out >> np.uint64(29)
    return out


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, th: the text's hash, key: the hash of its words, n: its shingles, fp: its SimHash fingerprint, bands array<long>."""

    @lean
    def run(batches):
        for batch in batches:
            keys, sizes, values, prints = [], [], [], []
            for text in batch.column(2):
                words = split(text.as_py())
                prints.append(simhash.majority(simhash.shingle_hashes(words)))
                found = shingles(words)
                keys.append(xxhash.xxh64_intdigest(b" ".join(words), SEED))
                sizes.append(len(found))
                values.append(bands(found))
            flat = np.concatenate(values).view(np.int64) if values else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * BANDS, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), pa.array(np.array(prints, np.uint64).view(np.int64)), lists], names=["doc_id", "th", "key", "n", "fp", "bands"])

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text").mapInArrow(run, f"doc_id {kind}, th long, key long, n long, fp long, bands array<long>")


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): the pairs whose sets are similar enough."""

    @lean
    def run(batches):
        for batch in batches:
            sets: dict[int, np.ndarray] = {}
            keep = []
            for a, b, x, y in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                for key, text in ((a, x), (b, y)):
                    if key not in sets:
                        sets[key] = shingles(split(text))
                keep.append(similarity(sets[a], sets[b]) >= LEAST)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = texts.select(F.col("key").alias("a"), F.col("text").alias("x"))
    two = texts.select(F.col("key").alias("b"), F.col("text").alias("y"))
    return pairs.join(one.hint("merge"), "a").join(two.hint("merge"), "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _apart(rows: DataFrame) -> DataFrame:
    """(a, b), a < b, distinct, of rows (a, na, b, nb): pairs whose sizes allow the similarity."""
    fits = F.least("na", "nb") >= F.greatest("na", "nb") * LEAST - 1e-6
    return rows.where((F.col("a") != F.col("b")) & fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def links(marked: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root): the keys that have near copies, with the least key of their component."""
    keys = marked.groupBy("key").agg(F.min(F.struct("doc_id", "th")).alias("row"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("bands").alias("bands"))
    distinct = scratch.cut(keys.select("key", "row.doc_id", "row.th", "n", "fp", "bands"))
    rows = distinct.select("key", "n", F.explode("bands").alias("band"))
    one = F.struct("key", "n")
    buckets = rows.groupBy("band").agg(F.count("*").alias("size"), F.min(one).alias("low"), F.max(one).alias("high")).where("size > 1")
    buckets = scratch.cut(buckets)
    two = buckets.where("size = 2").select(F.col("low.key").alias("a"), F.col("low.n").alias("na"), F.col("high.key").alias("b"), F.col("high.n").alias("nb"))
    member = scratch.cut(rows.join(buckets.where("size > 2").select("band", "size"), "band"))

    # one key stands for each fingerprint, as keys of equal fingerprints are candidates of it
    print_ = distinct.groupBy("fp").agg(F.min(F.struct("key", "n")).alias("k"), F.count("*").alias("keys"))
    prints = scratch.cut(print_.select("fp", F.col("k.key").alias("b"), F.col("k.n").alias("nb"), "keys"))
    near = simhash.links(simhash.shards(prints.select("fp"), scratch)).distinct().withColumnsRenamed({"a": "from", "b": "to"})
    linked = near.join(prints.select(F.col("fp").alias("from"), F.col("b").alias("a"), F.col("nb").alias("na")), "from").join(prints.select(F.col("fp").alias("to"), "b", "nb"), "to").select("a", "na", "b", "nb")
    same = distinct.select(F.col("key").alias("a"), F.col("n").alias("na"), "fp").join(prints.where("keys > 1"), "fp").select("a", "na", "b", "nb")

    listed = member.where(F.col("size") <= PAIRED).groupBy("band").agg(F.collect_list(F.struct("key", "n")).alias("x"))
    pair = listed.select(F.explode("x").alias("p"), "x").select("p", F.explode("x").alias("q")).where("p.key < q.key")
    close = pair.select(F.col("p.key").alias("a"), F.col("p.n").alias("na"), F.col("q.key").alias("b"), F.col("q.n").alias("nb"))
    large = scratch.cut(member.where(F.col("size") > PAIRED))
    company = member.groupBy("key").agg(F.sum("size").alias("company"))
    heads = large.join(company, "key").groupBy("band").agg(F.max(F.struct("company", "key", "n")).alias("m"), F.min(F.struct("key", "n")).alias("l"))
    heads = heads.select("band", F.explode(F.array(F.struct("m.key", "m.n"), F.struct("l.key", "l.n"))).alias("h"))
    star = large.join(heads, "band").select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("h.key").alias("b"), F.col("h.n").alias("nb"))
    tried = scratch.cut(_apart(two.unionByName(close).unionByName(star).unionByName(linked).unionByName(same)))

    wanted = tried.select("a").union(tried.select("b")).union(large.select("key")).distinct()
    first = distinct.join(wanted, F.col("key") == F.col("a"), "left_semi").select("key", F.col("doc_id").alias("d"), F.col("th").alias("h"))
    texts = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"))
    texts = scratch.cut(texts.join(first.hint("merge"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("h"))).select("key", "text").dropDuplicates(["key"]))
    edges = scratch.cut(compared(tried, texts))
    roots = components(edges, scratch)
    rooted = scratch.cut(large.join(roots, F.col("key") == F.col("node"), "left").select("band", "key", "n", F.coalesce("root", "key").alias("root")))
    each = rooted.groupBy("band", "root").agg(F.count("*").alias("held"))
    main = each.groupBy("band").agg(F.max(F.struct("held", "root")).alias("m"), F.count("*").alias("parts")).where("parts > 1").select("band", F.col("m.root").alias("main"))
    mixed = scratch.cut(rooted.join(main, "band"))
    if mixed.isEmpty():
        return roots
    scope = mixed.select("main", "key", "n", "root").distinct()
    head = scope.where("root = main").join(company, "key").groupBy("main").agg(F.max(F.struct("company", "key")).alias("h")).select("main", F.col("h.key").alias("head"))
    scope = scratch.cut(shared(scope.join(head, "main"), texts))
    more = scratch.cut(_strays(scope).join(tried, ["a", "b"], "left_anti"))
    return components(edges.unionByName(compared(more, texts)), scratch)


def shared(scope: DataFrame, texts: DataFrame) -> DataFrame:
    """(main, key, n, root, both: the number of shingles that the key shares with the head, rest array<long>: those that the head lacks)."""

    @lean
    def run(batches):
        for batch in batches:
            heads: dict[int, np.ndarray] = {}
            both, rest = [], []
            for head, x, y in zip(*(batch.column(k).to_pylist() for k in (4, 5, 6)), strict=True):
                if head not in heads:
                    heads = {head: shingles(split(y))}
                mine = shingles(split(x))
                known = np.isin(mine, heads[head], assume_unique=True)
                both.append(int(known.sum()))
                rest.append(mine[~known].view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(both, pa.int64()), pa.array(rest, pa.list_(pa.int64()))], names=["main", "key", "n", "root", "both", "rest"])

    one = texts.select("key", F.col("text").alias("x"))
    two = texts.select(F.col("key").alias("head"), F.col("text").alias("y"))
    rows = scope.join(one.hint("merge"), "key").join(two.hint("merge"), "head").select("main", "key", "n", "root", "head", "x", "y")
    return rows.mapInArrow(run, "main long, key long, n long, root long, both long, rest array<long>")


def _strays(scope: DataFrame) -> DataFrame:
    """(a, b), a < b, distinct: the pairs of a stray and a key of its scope in another component that may be similar enough.

    Similar sets share LEAST / (1 + LEAST) of their sizes' sum; what the smaller share falls short of that, their rests must
    share. Two that may lack nothing are found by sizes. Others share one of the rarest shingles of each rest, so many of them
    that what the rests must share doesn't fit into the others."""
    own = scope.select("main", F.col("key").alias("a"), F.col("n").alias("na"), "root", F.col("both").alias("ia"))
    stray = scope.where("root <> main").select("main", F.col("key").alias("b"), F.col("n").alias("nb"), F.col("root").alias("to"), F.col("both").alias("ib"))
    lack = F.ceil((F.col("na") + F.col("nb")) * (LEAST / (1 + LEAST)) - 1e-6) - F.least("ia", "ib")
    by_size = own.join(stray, "main").where((F.col("root") != F.col("to")) & (lack <= 0))
    each = scope.select("main", "key", "n", "root", "both", F.size("rest").alias("besides"), F.explode("rest").alias("shingle"))
    held = each.groupBy("main", "shingle").agg(F.count("*").alias("held")).where("held > 1")
    own_ = Window.partitionBy("main", "key")
    # shingles of one key only are its first, whatever their order: they are counted, not ranked
    at = F.col("besides") - F.count("*").over(own_) + F.row_number().over(own_.orderBy("held", "shingle"))
    # of any pair of sizes that fit; what is behind that is shared too late
    ranked = each.join(held, ["main", "shingle"]).withColumn("at", at).where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * LEAST - 1e-5) + 1)
    one = ranked.select("main", "shingle", F.col("key").alias("a"), F.col("n").alias("na"), "root", F.col("both").alias("ia"), F.col("at").alias("at_a"))
    two = ranked.where("root <> main").select("main", "shingle", F.col("key").alias("b"), F.col("n").alias("nb"), F.col("root").alias("to"), F.col("both").alias("ib"), F.col("at").alias("at_b"))
    early = (F.col("at_a") <= F.col("na") - F.col("ia") - lack + 1) & (F.col("at_b") <= F.col("nb") - F.col("ib") - lack + 1)
    by_rest = one.join(two, ["main", "shingle"]).where((F.col("root") != F.col("to")) & (lack > 0) & early)
    return _apart(by_rest.select("a", "na", "b", "nb").unionByName(by_size.select("a", "na", "b", "nb")))


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id, th, key, component_id: the smallest doc_id that is reachable through near copies, component_th: the smallest hash of a text of its."""
    scratch = Scratch(docs.sparkSession, "nearcopies")
    marked = scratch.cut(signatures(docs))
    roots = links(marked, docs, scratch)
    first = marked.groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("first"))
    named = first.join(roots, first["key"] == roots["node"], "left").select("key", "first", F.coalesce("root", "key").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("first"))
    member = named.join(least.withColumnRenamed("first", "of"), "root").select("key", F.col("of.doc_id").alias("component_id"), F.col("of.th").alias("component_th"))
    return marked.select("doc_id", "th", "key").join(member, "key").select("doc_id", "th", "key", "component_id", "component_th")


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each component, as it is: the one with the smallest doc_id, null ids last, of rows of equal id the one with the smallest hash of its text, of those the first by all columns."""
    kept = near_copies(docs).select(F.col("component_id").alias("k_id"), F.col("component_th").alias("k_th")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"))
    rows = rows.join(kept.hint("merge"), F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("th") == F.col("k_th")), "left_semi")
    return rows.groupBy("doc_id", "th").agg(F.min("row").alias("row")).select("row.*")

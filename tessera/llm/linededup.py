"""Line deduplication by pairwise alignment.

A common block is a run of lines, blank ones left out, that two documents share and that has enough words; how many is
the caller's. Which documents overlap is told by line hashes: every shortest run of lines that has enough words, read
forwards from its first line and backwards from its last, is a seed (a line of enough words is one by itself). A seed's
rows are not paired with each other: each is paired with the first document that has the seed. So pairs grow with the
documents' lines, however common a line or passage is, and no partner is dropped: each line of a block lies in a seed
within the block, and the first holder of that seed has it. A pair's lines are aligned by patience diff (unique common
lines in longest increasing order, recursively between them, and common heads and tails), again on what is left as long
as that finds blocks, so that blocks in another order are found too; at last, lines of shared runs that short lines in
another order kept from aligning are taken too. Aligned blocks of enough words are deleted from the later document.
So, as a whole: a line goes if it lies in a run of enough words that any earlier document has.

A line is compared with white space at its ends trimmed and inner runs as one blank. Order is by doc_id. Rows of one
doc_id with different texts are told apart by the text's hash, the smaller first; rows equal in both keep the same text.
Nulls: a null text stays null; a null doc_id comes before all others. Texts without a repeated block, and empty ones,
stay as they are; what follows a deleted block keeps its line breaks. An empty table gives an empty result. Other
columns are carried along, whatever their names; n_chars, if there, is recounted where lines went.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, lean, small_batches

#: Words of a block that is deleted, at least, unless the caller says otherwise: fewer words recur by chance.
MIN_WORDS = 10


def normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, r"\s+", " "))


def sequences(docs: DataFrame) -> DataFrame:
    """(doc_id, th: the text's hash, lines array<struct(at, h, n)>): the lines that aren't blank, with position, hash and number of words."""
    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x, i: F.struct(i.alias("at"), normal(x).alias("line")))
    kept = F.transform(F.filter(lines, lambda x: x["line"] != ""), lambda x: F.struct(x["at"].alias("at"), F.xxhash64(x["line"]).alias("h"), F.size(F.split(x["line"], " ")).alias("n")))
    return docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), kept.alias("lines"))


MASK = (1 << 64) - 1


def run_hash(hashes: list[int]) -> int:
    """A run's hash as a signed number; hashes unsigned, in the order of the lines."""
    value = 0
    for h in hashes:
        value = (value * 0x9E3779B97F4A7C15 + h + (value >> 29)) & MASK
    return value - (1 << 64) if value >> 63 else value


def seed_runs(words: list[int], hashes: list[int], least: int) -> dict[tuple[int, int], int]:
    """(start, end) -> hash of each shortest run of lines that has enough words: the one from each line on, and the one up to each line."""
    n, spans, total, to = len(words), set(), 0, 0
    for start in range(n):
        while to < n and total < least:
            total += words[to]
            to += 1
        if total < least:
            break
        spans.add((start, to))
        total -= words[start]
    total, start = 0, n
    for end in range(n, 0, -1):
        while start > 0 and total < least:
            start -= 1
            total += words[start]
        if total < least:
            break
        spans.add((start, end))
        total -= words[end - 1]
    return {(a, b): run_hash(hashes[a:b]) for a, b in spans}


def shared_runs(later: list[int], words: list[int], earlier: list[int], least: int) -> set[int]:
    """Positions of the later document's lines in runs of enough words that the earlier one has anywhere.

    A line of such a run lies in the seed from it on, in the seed up to it, or, if both reach beyond the run, in the one from the run's first line on."""
    size = dict(zip(later, words, strict=True))
    parts: list[list[int]] = [[]]
    for x in earlier:
        if x in size:
            parts[-1].append(x)
        elif parts[-1]:
            parts.append([])
    known = {h for part in parts for h in seed_runs([size[x] for x in part], [x & MASK for x in part], least).values()}
    found: set[int] = set()
    for (start, end), h in seed_runs(words, [x & MASK for x in later], least).items() if known else ():
        if h in known:
            found.update(range(start, end))
    return found


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions of equal elements, increasing in both."""
    found: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once: dict[int, int] = {}
        for i in range(a0, a1):
            once[a[i]] = -1 if a[i] in once else i
        seen: dict[int, int] = {}
        for j in range(b0, b1):
            if b[j] in once:
                seen[b[j]] = -1 if b[j] in seen else j
        pairs = sorted((i, seen[x]) for x, i in once.items() if i >= 0 and seen.get(x, -1) >= 0)
        if not pairs:
            # without a line that is unique in both, each line takes its next place in the other, so that repeated lines align too
            places: dict[int, list[int]] = {}
            for j in range(b0, b1):
                places.setdefault(b[j], []).append(j)
            after = b0
            for i in range(a0, a1):
                at = bisect_left(mine, after) if (mine := places.get(a[i])) else 0
                if mine and at < len(mine):
                    found.append((i, mine[at]))
                    after = mine[at] + 1
            continue
        tails: list[int] = []
        ends: list[int] = []
        back = [-1] * len(pairs)
        for k, (_, j) in enumerate(pairs):
            at = bisect_left(tails, j)
            if at == len(tails):
                tails.append(j)
                ends.append(k)
            else:
                tails[at], ends[at] = j, k
            back[k] = ends[at - 1] if at else -1
        k, chain = ends[-1], []
        while k >= 0:
            chain.append(pairs[k])
            k = back[k]
        found += chain
        pa_, pb_ = a0, b0
        for i, j in [*reversed(chain), (a1, b1)]:
            work.append((pa_, i, pb_, j))
            pa_, pb_ = i + 1, j + 1
    return sorted(found)


def common_blocks(later: list[int], words: list[int], earlier: list[int], least: int) -> list[int]:
    """Positions of the later document's lines in common blocks of enough words.

    Alignment goes on over what is left until it finds none. Short lines in another order can win an alignment and cross or
    split a block; the lines of every run that the two share are therefore taken at last."""
    gone: set[int] = set()
    at = list(range(len(later)))
    known = set(earlier)
    while True:
        # lines that the other lacks and lines already gone break blocks; a unique value stands for each
        rest = [later[i] if i not in gone and later[i] in known else -1 for i in at]
        keys = [x if x != -1 else ("gone", i) for i, x in enumerate(rest)]
        aligned = patience(keys, earlier)
        blocks: list[list[tuple[int, int]]] = []
        for i, j in aligned:
            if blocks and blocks[-1][-1] == (i - 1, j - 1):
                blocks[-1].append((i, j))
            else:
                blocks.append([(i, j)])
        fresh = {i for block in blocks if sum(words[i] for i, _ in block) >= least for i, _ in block}
        if not fresh:
            return sorted(gone | shared_runs(later, words, earlier, least))
        gone |= fresh


def _lines(column: pa.Array) -> Iterator[tuple[list[int], list[int], list[int]]]:
    """Each row's lines as hashes, numbers of words and positions."""
    ends, flat = column.offsets.to_numpy().tolist(), column.values
    at, h, n = (flat.field(name).to_numpy() for name in ("at", "h", "n"))
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        yield h[a:b].tolist(), n[a:b].tolist(), at[a:b].tolist()


def overlaps(seqs: DataFrame, scratch: Scratch, least: int) -> DataFrame:
    """(doc_id, th, e_id, e_th): each document with the first document of each of its seeds, where that is another; distinct."""

    @lean
    def seeds(batches):
        for batch in batches:
            ids, ths, out, each = batch.column(0), batch.column(1), [], []
            for k, (hashes, words, _) in enumerate(_lines(batch.column(2))):
                found = list(set(seed_runs(words, [h & MASK for h in hashes], least).values()))
                out += found
                each += [k] * len(found)
            take = pa.array(each, pa.int64())
            yield pa.RecordBatch.from_arrays([ids.take(take), ths.take(take), pa.array(out, pa.int64())], names=["doc_id", "th", "seed"])

    kind = seqs.schema["doc_id"].dataType.simpleString()
    rows = scratch.cut(seqs.mapInArrow(seeds, f"doc_id {kind}, th long, seed long"))
    first = rows.groupBy("seed").agg(F.min(F.struct("doc_id", "th")).alias("e"), F.max(F.struct("doc_id", "th")).alias("l")).where("e <> l").select("seed", "e")
    paired = rows.join(first, "seed").select("doc_id", "th", F.col("e.doc_id").alias("e_id"), F.col("e.th").alias("e_th"))
    return paired.where(~(F.col("doc_id").eqNullSafe(F.col("e_id")) & (F.col("th") == F.col("e_th")))).distinct()


def deletions(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """(doc_id, th, gone array<int>): the positions of lines that are deleted, for documents that lose some."""
    scratch = Scratch(docs.sparkSession, "linededup")
    small_batches(docs.sparkSession)
    seqs = scratch.cut(sequences(docs).distinct())
    pairs = scratch.cut(overlaps(seqs, scratch, least))
    own = seqs.select("doc_id", "th", "lines")
    other = seqs.select(F.col("doc_id").alias("e_id"), F.col("th").alias("e_th"), F.col("lines.h").alias("earlier"))
    same = lambda a, b, c, d: a.eqNullSafe(b) & (c == d)
    held = pairs.join(own.withColumnsRenamed({"doc_id": "o_id", "th": "o_th"}), same(F.col("doc_id"), F.col("o_id"), F.col("th"), F.col("o_th")))
    held = held.select("doc_id", "th", "lines", F.col("e_id").alias("p_id"), F.col("e_th").alias("p_th"))
    held = held.join(other, same(F.col("p_id"), F.col("e_id"), F.col("p_th"), F.col("e_th"))).select("doc_id", "th", "lines", "earlier")

    @lean
    def align(batches):
        for batch in batches:
            gone = []
            for (hashes, words, at), earlier in zip(_lines(batch.column(2)), batch.column(3), strict=True):
                found = common_blocks(hashes, words, earlier.values.to_numpy().tolist(), least)
                gone.append([at[i] for i in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(gone, pa.list_(pa.int32()))], names=["doc_id", "th", "gone"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = held.mapInArrow(align, f"doc_id {kind}, th long, gone array<int>").where("size(gone) > 0")
    return scratch.cut(found.groupBy("doc_id", "th").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone")))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """(row: struct of docs' columns, text: without the deleted lines, n_deleted long)."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text")
    gone = gone.select(F.col("doc_id").alias("g_id"), F.col("th").alias("g_th"), F.col("gone").alias("gone"))
    # the texts are shuffled at any size, so that the plan doesn't turn where the deletions outgrow a broadcast
    joined = rows.join(gone.hint("merge"), F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("th") == F.col("g_th")), "left")
    lines, n = F.split("text", "\n", -1), F.size("gone")
    # gone is ascending: the lines between two deleted ones are slices
    before = lambda k: F.when(k == 0, F.lit(-1)).otherwise(F.element_at("gone", F.greatest(k, F.lit(1))))
    behind = lambda k: F.when(k == n, F.size(lines)).otherwise(F.element_at("gone", F.least(k + 1, n)))
    pieces = F.flatten(F.transform(F.sequence(F.lit(0), n), lambda k: F.slice(lines, before(k) + 2, behind(k) - before(k) - 1)))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(pieces, "\n"))
    return joined.select("row", text.alias("text"), F.coalesce(n, F.lit(0)).cast("long").alias("n_deleted"))


def deduplicated(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """docs, every row and column, with repeated blocks deleted from the later documents."""
    now = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        now["n_chars"] = F.when(F.col("n_deleted") == 0, F.col("row.n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
    return without(docs, deletions(docs, least)).select(*(now.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def digests(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_lines, n_deleted, text_sha256 of the text that is left."""
    plain = docs.select("doc_id", "text", F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long").alias("n_lines"))
    return without(plain, deletions(docs, least)).select("row.doc_id", "row.n_lines", "n_deleted", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))

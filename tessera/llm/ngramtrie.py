"""Language-model scoring through Elias-Fano n-gram tries.

The model interpolates bigrams with add-one unigrams: p(w | u) = (1 - a) c(u w) / c(u) + a p1(w), where a falls slowly
with c(u), and p1(w) = (c(w) + 1) / (N + V + 1). Documents are cut into chunks, written once, in buckets, so that
they aren't shuffled: each chunk has its distinct words and, packed, their places. A chunk asks twice, each time with one entry for each distinct thing that it has, and gets
an answer for each entry in the same order. First the shards of words sum the words' counts over training documents and
answer with them. Then the shards of pairs sum the pairs' counts, build a trie of two levels (contexts; successors below
each context; monotone pointers between; quantised smoothed probabilities, as log10 p(w | u) over its backed-off value
a p1(w)), find the chunks' pairs in it and answer with the quantised values. The trie is searched as it is packed: the context
by its high and low bits, then the successor relative to it, between the context's pointers. At last each chunk adds up what
its documents' places have. Nothing goes through the driver but a few sums, and the plan is the same at every size.

Words and pairs that are frequent weigh no more than others: a chunk asks once for each. All pairs of a context need not meet
either, as c(u) comes with the word counts: frequent contexts are spread over all shards. Shards grow with the corpus, so
a message holds fewer entries the larger it is; there are never more messages than entries.

Tokens: words between ASCII white space, A-Z lower-cased, then one end. Nulls: a null text is the empty text (one token,
the end). A null doc_id is learned from as the empty id is. Equal rows get equal results. Without training tokens N and V
are 0 and every token has p1 = 1. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.common import Scratch, lean, remainder, small_batches

#: Bytes of text of a chunk, unless one document has more, and tokens of a shard, about.
CHUNK_BYTES, SHARD_TOKENS = 4 << 20, 1_250_000
#: The unigram's weight is TOP * c(u) ** -FALL.
TOP, FALL = 0.95, 0.1
#: Steps of quantised values in 16 bits: of a logarithm to base 2, around RATIO_ZERO, and of a gain's logarithm to base 10.
RATIO_STEPS, RATIO_ZERO, GAIN_STEPS = 256, 1 << 15, 4096
#: Hashes of what no word can be, as it has a blank.
END, START = xxhash.xxh64_intdigest(b" end"), xxhash.xxh64_intdigest(b" start")
HALF = np.uint64(24)
MASK = np.uint64((1 << 24) - 1)
#: Spark's limit of a table's buckets.
MOST_BUCKETS = 100_000
#: Queries that a trie answers at once.
ASKED = 1 << 18


def token_hashes(text: str | None) -> np.ndarray:
    words = (text or "").encode().lower().split()
    return np.fromiter([*map(xxhash.xxh64_intdigest, words), END], np.uint64, len(words) + 1)


class EliasFano:
    """A monotone sequence of numbers below 2**48: low bits packed, high bits in unary. Opened, it stays packed: what is
    added is a directory, the ones before each 64 bits of the unary part."""

    @staticmethod
    def pack(values: np.ndarray) -> bytes:
        n = len(values)
        top = int(values[-1]) if n else 0
        low = max(0, (top // max(n, 1)).bit_length() - 1)
        lows = b""
        if low:
            shifts = np.arange(low, dtype=np.uint64)
            parts = (values[at : at + ASKED, None] >> shifts & np.uint64(1) for at in range(0, n, ASKED))  # each fills whole bytes
            lows = b"".join(np.packbits(p.astype(np.uint8), bitorder="little").tobytes() for p in parts)
        high = (values >> np.uint64(low)).astype(np.int64)
        unary = np.zeros(n + (int(high[-1]) if n else 0) + 1, np.uint8)
        unary[high + np.arange(n)] = 1
        return np.array([n, low, len(lows), len(unary)], np.int64).tobytes() + lows + np.packbits(unary, bitorder="little").tobytes()

    def __init__(self, buffer: bytes | memoryview):
        self.n, self.low, size, self.unary = np.frombuffer(buffer, np.int64, 4).tolist()
        self.packed = np.frombuffer(buffer, np.uint8, size, 32)
        self.bits = np.frombuffer(buffer, np.uint8, -(-self.unary // 8), 32 + size)
        self.opened = False

    def _open(self) -> None:
        """Makes the directory, for searches."""
        if not self.opened:
            blocks = -(-len(self.bits) // 8)
            self.blocks = np.zeros(blocks, "<u8")
            self.blocks.view(np.uint8)[: len(self.bits)] = self.bits
            self.ones = np.r_[0, np.cumsum(np.bitwise_count(self.blocks), dtype=np.int64)]
            self.zeros = np.arange(blocks + 1) * 64 - self.ones
            padded = np.r_[self.packed, np.zeros(8, np.uint8)]
            self.windows = np.ndarray(len(self.packed) + 1, "<u8", padded, strides=(1,))  # the 64 bits from each byte on
            self.opened = True

    def values(self) -> np.ndarray:
        """All numbers, unpacked."""
        high = np.flatnonzero(np.unpackbits(self.bits, count=self.unary, bitorder="little")) - np.arange(self.n)
        out = high.astype(np.uint64) << np.uint64(self.low)
        if self.low:
            lows = np.unpackbits(self.packed, count=self.n * self.low, bitorder="little").reshape(self.n, self.low)
            for k in range(self.low):
                out |= lows[:, k].astype(np.uint64) << np.uint64(k)
        return out

    def _select(self, before: np.ndarray, blocks: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The place of the k-th set bit of blocks, counted from 0; before: the set bits before each block."""
        block = np.searchsorted(before, k, "right") - 1
        word, left, place = blocks[block], (k - before[block]).astype(np.uint64), block * 64
        for half in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count(word & np.uint64((1 << half) - 1)).astype(np.uint64)
            over = left >= count
            left = np.where(over, left - count, left)
            word = np.where(over, word >> np.uint64(half), word)
            place = place + over * half
        return place

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(at), np.uint64)
        bit = at * self.low
        return (self.windows[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.low) - 1)

    def at(self, places: np.ndarray) -> np.ndarray:
        """The numbers at places."""
        self._open()
        high = self._select(self.ones, self.blocks, places) - places
        return (high.astype(np.uint64) << np.uint64(self.low)) | self._low(places)

    def _bucket(self, high: np.ndarray) -> np.ndarray:
        """How many numbers have a smaller high part: the zeros before them are as many as the part."""
        out = np.zeros(len(high), np.int64)
        some = high > 0
        beyond = high >= self.unary - self.n
        look = some & ~beyond
        out[beyond] = self.n
        k = high[look] - 1
        out[look] = self._select(self.zeros, ~self.blocks, k) - k
        return out

    def successor(self, wanted: np.ndarray, first: np.ndarray | int = 0, last: np.ndarray | None = None) -> np.ndarray:
        """The first place in [first, last) whose value isn't below the wanted one; last if there is none."""
        self._open()
        high, rest = (wanted >> np.uint64(self.low)).astype(np.int64), wanted & np.uint64((1 << self.low) - 1)
        least = np.broadcast_to(np.asarray(first, np.int64), wanted.shape)
        most = np.full(wanted.shape, self.n, np.int64) if last is None else np.asarray(last, np.int64)
        low = np.clip(self._bucket(high), least, most)
        end = np.clip(self._bucket(high + 1), least, most)
        while len(open_ := np.flatnonzero(low < end)):
            mid = (low[open_] + end[open_]) >> 1
            less = self._low(mid) < rest[open_]
            low[open_[less]] = mid[less] + 1
            end[open_[~less]] = mid[~less]
        return low


class Trie:
    """Two levels over one buffer: contexts, pointers to their successors, successors made monotone by adding their
    context's number, quantised values. Opened and searched as the buffer is."""

    @staticmethod
    def build(pairs: np.ndarray, codes: np.ndarray) -> bytes:
        """pairs: distinct 48-bit numbers, ascending: context in the upper half, successor in the lower. codes: 16 bits each, not 0."""
        context = pairs >> HALF
        new = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(pairs) else np.zeros(0, np.int64)
        number = np.repeat(np.arange(len(new), dtype=np.uint64), np.diff(np.r_[new, len(pairs)]))
        levels = [EliasFano.pack(context[new]), EliasFano.pack(np.r_[new, len(pairs)].astype(np.uint64)), EliasFano.pack((number << HALF) | (pairs & MASK)), codes.astype(np.uint16).tobytes()]
        return np.array([len(x) for x in levels], np.int64).tobytes() + b"".join(levels)

    def __init__(self, buffer: bytes):
        sizes = np.frombuffer(buffer, np.int64, 4).tolist()
        view, at, parts = memoryview(buffer), 32, []
        for size in sizes:
            parts.append(view[at : at + size])
            at += size
        self.contexts, self.pointers, self.successors = map(EliasFano, parts[:3])
        self.codes = np.frombuffer(parts[3], np.uint16)

    def look_up(self, pairs: np.ndarray) -> np.ndarray:
        """The codes of pairs; 0 for those that the trie lacks."""
        out = np.zeros(len(pairs), np.uint16)
        for at in range(0, len(pairs) if len(self.codes) else 0, ASKED):
            part = pairs[at : at + ASKED]
            context = part >> HALF
            node = np.minimum(self.contexts.successor(context), self.contexts.n - 1)
            there = np.flatnonzero(self.contexts.at(node) == context)
            node = node[there]
            wanted = (node.astype(np.uint64) << HALF) | (part[there] & MASK)
            ends = self.pointers.at(node + 1).astype(np.int64)
            found = self.successors.successor(wanted, self.pointers.at(node).astype(np.int64), ends)
            inside = found < ends
            there, wanted, found = there[inside], wanted[inside], found[inside]
            same = self.successors.at(found) == wanted
            out[at + there[same]] = self.codes[found[same]]
        return out


def _narrow(numbers: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs."""
    top = int(numbers.max()) if len(numbers) else 0
    size = next(s for s in (1, 2, 4, 8) if top < 1 << (8 * s))
    return bytes([size]) + numbers.astype(f"<u{size}").tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1)


def _grouped(batches, key: str) -> Iterator[list[dict]]:
    """Lists of rows (dicts) of equal key, of batches in the key's order."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[-1][key] != row[key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _rows(columns: dict[str, pa.DataType], rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(name) for r in rows], kind) for name, kind in columns.items()], names=list(columns))


def _mixed(context: np.ndarray, word: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The pair's shard and its 48-bit number in the shard."""
    x = (context * np.uint64(0x9E3779B97F4A7C15)) ^ (word + (context >> np.uint64(31)))
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return ((x >> np.uint64(24)) % np.uint64(shards)).astype(np.int64), ((context >> np.uint64(40)) << HALF) | (word >> np.uint64(40))


def bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of 64-bit keys in a bucketed table: Spark's hash (Murmur3 of 32 bits, seed 42), modulo buckets."""
    turn = lambda x, k: (x << np.uint32(k)) | (x >> np.uint32(32 - k))
    h = np.full(len(keys), 42, np.uint32)
    for part in (keys & np.uint64(0xFFFFFFFF), keys >> np.uint64(32)):
        h = turn(h ^ (turn(part.astype(np.uint32) * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)), 13) * np.uint32(5) + np.uint32(0xE6546B64)
    h ^= np.uint32(8)
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return (h ^ (h >> np.uint32(16))).view(np.int32).astype(np.int64) % buckets


def _chunk_numbers(task: int, buckets: int) -> Iterator[int]:
    """Numbers for a task's chunks that all fall into one bucket, so that the task writes one file."""
    at = task << 40
    while True:
        block = np.arange(at, at + (1 << 16), dtype=np.uint64)
        yield from block[bucket(block, buckets) == task % buckets].tolist()
        at += 1 << 16


def _packed_chunk(chunk: int, ids: list, texts: list[np.ndarray], train: np.ndarray) -> dict:
    """A chunk of documents: distinct words (hashes, the most frequent first), how often training documents have each, and all places' words by number."""
    size = np.array([len(t) for t in texts])
    words, places = np.unique(np.concatenate(texts), return_inverse=True)
    learned = np.bincount(places[np.repeat(train, size)], minlength=len(words))
    # frequent words get small numbers, which a general compressor makes short
    order = np.argsort(-np.bincount(places, minlength=len(words)), kind="stable")
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    kept = _narrow(rank[places])
    return {
        "chunk": chunk, "ids": ids, "sizes": size.tolist(), "train": np.packbits(train).tobytes(), "words": words[order].tobytes(), "learned": _narrow(learned[order]),
        "length": len(kept), "places": pa.compress(kept, "zstd", asbytes=True),
    }


def _word_messages(row: dict, shards: int) -> Iterator[dict]:
    """What a chunk asks: its distinct words, in ranges of hashes, and how often its training documents have them."""
    words, learned = np.frombuffer(row["words"], np.uint64), _wide(row["learned"])
    order = np.argsort(words)
    words, learned = words[order], learned[order]
    shard = ((words >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
    cuts = np.r_[0, np.flatnonzero(shard[1:] != shard[:-1]) + 1, len(words)]
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield {"shard": int(shard[a]), "chunk": row["chunk"], "first": words[a:a + 1].tobytes(), "words": EliasFano.pack(words[a:b] - words[a]), "learned": _narrow(learned[a:b])}


def _summed(rows: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct numbers, ascending, the sums of their counts, and for each row the places of its numbers."""
    distinct, where = np.unique(np.concatenate(rows), return_inverse=True)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, where, np.concatenate(counts).astype(np.int64))
    return distinct, sums, np.split(where, np.cumsum([len(r) for r in rows])[:-1])


def _word_answers(rows: list[dict]) -> Iterator[dict]:
    """To each chunk of a shard of words their counts; the first answer has the shard's sum and number of learned words too."""
    _, counts, where = _summed([EliasFano(r["words"]).values() + np.frombuffer(r["first"], np.uint64) for r in rows], [_wide(r["learned"]) for r in rows])
    n, types = int(counts.sum()), int((counts > 0).sum())
    for r, at in zip(rows, where, strict=True):
        yield {"chunk": r["chunk"], "shard": r["shard"], "answer": _narrow(counts[at]), "n": n, "types": types}
        n = types = 0


def _in_order(answers: list[dict] | None) -> list[dict]:
    return sorted(answers or [], key=lambda r: r["shard"])


class Places:
    """A chunk with the counts of its words: the logarithms of its places' backed-off probabilities, and its distinct pairs in the order of their shards."""

    def __init__(self, own: dict, total: int, types: int, starts: int, shards: int):
        self.ids, self.size = own["ids"], np.array(own["sizes"])
        words = np.r_[np.frombuffer(own["words"], np.uint64), np.uint64(START)]
        count = np.empty(len(words), np.int64)
        count[np.argsort(words[:-1])] = np.concatenate([_wide(r["answer"]) for r in _in_order(own["counts"])])
        count[-1] = starts
        place = _wide(pa.decompress(own["places"], own["length"], "zstd", asbytes=True)).astype(np.int64)
        before = np.r_[0, place[:-1]]
        before[np.cumsum(self.size) - self.size] = len(words) - 1
        self.document = np.repeat(np.arange(len(self.size)), self.size)
        base = np.log10(count + 1.0) - math.log10(total + types + 1)
        weight = np.where(count > 0, TOP * np.maximum(count, 1.0) ** -FALL, 1.0)
        self.known, self.base = self.sums(count[place] > 0), self.sums(base[place])
        self.plain = base[place] + np.log10(weight)[before]
        # a pair can have been learned only if its context and its word were
        self.seen = np.flatnonzero((count[before] > 0) & (count[place] > 0))
        n = np.int64(len(words))
        pairs, where = np.unique(before[self.seen] * n + place[self.seen], return_inverse=True)
        context, word = pairs // n, pairs % n
        shard, number = _mixed(words[context], words[word], shards)
        order = np.lexsort((number, shard))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.pair, self.shard, self.number = rank[where], shard[order], number[order]
        train = np.unpackbits(np.frombuffer(own["train"], np.uint8), count=len(self.size)).astype(bool)
        self.learned = np.bincount(self.pair[train[self.document[self.seen]]], minlength=len(order))
        # log2 of a p1(w) c(u) / (1 - a), which c(u w) is held against
        ratio = (np.log2(weight / (1.0 - np.minimum(weight, TOP)) * np.maximum(count, 1)))[context] + base[word] * math.log2(10)
        self.ratio = np.clip(np.round(RATIO_STEPS * ratio) + RATIO_ZERO, 0, (1 << 16) - 1).astype(np.uint16)[order]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """A document's sum, of values of places."""
        return np.bincount(self.document, values, len(self.size))

    def messages(self, chunk: int) -> Iterator[dict]:
        """What the chunk asks the shards of pairs."""
        cuts = np.r_[0, np.flatnonzero(self.shard[1:] != self.shard[:-1]) + 1, len(self.shard)] if len(self.shard) else np.zeros(1, np.int64)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield {"shard": int(self.shard[a]), "chunk": chunk, "pairs": EliasFano.pack(self.number[a:b]), "learned": _narrow(self.learned[a:b]), "ratios": self.ratio[a:b].tobytes()}

    def scores(self, answers: list[dict] | None) -> np.ndarray:
        """The documents' log10 probabilities, with what their pairs gain over the backed-off values."""
        codes = np.concatenate([np.zeros(0, np.uint16), *(np.frombuffer(r["answer"], np.uint16) for r in _in_order(answers))])
        if len(codes) != len(self.shard):
            raise ValueError("a chunk's pairs are not all answered")
        score = self.plain.copy()
        score[self.seen] += codes[self.pair] / GAIN_STEPS
        return self.sums(score)


def _pair_answers(rows: list[dict]) -> Iterator[dict]:
    """To each chunk of a shard of pairs the trie's codes of them."""
    asked = [EliasFano(r["pairs"]).values() for r in rows]
    pairs, counts, where = _summed(asked, [_wide(r["learned"]) for r in rows])
    ratio = np.zeros(len(pairs), np.int64)
    np.maximum.at(ratio, np.concatenate(where), np.concatenate([np.frombuffer(r["ratios"], np.uint16) for r in rows]).astype(np.int64))
    gain = np.log10(1 + counts / 2.0 ** ((ratio - RATIO_ZERO) / RATIO_STEPS))
    codes = np.clip(np.round(gain * GAIN_STEPS), 1, (1 << 16) - 1).astype(np.uint16)
    learned = counts > 0
    found = Trie(Trie.build(pairs[learned], codes[learned])).look_up(pairs)
    for r, at in zip(rows, where, strict=True):
        yield {"chunk": r["chunk"], "shard": r["shard"], "answer": found[at].tobytes()}


def score(docs: DataFrame, train, chunk_bytes: int = CHUNK_BYTES, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score. train: a condition on docs that tells which rows are learned from."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "ngramtrie")
    small_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    size, learned = plain.agg(F.sum(F.octet_length("text") / 5 + 1), F.sum(F.col("train").cast("long"))).first()
    shards = max(4, -(-int(size or 0) // shard_tokens))
    starts = int(learned or 0)
    binary, long = pa.binary(), pa.int64()

    own_columns = {"chunk": long, "ids": pa.list_(id_type), "sizes": pa.list_(long), "train": binary, "words": binary, "learned": binary, "length": long, "places": binary}
    own_schema = f"chunk long, ids array<{kind}>, sizes array<long>, train binary, words binary, learned binary, length long, places binary"
    buckets = min(shards, MOST_BUCKETS)

    def cut(batches):
        """Chunks of documents, over batches."""
        numbers, ids, texts, flags, held = _chunk_numbers(TaskContext.get().partitionId(), buckets), [], [], [], 0
        for batch in batches:
            for id_, text, flag in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if ids and held + len(text) > chunk_bytes:
                    yield _rows(own_columns, [_packed_chunk(next(numbers), ids, texts, np.array(flags, bool))])
                    ids, texts, flags, held = [], [], [], 0
                ids.append(id_)
                texts.append(token_hashes(text))
                flags.append(flag)
                held += len(text) + 1
        if ids:
            yield _rows(own_columns, [_packed_chunk(next(numbers), ids, texts, np.array(flags, bool))])

    # written, so that a task that runs again can't cut other chunks, and in buckets, so that answers go to the chunks
    chunks = scratch.bucketed(plain.mapInArrow(lean(cut), own_schema), "chunk", buckets)

    def ask_words(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield _rows({"shard": pa.int32(), "chunk": long, "first": binary, "words": binary, "learned": binary}, list(_word_messages(row, shards)))

    def answer_words(batches):
        for rows in _grouped(batches, "shard"):
            yield _rows({"chunk": long, "shard": pa.int32(), "answer": binary, "n": long, "types": long}, list(_word_answers(rows)))

    asked = chunks.select("chunk", "words", "learned").mapInArrow(lean(ask_words), "shard int, chunk long, first binary, words binary, learned binary")
    counted = asked.repartition(shards, "shard").sortWithinPartitions("shard", "chunk")
    counted = scratch.cut(counted.mapInArrow(lean(answer_words), "chunk long, shard int, answer binary, n long, types long"))
    total, types = (int(x or 0) for x in counted.agg(F.sum("n"), F.sum("types")).first())

    def by_chunk(answers: DataFrame, name: str) -> DataFrame:
        """A chunk's answers, one for each message that it sent, partitioned as the chunks are."""
        return answers.repartition(buckets, "chunk").groupBy("chunk").agg(F.collect_list(F.struct("shard", "answer")).alias(name)).hint("merge")

    own = chunks.drop("learned").join(by_chunk(counted, "counts"), "chunk")

    def ask_pairs(batches):
        for batch in batches:
            for row in batch.to_pylist():
                places = Places(row, total, types, starts, shards)
                yield _rows({"shard": pa.int32(), "chunk": long, "pairs": binary, "learned": binary, "ratios": binary}, list(places.messages(row["chunk"])))

    def answer_pairs(batches):
        for rows in _grouped(batches, "shard"):
            yield _rows({"chunk": long, "shard": pa.int32(), "answer": binary}, list(_pair_answers(rows)))

    def finish(batches):
        for batch in batches:
            for row in batch.to_pylist():
                places = Places(row, total, types, starts, shards)
                columns = [pa.array(places.ids, id_type), pa.array(places.size, long), pa.array(places.known.astype(np.int64), long), pa.array(places.base), pa.array(places.scores(row["codes"]))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    sent = own.mapInArrow(lean(ask_pairs), "shard int, chunk long, pairs binary, learned binary, ratios binary")
    found = sent.repartition(shards, "shard").sortWithinPartitions("shard", "chunk").mapInArrow(lean(answer_pairs), "chunk long, shard int, answer binary")
    done = own.join(by_chunk(found, "codes"), "chunk", "left").mapInArrow(lean(finish), f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
    return done.select("doc_id", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def held_out(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; learned where crc32(doc_id) mod 7 is not 2."""
    scored = score(docs, remainder(F.col("doc_id"), 7) != 2, chunk_bytes, shard_tokens)
    return scored.select("doc_id", (remainder(F.col("doc_id"), 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")

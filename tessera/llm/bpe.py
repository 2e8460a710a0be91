"""Byte-level BPE encoding and decoding.

Pre-tokenisation works on arrays: each code point gets a class (letter, number, white space, other), the classes with
one or two characters of look-ahead give a symbol, and an eight-state automaton over the symbols tells where a piece
begins. The automaton runs as an associative scan: blocks of the text are reduced to transition functions (state ->
state) side by side, the functions are composed to get each block's entry state, and a second pass over all blocks at
once marks the boundaries. No regular expression is used. The slices between boundaries go through pair merging,
which is cached by slice.

Nulls: a null text is encoded as the empty text. Empty texts give no ids. Rows are independent, so repeated rows and
ties keep their multiplicity; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructType

from tessera.llm.common import lean, small_batches

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: A vocabulary file is shipped to the executors whole; larger files are refused.
MAX_VOCABULARY_BYTES = 64 << 20
#: Slices whose ids one Python worker remembers.
CACHE = 250_000
#: Code points that are scanned at once, and the length of a block in the scan.
SPAN, BLOCK = 1 << 20, 512
#: Longer slices, in bytes, are merged one by one with a heap; a rank above all ranks.
WIDEST, NONE = 64, 1 << 40

# The White_Space property, code points of \s in the pattern.
WHITE_SPACE = [0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Letters that make a contraction with the apostrophe before them.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")

# Letters and numbers of Unicode 16, which the library's pattern knows, that databases before it lack.
LETTERS_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B),
    (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NUMBERS_16 = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]

LETTER, NUMBER, OTHER, SPACE = range(4)
# Symbols: a class, or with look-ahead: white space before more of it or the end; the last white space of a run that
# is no plain blank; the last that is one; an apostrophe before a contraction of one or two letters; a text's end.
S_LETTER, S_NUMBER, S_OTHER, S_RUN, S_LAST, S_BLANK, S_ONE, S_TWO, S_END = range(9)
# States: a piece is complete, or is of letters, numbers, others or white space, or is a blank that the next piece
# takes in, or a contraction that lacks one or two letters.
DONE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACE, AT_BLANK, LACKS_ONE, LACKS_TWO = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a piece begins, at [symbol * 8 + state]."""
    fresh = {S_LETTER: IN_LETTERS, S_NUMBER: IN_NUMBERS, S_OTHER: IN_OTHERS, S_RUN: IN_SPACE, S_LAST: DONE, S_BLANK: AT_BLANK, S_ONE: LACKS_ONE, S_TWO: LACKS_TWO, S_END: DONE}
    goes_on = {(IN_LETTERS, S_LETTER): IN_LETTERS, (IN_NUMBERS, S_NUMBER): IN_NUMBERS, (IN_SPACE, S_RUN): IN_SPACE, (AT_BLANK, S_LETTER): IN_LETTERS, (AT_BLANK, S_NUMBER): IN_NUMBERS}
    goes_on |= {(state, symbol): IN_OTHERS for state in (IN_OTHERS, AT_BLANK) for symbol in (S_OTHER, S_ONE, S_TWO)}
    goes_on |= {(LACKS_TWO, symbol): LACKS_ONE for symbol in range(S_END)} | {(LACKS_ONE, symbol): DONE for symbol in range(S_END)}
    following, begins = np.zeros(72, np.uint8), np.zeros(72, bool)
    for symbol in range(9):
        for state in range(8):
            following[symbol * 8 + state] = goes_on.get((state, symbol), fresh[symbol])
            begins[symbol * 8 + state] = (state, symbol) not in goes_on
    return following, begins


FOLLOWING, BEGINS = _automaton()
_classes: np.ndarray | None = None


def classes() -> np.ndarray:
    """The class of every code point, from its general category by Unicode 16."""
    global _classes
    if _classes is None:
        kinds = {"L": LETTER, "N": NUMBER}
        _classes = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
        for ranges, kind in ((LETTERS_16, LETTER), (NUMBERS_16, NUMBER)):
            for first, last in ranges:
                _classes[first : last + 1] = kind
        _classes[WHITE_SPACE] = SPACE
    return _classes


def symbols(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """points: the texts' code points, each text followed by one separator; ends: where the separators are."""
    kind = classes()[points]
    out = kind.copy()
    space = kind == SPACE
    space[ends] = False
    stop = np.zeros(len(points), bool)
    stop[ends] = True
    more = np.zeros(len(points), bool)
    more[:-1] = space[1:] | stop[1:]
    out[space] = np.where(more[space], S_RUN, np.where(points[space] == 0x20, S_BLANK, S_LAST))
    at = np.flatnonzero(points == 0x27)
    at = at[at + 1 < len(points)]
    if len(at):
        after = points[at + 1]
        out[at[np.isin(after, [ord(c) for c in ONE_LETTER])]] = S_ONE
        then = points[np.minimum(at + 2, len(points) - 1)]
        for a, b in TWO_LETTERS:
            out[at[(after == ord(a)) & (then == ord(b))]] = S_TWO
    out[ends] = S_END
    return out


def boundaries(symbol: np.ndarray, state: int = DONE) -> tuple[np.ndarray, int]:
    """Where pieces begin, and the state behind the last symbol, for one span of symbols entered in a state."""
    n = len(symbol)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, S_END, np.uint8)
    padded[:n] = symbol
    columns = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T) * np.uint8(8)
    maps = np.tile(np.arange(8, dtype=np.uint8), (blocks, 1))
    for column in columns:
        maps = FOLLOWING[maps + column[:, None]]
    entry = np.empty(blocks, np.uint8)
    now = state
    for i, m in enumerate(maps.tolist()):
        entry[i] = now
        now = m[now]
    starts = np.empty((BLOCK, blocks), bool)
    states = entry
    last = None
    for k, column in enumerate(columns):
        at = column + states
        starts[k] = BEGINS[at]
        states = FOLLOWING[at]
        if k == (n - 1) % BLOCK:
            last = int(states[-1])
    return np.flatnonzero(starts.T.reshape(-1)[:n]), last if n else state


def piece_starts(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All boundaries of the texts, the separators' own included; long inputs go span by span."""
    symbol = symbols(points, ends)
    found, state = [], DONE
    for at in range(0, len(symbol), SPAN):
        starts, state = boundaries(symbol[at : at + SPAN], state)
        found.append(starts + at)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}


class Encoder:
    """Ranks, the pairs that merge, and a cache of slices. Slices that the cache lacks are merged together, as the rows
    of a matrix: each round merges every row's pair of the lowest rank, leftmost first."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.cache: dict[str, tuple[int, ...]] = {}
        if max(ranks.values(), default=0) >= 1 << 31:
            raise ValueError("ranks must be below 2**31")
        pairs = sorted(((ranks[t[:i]] << 32) | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks)
        self.keys = np.array([k for k, _ in pairs] or [-1], np.int64)
        self.merges = np.array([r for _, r in pairs] or [0], np.int64)
        self.single = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each merged pair; NONE for pairs that don't merge."""
        wanted = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.merges[at], NONE)

    def merged(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        out: list[tuple[int, ...]] = [()] * len(pieces)
        groups: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = (whole,)
            elif len(piece) > WIDEST:
                out[i] = self._long(piece)
            else:
                groups.setdefault(max(4, 1 << (len(piece) - 1).bit_length()), []).append(i)
        for width, members in groups.items():
            for i, ids in zip(members, self._matrix([pieces[i] for i in members], width), strict=True):
                out[i] = ids
        return out

    def _matrix(self, pieces: list[bytes], width: int) -> list[tuple[int, ...]]:
        n = len(pieces)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        length = np.fromiter(map(len, pieces), np.int64, n)
        column = np.arange(width)
        ids = np.where(column < length[:, None], self.single[raw], -1)
        following = np.minimum(column + 1, length[:, None])
        before = np.broadcast_to(column - 1, (n, width)).copy()
        rank = np.full((n, width), NONE)
        there = column[:-1] < length[:, None] - 1
        rank[:, :-1][there] = self.pair_ranks(ids[:, :-1][there], ids[:, 1:][there])
        rows = np.arange(n)
        while len(rows):
            at = rank[rows].argmin(1)
            best = rank[rows, at]
            going = best < NONE
            rows, at, best = rows[going], at[going], best[going]
            gone = following[rows, at]
            after = following[rows, gone]
            ids[rows, at], ids[rows, gone] = best, -1
            rank[rows, gone] = NONE
            following[rows, at] = after
            fresh = np.full(len(rows), NONE)
            more = after < length[rows]
            before[rows[more], after[more]] = at[more]
            fresh[more] = self.pair_ranks(best[more], ids[rows[more], after[more]])
            rank[rows, at] = fresh
            front = before[rows, at]
            some = front >= 0
            rank[rows[some], front[some]] = self.pair_ranks(ids[rows[some], front[some]], best[some])
        kept = ids >= 0
        flat, ends = ids[kept].tolist(), np.cumsum(kept.sum(1)).tolist()
        return [tuple(flat[a:b]) for a, b in zip([0, *ends], ends, strict=False)]

    def _long(self, piece: bytes) -> tuple[int, ...]:
        """The same with a heap and linked parts, for slices of any length."""
        ranks, n = self.ranks, len(piece)
        end, following, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, to = heapq.heappop(heap)
            j = following[i]
            if not alive[i] or j >= n or end[j] != to:
                continue
            alive[j] = False
            end[i], following[i] = to, following[j]
            if following[i] < n:
                before[following[i]] = i
                if (r := ranks.get(piece[i : end[following[i]]])) is not None:
                    heapq.heappush(heap, (r, i, end[following[i]]))
            if before[i] >= 0 and (r := ranks.get(piece[before[i] : to])) is not None:
                heapq.heappush(heap, (r, before[i], to))
        return tuple(ranks[piece[i : end[i]]] for i in range(n) if alive[i])

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
        """Ids and the code point offset of each piece, for each text."""
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
        starts = piece_starts(points, ends)
        slots = np.searchsorted(starts, ends).tolist()
        pieces = [joined[a:b] for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(joined)], strict=True)]
        lacking = list(set(pieces).difference(self.cache))
        if len(self.cache) + len(lacking) > CACHE:
            self.cache = {p: ids for p in set(pieces) if (ids := self.cache.get(p)) is not None}
        self.cache.update(zip(lacking, self.merged([p.encode() for p in lacking]), strict=True))
        get, first, at = self.cache.__getitem__, 0, 0
        for slot, end in zip(slots, ends.tolist(), strict=True):
            yield list(chain.from_iterable(map(get, pieces[first:slot]))), starts[first:slot] - at
            first, at = slot + 1, end + 1


_encoders: dict[str, Encoder] = {}


def _encoder(key: str, content: bytes) -> Encoder:
    """One encoder for each Python worker and vocabulary."""
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(parse_ranks(content))
    return _encoders[key]


def _shipped(spark: SparkSession, path: str):
    with open(path, "rb") as f:
        content = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(content) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path}: over {MAX_VOCABULARY_BYTES} bytes")
    return spark.sparkContext.broadcast(content)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.concatenate(values).astype(np.int32) if values else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def _encoding(path: str, shipped, offsets: bool):
    """A function of a task's batches (doc_id, text): doc_id, ids and, if asked for, offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, shipped.value)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts, size, to = [], 0, at
                while to < batch.num_rows and (to == at or size <= SPAN):
                    texts.append(batch.column(1)[to].as_py())
                    size += len(texts[-1])
                    to += 1
                ids, places = [], []
                for i, o in encoder.encode(texts):
                    ids.append(np.array(i, np.int32))
                    places.append(o)
                columns = [batch.column(0).slice(at, to - at), _lists(ids, pa.int32())] + [_lists(places, pa.int32())] * offsets
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "offsets"][: 2 + offsets])
                at = to

    return run


def _decoding(shipped, at: int):
    """A function of a task's batches, of whose columns the one at a place holds ids: the same with decoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: list[bytes] | None = None
        for batch in batches:
            if table is None:
                ranks = parse_ranks(shipped.value)
                table = [b""] * (max(ranks.values(), default=-1) + 1)
                for piece, rank in ranks.items():
                    table[rank] = piece
            lists = batch.column(at)
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            get = table.__getitem__
            decoded = [b"".join(map(get, flat[a:b].tolist())) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], names=[*batch.schema.names, "decoded"])

    return run


def _plain(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def encode(docs: DataFrame, path: str, offsets: bool = True) -> DataFrame:
    """doc_id, ids array<int> and, if asked for, offsets array<int>: the code point at which each pre-token begins."""
    run = _encoding(path, _shipped(docs.sparkSession, path), offsets)
    return _plain(docs).mapInArrow(lean(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>" + ", offsets array<int>" * offsets)


def pieces(encoded: DataFrame) -> DataFrame:
    """Every column of what decode() gives, and pieces array<string>: the decoded text cut at its offsets, which are the pre-tokens again."""
    text, n = F.col("decoded").cast("string"), F.size("offsets")
    to = lambda i: F.when(i + 1 < n, F.get("offsets", i + 1)).otherwise(F.length(text))
    return encoded.withColumn("pieces", F.transform("offsets", lambda start, i: F.substring(text, start + 1, to(i) - start)))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Every column of encoded and `decoded`, the bytes that its ids stand for."""
    run = _decoding(_shipped(encoded.sparkSession, path), encoded.columns.index("ids"))
    return encoded.mapInArrow(lean(run), StructType(list(encoded.schema.fields)).add("decoded", BinaryType()))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, offsets and decoded: encode() and decode() in one worker, so that ids needn't go to the JVM and back."""
    shipped = _shipped(docs.sparkSession, path)
    first, second = _encoding(path, shipped, True), _decoding(shipped, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return second(first(batches))

    return _plain(docs).mapInArrow(lean(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>, offsets array<int>, decoded binary")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, n_pieces: what encode() and decode() give, as digests; n_pieces counts the offsets."""
    return round_trip(docs, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.size("offsets").cast("long").alias("n_pieces"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

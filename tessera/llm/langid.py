"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, of its own, made from its code point. A trigram's vector binds (multiplies) the first letter's vector permuted
twice, the second's permuted once and the third's. A document's vector bundles (adds) its trigrams' vectors, and a
language's prototype bundles the vectors, each of length one, of a bounded sample of its labelled documents. The
prototype of the greatest cosine names the language; the score is a softmax over the cosines.

Letters are lower-cased; runs of other characters are one blank, which has a vector too. Nulls: a null text, or one without a letter, is `und` with score 0; rows whose language is null are not
learned from. Ties of cosines go to the first language in order. Equal texts get equal results. Without a labelled row
every language is `und`. Very long texts are read whole, in slices. An empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import lean, remainder, sampled, small_batches

#: Labelled documents that the prototypes are fitted on, about; length of the vectors; seed.
MAX_TRAIN, SIZE, SEED = 20_000, 1024, 20
#: Sharpness of the softmax over cosines.
SHARPNESS = 40.0
#: Trigram vectors that one Python worker remembers.
HELD = 50_000
#: Characters of a text that are counted at once.
SLICE = 1 << 20
#: Bits of a code point.
WIDE = 21

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """The lower-case letter of each code point; 0 of those that aren't letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((ord(chr(c).lower()[0]) if chr(c).isalpha() else 0 for c in range(0x110000)), np.uint32, 0x110000)
    return _letters


def letter_vector(point: int) -> np.ndarray:
    """The vector of a letter, or of the blank (0)."""
    return np.random.default_rng([SEED, point]).choice(np.array([-1, 1], np.int8), SIZE)


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the text's trigrams of letters; none if it has no letter."""
    codes, counts = [], []
    carry = np.zeros(1, np.int64)
    for at in range(0, len(text), SLICE):
        s = letters()[np.frombuffer(text[at : at + SLICE].encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)
        s = np.concatenate([carry, s] if at + SLICE < len(text) else [carry, s, [0]])
        s = s[np.r_[True, (s[1:] != 0) | (s[:-1] != 0)]]  # a run of blanks is one
        carry = s[-2:]
        if len(s) > 2:
            c, n = np.unique((s[:-2] << 2 * WIDE) | (s[1:-1] << WIDE) | s[2:], return_counts=True)
            codes.append(c)
            counts.append(n)
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(codes) == 1:
        return codes[0], counts[0]
    code, at = np.unique(np.concatenate(codes), return_inverse=True)
    return code, np.bincount(at, np.concatenate(counts)).astype(np.int64)


class Binder:
    """Vectors of trigram codes, made when first asked for; all are forgotten when they would be more than HELD and one text's."""

    def __init__(self):
        self.row: dict[int, int] = {}
        self.known: dict[int, np.ndarray] = {}
        self.vectors = np.zeros((1024, SIZE), np.int8)

    def letter(self, point: int) -> np.ndarray:
        if point not in self.known:
            self.known[point] = letter_vector(point)
        return self.known[point]

    def rows(self, codes: list[int]) -> list[int]:
        lacking = [c for c in codes if c not in self.row]
        if lacking and len(self.row) + len(lacking) > HELD:
            self.row.clear()
            self.known.clear()
            lacking = codes
        if lacking:
            mask = (1 << WIDE) - 1
            a, b, c = (np.stack([self.letter(x >> shift & mask) for x in lacking]) for shift in (2 * WIDE, WIDE, 0))
            n = len(self.row)
            while n + len(lacking) > len(self.vectors):
                self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
            self.vectors[n : n + len(lacking)] = np.roll(a, 2, axis=1) * np.roll(b, 1, axis=1) * c
            self.row.update(zip(lacking, range(n, n + len(lacking)), strict=True))
        return [self.row[c] for c in codes]

    def bundle(self, text: str) -> np.ndarray | None:
        """The text's vector; null if it has no letter."""
        codes, counts = trigrams(text)
        if not len(codes) or not codes.any():
            return None
        out = np.zeros(SIZE, np.float32)
        for at in range(0, len(codes), 4096):
            rows = self.rows(codes[at : at + 4096].tolist())
            out += counts[at : at + 4096].astype(np.float32) @ self.vectors[rows].astype(np.float32)
        return out


_binder: Binder | None = None


def binder() -> Binder:
    global _binder
    if _binder is None:
        _binder = Binder()
    return _binder


def fit(docs: DataFrame, max_train: int = MAX_TRAIN) -> dict[str, np.ndarray]:
    """A prototype of length one for each language of docs (text, lang)."""
    train = sampled(docs.where("lang is not null").select("doc_id", "text", "lang"), F.struct("doc_id", F.xxhash64("text")), max_train).select("lang", "text")

    @lean
    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                v = binder().bundle(text.as_py() or "")
                if v is not None and (norm := float(np.linalg.norm(v))):
                    sums[lang] = sums.get(lang, 0) + (v / norm).astype(np.float64)
        for lang, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([v.tolist()], pa.list_(pa.float64()))], names=["lang", "v"])

    parts = train.mapInArrow(run, "lang string, v array<double>")
    found = parts.select("lang", F.posexplode("v").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x")).groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("v"))
    out = {}
    for r in found.collect():  # a vector for each language
        v = np.array([x["x"] for x in r["v"]])
        if norm := float(np.linalg.norm(v)):
            out[r["lang"]] = (v / norm).astype(np.float32)
    return dict(sorted(out.items()))


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, lang_pred, score, cosine."""
    small_batches(docs.sparkSession)
    names = list(prototypes)
    matrix = np.stack(list(prototypes.values())) if names else np.zeros((0, SIZE), np.float32)

    @lean
    def run(batches):
        for batch in batches:
            langs, scores, cosines = [], [], []
            for text in batch.column(1):
                v = binder().bundle(text.as_py() or "") if names else None
                norm = 0.0 if v is None else float(np.linalg.norm(v))
                if not norm:
                    langs.append("und")
                    scores.append(0.0)
                    cosines.append(0.0)
                    continue
                c = np.round((matrix @ v / norm).astype(np.float64), 6)
                best = int(c.argmax())
                langs.append(names[best])
                scores.append(float(1 / np.exp(SHARPNESS * (c - c[best])).sum()))
                cosines.append(float(c[best]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(cosines, pa.float64())], names=["doc_id", "lang_pred", "score", "cosine"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, cosine double")


def held_out(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, cosine; learned where crc32(doc_id) mod 4 is not 2."""
    prototypes = fit(docs.where(remainder(F.col("doc_id"), 4) != 2))
    return predict(docs, prototypes).select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "cosine")

"""Toxicity by maximum-scoring segments.

Training counts, over a bounded sample of labelled rows, the words and word prefixes of toxic and of other texts, each
context of a word once, so that copied passages count once too. A feature's score is its log-odds under an informative
Dirichlet prior, positive or negative, less a drift; a word without a feature, or whose log-odds chance may have made
or are small (a frequent word's, which would add up where it is repeated), has the drift alone. A linear scan over the scores finds every maximal scoring segment of a text (the
all-maximal-segments problem). Extreme-value theory turns a segment's score into an expected number of chance segments
of that score in a text of that length: k * words * exp(-rate * score), where the rate solves the equation of the scores
in texts that aren't toxic and k is fitted to the segments found there. Significant segments are the passages. A text's
evidence is the sum of its segments' significance; a logistic curve makes it a probability. Rate, k and curve are fitted on
a third of the sample that the features are not taken from.

Nulls: a null text is the empty text; texts without a word have no segment and get the score of no evidence. Labels
that are null or whose document is missing are not learned from; several labels of a document count as toxic if one is.
Equal rows and ties get equal scores. Without any label of either kind the model has no feature and every score is the
share of toxic labels (0 without labels). An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, lean, remainder, sampled, small_batches

#: Labelled rows that the classifier is fitted on, and features that it keeps: its bound in memory.
MAX_TRAIN, MAX_FEATURES = 20_000, 200_000
#: Least z-score of a feature, up or down, prior tokens as a share of all tokens, drift per word, expected chance segments below which a segment is significant.
MIN_Z, PRIOR, DRIFT, MAX_EXPECTED = 3.5, 0.1, 0.25, 0.05
#: Texts of each kind that the calibration's third needs; with fewer all texts are used.
MIN_HELD = 10
#: Lengths of the word prefixes that stand in for unseen words.
PREFIXES = (4, 5, 6)
#: Words that one Python worker remembers.
CACHE = 200_000
#: A text's words: runs of letters; Java's and Python's patterns for the same runs.
JAVA_SPLIT, WORD = r"[^\p{L}]+", re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    """Scores of words and prefixes (prefixes end in `*`), extreme-value parameters and the logistic curve."""

    scores: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0
    k: float = 0.1
    slope: float = 0.0
    offset: float = -20.0

    def word(self, word: str) -> float:
        found = self.scores.get(word)
        if found is None:
            for n in reversed(PREFIXES):
                if len(word) > n and (found := self.scores.get(word[:n] + "*")) is not None:
                    break
        return (found or 0.0) - DRIFT

    def expected(self, score: float, n: int) -> float:
        """Expected chance segments of that score in n words."""
        return self.k * max(n, 1) * math.exp(-min(self.rate * score, 700.0))

    def probability(self, evidence: float) -> float:
        x = self.slope * evidence + self.offset
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def segments(scores: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of runs (first, last, score), in one linear scan."""
    total = 0.0
    found: list[tuple[int, int, float, float]] = []  # first, last, total before, total behind
    for first, last, score in scores:
        if score <= 0:
            total += score
            continue
        left, a = total, first
        total += score
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j -= 1
            if j < 0 or found[j][3] >= total:
                found.append((a, last, left, total))
                break
            a, left = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, right - left) for a, b, left, right in found]


def scored_segments(model: Model, text: str | None, cache: dict[str, float]) -> tuple[np.ndarray, list[tuple[int, int, float]]]:
    """The words' scores and all maximal scoring segments: first word, last word, score. cache: scores by word, of CACHE words at most besides the text's own."""
    words = WORD.findall((text or "").lower())
    lacking = set(words).difference(cache)
    if lacking:
        if len(cache) + len(lacking) > CACHE:
            cache.clear()
            lacking = set(words)
        cache.update((w, model.word(w)) for w in lacking)
    values = np.fromiter(map(cache.__getitem__, words), float, len(words))
    runs: list[tuple[int, int, float]] = []
    above = np.flatnonzero(values > 0)
    if len(above):
        total = np.concatenate([[0.0], np.cumsum(values)])
        behind = 0
        for i, v, before in zip(above.tolist(), values[above].tolist(), total[above].tolist(), strict=True):
            if i > behind:
                runs.append((behind, i - 1, before - float(total[behind])))
            runs.append((i, i, v))
            behind = i + 1
    return values, segments(runs)


def passages(model: Model, text: str | None, cache: dict[str, float] | None = None) -> tuple[int, list[tuple[int, int, float, float]]]:
    """The number of words, and the significant segments: first word, last word, score, expected chance segments."""
    values, found = scored_segments(model, text, {} if cache is None else cache)
    each = ((a, b, score, model.expected(score, len(values))) for a, b, score in found)
    return len(values), [x for x in each if x[3] < MAX_EXPECTED]


def evidence(found: list[tuple[int, int, float, float]]) -> float:
    """The sum of the segments' significance, as the negative logarithm of what chance gives."""
    return sum(-math.log(max(e, 1e-300)) for _, _, _, e in found)


def _counted(train: DataFrame) -> DataFrame:
    """feature, y1, y0: in how many different contexts (the word before) a word stands in texts of each kind, and the same summed over prefixes' words.

    Contexts, not texts, are counted, as the words of a passage that was copied into many texts have one context."""
    words = F.filter(F.split(F.lower("text"), JAVA_SPLIT), lambda w: w != "")
    pairs = train.select("toxic", words.alias("words")).select("toxic", F.explode(F.transform("words", lambda w, i: F.struct(w.alias("word"), F.xxhash64(F.get("words", i - 1)).alias("before")))).alias("p")).select("toxic", "p.*")
    met = pairs.groupBy("word", "before").agg(F.max("toxic").alias("t1"), F.max(1 - F.col("toxic")).alias("t0"))
    counts = met.groupBy("word").agg(F.sum("t1").alias("y1"), F.sum("t0").alias("y0"))
    prefixes = F.array(*(F.when(F.length("word") > n, F.concat(F.substring("word", 1, n), F.lit("*"))) for n in PREFIXES))
    return counts.select(F.explode(F.concat(F.array("word"), prefixes)).alias("feature"), "word", "y1", "y0").where("feature is not null").groupBy("feature").agg(
        F.sum("y1").alias("y1"), F.sum("y0").alias("y0")
    )


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """The model of labels (doc_id, toxic) of docs; at most about max_train of them are used."""
    marked = labels.where("toxic is not null").groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
    train = sampled(marked, F.col("doc_id"), max_train)
    scratch = Scratch(docs.sparkSession, "toxicity")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(train), "doc_id")  # about max_train rows
    texts = scratch.cut(texts.groupBy(F.xxhash64("text").alias("h")).agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")))
    model = Model()
    held = F.pmod("h", F.lit(3)) == 0
    n1, n0, h1, h0 = (int(x or 0) for x in texts.agg(F.sum("toxic"), F.sum(1 - F.col("toxic")), F.sum(F.when(held, F.col("toxic"))), F.sum(F.when(held, 1 - F.col("toxic")))).first())
    if not n1 or not n0:
        share = n1 / max(1, n1 + n0)
        model.offset = math.log((share + 1e-9) / (1 - share + 1e-9))
        return model
    apart = min(h1, h0) >= MIN_HELD and n1 - h1 >= MIN_HELD
    counted = scratch.cut(_counted(texts.where(~held) if apart else texts))
    t1, t0 = (float(x or 1) for x in counted.where("not endswith(feature, '*')").agg(F.sum("y1"), F.sum("y0")).first())
    # log-odds with a prior of PRIOR of all tokens, dealt out as the feature is dealt out in all texts
    alpha = PRIOR * (F.col("y1") + F.col("y0"))
    all_alpha = PRIOR * (t1 + t0)
    odds = lambda y, t: F.log((F.col(y) + alpha) / (t + all_alpha - F.col(y) - alpha))
    delta = odds("y1", t1) - odds("y0", t0)
    z = delta / F.sqrt(1 / (F.col("y1") + alpha) + 1 / (F.col("y0") + alpha))
    kept = counted.select("feature", delta.alias("score"), F.abs(z).alias("z")).where((F.col("z") >= MIN_Z) & (F.abs("score") > 2 * DRIFT))
    model.scores = {r["feature"]: r["score"] for r in kept.orderBy(F.desc("z"), "feature").limit(MAX_FEATURES).collect()}
    _calibrate(model, scratch, texts.where(held) if apart else texts)
    return model


def _calibrate(model: Model, scratch: Scratch, texts: DataFrame) -> None:
    """The extreme-value rate and k from texts that aren't toxic, and the logistic curve. One pass in Python over the texts; the rest counts its rows."""

    @lean
    def run(batches):
        cache: dict[str, float] = {}
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                values, found = scored_segments(model, text, cache)
                steps, counts = np.unique(np.round(values * 10).astype(np.int32), return_counts=True)
                rows.append((len(values), steps.tolist(), counts.tolist(), [s for *_, s in found]))
            n, steps, counts, found = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(steps, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64())), pa.array(found, pa.list_(pa.float64()))], names=["toxic", "n", "steps", "counts", "found"]
            )

    seen = scratch.cut(texts.select(F.col("toxic").cast("int").alias("toxic"), "text").mapInArrow(run, "toxic int, n long, steps array<int>, counts array<long>, found array<double>"))
    bare = seen.where("toxic = 0")
    share = {r["step"] / 10: float(r["n"]) for r in bare.select(F.explode(F.arrays_zip("steps", "counts")).alias("x")).groupBy(F.col("x.steps").alias("step")).agg(F.sum("x.counts").alias("n")).collect()}
    words = sum(share.values()) + 1.0
    share = {v: n / words for v, n in share.items()}
    top = max([1.0, *model.scores.values()])
    share[top] = max(share.get(top, 0.0), 0.5 / words)  # a positive score must be possible
    low, high = 1e-6, 50.0  # the rate solves: sum of share * exp(rate * score) = 1
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(p * math.exp(min(700.0, mid * v)) for v, p in share.items()) < 1 else (low, mid)
    model.rate = low
    # k: what makes the law expect as many segments, of the median score or more, as there are
    score = F.explode("found").alias("s")
    middle = bare.select(score).agg(F.percentile("s", F.lit(0.5))).first()[0]
    if middle is not None:
        above = bare.select(score).where(F.col("s") >= middle).count()
        model.k = above * math.exp(min(700.0, model.rate * middle)) / words
    expected = lambda s: F.lit(model.k) * F.greatest("n", F.lit(1)) * F.exp(-F.least(F.lit(model.rate) * s, F.lit(700.0)))
    told = F.aggregate("found", F.lit(0.0), lambda total, s: total + F.when(expected(s) < MAX_EXPECTED, -F.log(F.greatest(expected(s), F.lit(1e-300)))).otherwise(0.0))
    # a histogram of the evidence: the curve is fitted on its bins
    bins = seen.groupBy("toxic", F.least(F.round(told, 0), F.lit(200.0)).alias("x")).count().collect()
    x = np.array([r["x"] for r in bins]) / 10
    y = np.array([r["toxic"] for r in bins], float)
    w = np.array([r["count"] for r in bins], float)
    beta = np.zeros(2)
    design = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(50):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (w * (y - p)) - 1e-2 * beta
        hess = (design * (w * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta += np.clip(step, -3, 3)
        if abs(step).max() < 1e-8:
            break
    model.offset, model.slope = float(beta[0]), max(0.0, float(beta[1])) / 10


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted, passages: array of struct(first, last, score, expected), words counted from 0."""
    small_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_FEATURES features
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))

    @lean
    def run(batches):
        cache: dict[str, float] = {}
        for batch in batches:
            scores, spans = [], []
            for text in batch.column(1):
                found = passages(shipped.value, text.as_py(), cache)[1]
                scores.append(shipped.value.probability(evidence(found)))
                spans.append([{"first": a, "last": b, "score": s, "expected": e} for a, b, s, e in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, kind)], names=["doc_id", "score", "passages"])

    made = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, passages array<struct<first:int,last:int,score:double,expected:double>>")
    return made.select("doc_id", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "passages")


def held_out(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages; labels are learned where crc32(doc_id) mod 5 is not 0."""
    model = fit(docs, labels.where(remainder(F.col("doc_id"), 5) != 0))
    return score(docs, model).select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted", F.size("passages").cast("long").alias("n_passages"))


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, as they are, that are not predicted toxic. Rows are judged one by one, without a join."""
    small_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    @lean
    def judged(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache: dict[str, float] = {}
        for part in texts:
            yield pd.Series([shipped.value.probability(evidence(passages(shipped.value, t, cache)[1])) < 0.5 for t in part], dtype=bool)

    @F.pandas_udf("boolean")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return judged(texts)

    return docs.where(clean(F.col("text")))

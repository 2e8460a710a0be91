"""Scores, segments and calibration of the toxicity model against brute force."""

import math
import random

import numpy as np

from tessera.llm import toxicity


def brute_segments(values, off=0):
    """All maximal segments by their definition: the best one, then those to its left and right."""
    top = max(((round(sum(values[i:j]), 9), -(j - i), -i) for i in range(len(values)) for j in range(i + 1, len(values) + 1)), default=(0,))
    if top[0] <= 0:
        return []
    i, j = -top[2], -top[2] - top[1]
    return [*brute_segments(values[:i], off), (off + i, off + j - 1, top[0]), *brute_segments(values[j:], off + j)]


def test_segments_of_words_with_positive_and_negative_scores():
    model = toxicity.Model(scores={"bad": 3.0, "worse": 4.5, "fine": -2.0, "good": -0.5, "scum*": 2.0}, rate=1.3, k=0.02)
    rng = random.Random(1)
    for _ in range(300):
        words = [rng.choice(["bad", "worse", "fine", "good", "plain", "scumbag"]) for _ in range(rng.randint(0, 14))]
        values, found = toxicity.scored_segments(model, " ".join(words), {})
        want = [model.word(w) for w in words]
        assert values.tolist() == want and {w: model.word(w) for w in ("plain", "scumbag", "fine")} == {"plain": -toxicity.DRIFT, "scumbag": 2.0 - toxicity.DRIFT, "fine": -2.0 - toxicity.DRIFT}
        assert [round(s, 6) for *_, s in found] == [round(s, 6) for *_, s in brute_segments(want)]
        n, significant = toxicity.passages(model, " ".join(words))
        assert n == len(words) and all(e == 0.02 * n * math.exp(-1.3 * s) < toxicity.MAX_EXPECTED for _, _, s, e in significant)


def test_log_odds_by_brute_force(spark, monkeypatch):
    """The features' scores are the log-odds of contexts with the prior's share; the rate solves its equation."""
    monkeypatch.setattr(toxicity, "MIN_HELD", 10**9)
    rng = random.Random(2)
    rows = []
    for i in range(300):
        words = [rng.choice("aeiou") + rng.choice("bdgklmnprst") + rng.choice("aeiou") for _ in range(30)]
        for _ in range(5):
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "rotten"] if i % 3 == 0 else ["lovely", "gentle"]))
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    met = {1: set(), 0: set()}
    for _, t, y in rows:
        words = t.split()
        met[y] |= {(w, words[k - 1] if k else None) for k, w in enumerate(words)}
    total = {y: len(met[y]) for y in met}
    prior, odds = toxicity.PRIOR, {}
    for w in {w for y in met for w, _ in met[y]}:
        y1, y0 = (sum(x == w for x, _ in met[y]) for y in (1, 0))
        a, whole = prior * (y1 + y0), prior * (total[1] + total[0])
        side = [math.log((n + a) / (total[y] + whole - n - a)) for n, y in ((y1, 1), (y0, 0))]
        odds[w] = (side[0] - side[1], (side[0] - side[1]) / math.sqrt(1 / (y1 + a) + 1 / (y0 + a)))
    words = {w: s for w, s in model.scores.items() if not w.endswith("*")}
    assert {"vile", "rotten"} <= {w for w in words if words[w] > 0} and {"lovely", "gentle"} <= {w for w in words if words[w] < 0}
    assert words.keys() == {w for w, (d, z) in odds.items() if abs(z) >= toxicity.MIN_Z and abs(d) > 2 * toxicity.DRIFT}
    assert all(abs(s - odds[w][0]) < 1e-9 for w, s in words.items())
    values = np.array([model.word(w) for _, t, y in rows if not y for w in t.split()])
    assert abs(np.exp(model.rate * np.round(values, 1)).mean() - 1) < 0.05 or not (values > 0).any()
    assert model.probability(50.0) > 0.5 > model.probability(0.0)

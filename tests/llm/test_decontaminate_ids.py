"""Benchmark rows that share an item_id, or have none."""

import random

from tessera.llm import decontaminate


def test_texts_of_one_id_are_all_found(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.sample(words, 30)) for _ in range(4)]
    docs = [(i, " ".join(rng.sample(words, 20)) + " " + t + " " + " ".join(rng.sample(words, 20))) for i, t in enumerate(texts)]
    docs += [(4, texts[1] + " and " + texts[0]), (5, " ".join(rng.sample(words, 50)))]
    bench = [(7, texts[0]), (7, texts[1]), (None, texts[2]), (None, texts[3])]
    found = decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    got = {r["doc_id"]: (len(r["hits"]), r["items"]) for r in found.collect()}
    assert got == {0: (30, ["7"]), 1: (30, ["7"]), 2: (30, ["null"]), 3: (30, ["null"]), 4: (60, ["7"]), 5: (0, [])}


def test_proximity_of_texts_of_one_id(spark):
    docs = spark.createDataFrame([(1, "alpha x beta y gamma"), (2, "delta x epsilon y zeta")], "doc_id long, text string")
    bench = spark.createDataFrame([(9, "gamma alpha beta"), (9, "zeta epsilon delta")], "item_id long, text string")
    assert sorted((r["doc_id"], r["item"]) for r in decontaminate.proximity(docs, bench, within=8).collect()) == [(1, "9"), (2, "9")]

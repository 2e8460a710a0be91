"""The pipeline's near-duplicate stage against exact similarities of all pairs."""

import random

import corpus_pipeline
from tessera.llm import nearcopies


def text(rng, n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def edited(rng, words, n):
    words = words.split()
    for at in rng.sample(range(len(words)), n):
        words[at] = f"x{rng.randrange(10**9)}"
    return " ".join(words)


def brute(rows):
    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in sets:
        for j, b in sets:
            if i < j and len(a & b) >= 0.8 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted({find(i) for i, _ in rows})


def test_edited_copies_go(spark):
    rng = random.Random(5)
    rows = [(i, text(rng, rng.randint(30, 300))) for i in range(60)]
    rows += [(100 + i, edited(rng, rows[i][1], max(1, len(rows[i][1].split()) // (70 if i % 2 else 12)))) for i in range(40)]
    rows += [(200, rows[1][1].upper()), (201, None), (202, ""), (203, " \n"), (204, "one two"), (205, "One  two"), (206, "one three")]
    base = text(rng, 400)  # a large bucket: copies of one text, near to it and not to each other
    rows += [(300 + i, edited(rng, base, 6)) for i in range(60)] + [(399, base)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == brute(rows)
    assert kept.columns == docs.columns and nearcopies.keep_first(docs.where("doc_id < 0")).count() == 0


def test_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (4, "A b c"), (5, "d")], "doc_id long, text string")
    assert sorted(nearcopies.near_copies(docs).select("component_id").toPandas()["component_id"]) == [4, 4, 4, 5]


def test_bands_find_nearly_all():
    rng = random.Random(8)
    found = 0
    for _ in range(300):
        a = text(rng, 300)
        b = edited(rng, a, 6)
        x, y = (nearcopies.shingles(nearcopies.split(t)) for t in (a, b))
        found += bool(set(nearcopies.bands(x).tolist()) & set(nearcopies.bands(y).tolist()))
    assert found >= 299


def test_rows_of_one_id_are_told_apart(spark):
    docs = spark.createDataFrame([(3, "s one two three four five"), (5, "s one two three four five"), (5, "t six seven eight nine ten"), (None, "T six seven eight nine ten")], "doc_id long, text string")
    assert sorted(tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == [(3, "s one two three four five"), (5, "t six seven eight nine ten")]


def test_strays_of_large_buckets(spark, monkeypatch):
    """Chains of copies, each near to the next only, so that most aren't near to a bucket's two heads."""
    monkeypatch.setattr(nearcopies, "PAIRED", 2)
    rng = random.Random(6)
    rows, now = [], text(rng, 200)
    for i in range(40):
        rows.append((i, now))
        now = edited(rng, now, 3 if i % 9 else 12)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in nearcopies.keep_first(docs).collect()) == brute(rows)


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", 7, 8), (2, "a b c", 9, 10)], "doc_id long, text string, key long, th long")
    assert [tuple(r) for r in nearcopies.keep_first(docs).collect()] == [(1, "a b c", 7, 8)]

"""Line deduplication against brute force: a line goes if it lies in a run of enough words that an earlier document has."""

import random

from tessera.llm import linededup


def brute(later, words, earlier, least):
    found = set()
    for i in range(len(later)):
        for j in range(len(earlier)):
            k = 0
            while i + k < len(later) and j + k < len(earlier) and later[i + k] == earlier[j + k]:
                k += 1
            if sum(words[i : i + k]) >= least:
                found.update(range(i, i + k))
    return sorted(found)


def brute_texts(rows, least):
    """doc_id -> text that is left, for rows of different ids."""
    split = {i: [(at, " ".join(x.split())) for at, x in enumerate(t.split("\n")) if x.strip()] for i, t in rows}
    out = {}
    for i, t in rows:
        mine = [x for _, x in split[i]]
        gone = {split[i][k][0] for j, _ in rows if j < i for k in brute(mine, [len(x.split()) for x in mine], [x for _, x in split[j]], least)}
        out[i] = "\n".join(x for at, x in enumerate(t.split("\n")) if at not in gone)
    return out


def test_crossed_passage_goes(spark):
    head, passage = "a short unique line", "p " * 60
    docs = spark.createDataFrame([(1, f"{head}\n{passage}"), (2, f"{passage}\n{head}"), (3, f"{head}\nother")], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in linededup.deduplicated(docs).collect()} == {1: f"{head}\n{passage}", 2: head, 3: f"{head}\nother"}


def test_every_shared_run_is_found():
    rng = random.Random(4)
    lines = [rng.getrandbits(63) for _ in range(14)]
    sizes = {x: rng.randint(1, 30) for x in lines}
    for _ in range(3000):
        later, earlier = ([rng.choice(lines) for _ in range(rng.randint(0, 14))] for _ in range(2))
        words = [sizes[x] for x in later]
        assert linededup.common_blocks(later, words, earlier, 40) == brute(later, words, earlier, 40)


def test_a_later_holder_has_the_longer_block(spark):
    s, t = "s " * 60, "t " * 40
    docs = spark.createDataFrame([(1, s), (2, f"{s}\n{t}"), (3, f"{s}\n{t}")], "doc_id long, text string")
    assert {r["doc_id"]: r["text"].strip() for r in linededup.deduplicated(docs, 50).collect()} == {1: s.strip(), 2: t.strip(), 3: ""}


def test_texts_against_brute_force(spark):
    rng = random.Random(7)
    pool = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randint(1, 14))) for _ in range(60)]
    rows = [(i, "\n".join(rng.choice([*pool, "", f"own {i}"]) for _ in range(rng.randint(0, 25)))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for least in (1, 10, 25):
        assert {r["doc_id"]: r["text"] for r in linededup.deduplicated(docs, least).collect()} == brute_texts(rows, least)


def test_texts_without_unique_lines_are_fast():
    lines = [k % 50 for k in range(20_000)]
    assert linededup.patience(lines + [99], [98] + lines)


def test_extra_columns_of_any_name(spark):
    passage = "p " * 30
    docs = spark.createDataFrame([(1, passage, 4, "x"), (2, passage + "\nmore", 5, "y")], "doc_id long, text string, gone long, th string")
    assert [tuple(r) for r in linededup.deduplicated(docs).orderBy("doc_id").collect()] == [(1, passage, 4, "x"), (2, "more", 5, "y")]

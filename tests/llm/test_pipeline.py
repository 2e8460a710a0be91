"""The pipeline over planted documents: what must go goes, the rest stays, and its encoding is the library's."""

import hashlib
import random

import public_tokenizers
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from tessera.llm import bpe, decontaminate, urltree

WORDS = [a + b for a in ("mar", "tel", "ron", "sil", "vod", "kan", "lu", "pes") for b in ("a", "en", "ing", "os", "um", "ick", "ar")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def test_planted_documents(spark, tmp_path):
    rng = random.Random(21)
    item = sentence(rng, 30)
    passage = sentence(rng, 60)
    texts, labels = {}, []
    for i in range(200):
        texts[i] = sentence(rng, rng.randint(40, 120)) + "\n" + sentence(rng, rng.randint(10, 40))
        if i % 4 == 0:
            words = texts[i].split(" ")
            for _ in range(4):
                words.insert(rng.randint(1, len(words) - 1), rng.choice(["vile", "scummy", "wretch"]))
            texts[i] = " ".join(words)
        labels.append((i, 1, int(i % 4 == 0)))
    clean = [i for i in texts if i % 4]
    texts[300] = texts[1]  # an exact copy
    near = sentence(rng, 400)
    texts[301] = near
    texts[302] = near.replace(near.split()[200], "changed", 1) if near.count(near.split()[200]) == 1 else near + " changed"
    texts[303], texts[304] = (sentence(rng, 20) + "\n" + passage + "\n" + sentence(rng, 20) for _ in range(2))
    texts[305] = sentence(rng, 20) + " " + item[:200].rsplit(" ", 1)[0] + " " + sentence(rng, 20)
    texts[306] = None
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(open(public_tokenizers.path(bpe.VOCABULARY), "rb").read()), special_tokens={})
    a, _, b = texts[304].split("\n")
    expected = {i: texts[i] for i in [*clean, 301, 303]} | {304: f"{a}\n{b}", 300: ""}  # the copy loses its lines and is the first of the empty texts
    assert set(got) == set(expected)
    for i, text in expected.items():
        ids = own.encode_ordinary(text)
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_stages_keep_columns_and_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    none = docs.where("doc_id < 0")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, none, sf_dir).columns == docs.columns, name
        assert stage(spark, none, sf_dir).count() == 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "decontaminate", "bpe"]


def test_registered(spark, sf_dir):
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


def test_sql(spark, sf_dir):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        c.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    for name, sql in (("op5_decontaminate", decontaminate.ORACLE), ("op2_url_tree", urltree.ORACLE)):
        got = entry.queries()[name](spark, sf_dir).toPandas()
        want = c.execute(sql).df()[list(got.columns)]
        show = lambda df: sorted(map(str, df.astype(object).where(df.notna(), None).itertuples(index=False, name=None)))
        assert show(got) == show(want)

"""Operators on small tables, against plain Python."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tessera.__main__ import main
from tessera.operators import evaluate, points, search, structure, styles, validate
from tessera.sources import documents


def test_stated_sections(spark):
    names = ["서론", "시행일", "요구사항", "적용 및 기타 설명자료", "목적", "용어의 정의", "다른 글"]
    rng = random.Random(4)
    texts = [rng.choice(names) for _ in range(400)]
    fixed = {"서론": "intro", "시행일": "effective_date", "요구사항": "requirements", "적용 및 기타 설명자료": "application"}
    now, want = None, []
    for t in texts:
        if t in fixed:
            now = fixed[t]
        elif t == "목적":
            now = "application" if now == "requirements" else "purpose"
        elif t == "용어의 정의" and now not in ("requirements", "application"):
            now = "definitions"
        want.append(now)
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "d int, i int, text string")
    got = [r["stated_section"] for r in structure.stated_sections(df, ["d"], "i").orderBy("i").collect()]
    assert got == want


def test_styles(spark):
    schema = "source_file string, style_id string, name string, based_on string, num_id string, ilvl int"
    chain = [("f", f"s{i}", f"S{i}", f"s{i + 1}", "9" if i == 11 else None, None) for i in range(12)]
    rows = [("f", "a", "A", "b", None, None), ("f", "b", "B", "c", None, 2), ("f", "c", None, None, "7", 1), ("f", "x", "X", "y", None, None), ("f", "y", "Y", "x", None, None), ("f", "z", "Z", "gone", None, 3), *chain]
    dims = spark.createDataFrame(rows, schema)
    got = {r["style_id"]: (r["style_num_id"], r["style_ilvl"]) for r in styles.resolved_styles(dims).collect()}
    assert got["a"] == ("7", 2) and got["c"] == ("7", 1) and got["x"] == got["z"] == (None, None)
    assert got["s2"] == ("9", 0) and got["s1"] == (None, None)  # ten styles are followed, not eleven
    paras = spark.createDataFrame([("f", "a", None, None), ("f", "a", None, 5), ("f", "a", "0", None), ("f", "c", None, None), ("f", "none", None, None)], "source_file string, style_id string, p_num_id string, p_ilvl int")
    out = sorted((r["style"], r["num_id"] or "", r["ilvl"] if r["ilvl"] is not None else -1) for r in styles.with_styles(paras, dims).collect())
    assert out == sorted([("A", "7", 2), ("A", "7", 5), ("A", "0", -1), ("c", "7", 1), ("none", "", -1)])


def test_search_blocks_and_bias(spark, monkeypatch):
    monkeypatch.setattr(search, "MAX_QUERIES", 3)
    monkeypatch.setattr(search, "BLOCK_BYTES", 200)
    rng = random.Random(5)
    vec = lambda: [rng.uniform(-1, 1) for _ in range(6)]
    pts = [(f"p{i}", f"S{i % 3}", vec()) for i in range(40)]
    qs = [(i, vec()) for i in range(10)]
    hits = search.search(spark.createDataFrame(qs, "query_id int, query_vector array<double>"), spark.createDataFrame(pts, "chunk_id string, standard_id string, vector array<double>"), 4)
    column_form = search.top(search.scored(spark.createDataFrame(qs, "query_id int, query_vector array<double>"), spark.createDataFrame(pts, "chunk_id string, standard_id string, vector array<double>")), ["query_id"], 4)
    rows = lambda df: sorted((r["query_id"], r["rank"], r["chunk_id"], r["score"]) for r in df.collect())
    assert rows(column_form) == rows(hits)
    cos = lambda a, b: round(sum(x * y for x, y in zip(a, b, strict=True)) / (sum(x * x for x in a) ** 0.5 * sum(x * x for x in b) ** 0.5), 6)
    for q, v in qs:
        want = sorted(((-cos(v, p), n) for n, _, p in pts))[:4]
        assert [(-r["score"], r["chunk_id"]) for r in sorted(hits.where(F.col("query_id") == q).collect(), key=lambda r: r["rank"])] == want
    targets = spark.createDataFrame([("p0",), ("p1",)], "chunk_id string")
    pairs = evaluate.pairwise(spark.createDataFrame(pts[:2], "chunk_id string, standard_id string, vector array<double>"))
    row = evaluate.bias(targets, hits, pairs).first()
    assert row["mean_distance"] == pytest.approx(1 - cos(pts[0][2], pts[1][2]), abs=2e-6) and 0 <= row["co_occurrence"] <= 1


def test_golden_metrics(spark):
    seeds = spark.createDataFrame([("a", "c1", "ko", ["x"]), ("b", "c1", "ko_en", ["y", "z"]), ("c", "c2", "ko", ["w"])], "query_id string, category string, lang_mix string, expected_chunk_ids array<string>")
    hits = spark.createDataFrame([("a", "x", 6), ("b", "z", 2), ("b", "y", 4), ("c", "q", 1)], "query_id string, chunk_id string, rank int")
    rows = evaluate.judged(evaluate.first_hits(seeds, hits))
    got = {r["query_id"]: (r["hit_rank"], r["recalled"], round(r["reciprocal_rank"], 6)) for r in rows.collect()}
    assert got == {"a": (6, False, 0.166667), "b": (2, True, 0.5), "c": (None, False, 0.0)}
    assert {(r["by"], r["category"], r["lang_mix"]): (r["seed_count"], r["recall"], r["mrr"]) for r in evaluate.metrics(rows).collect()} == {
        ("all", None, None): (3, 0.333333, 0.222222), ("category", "c1", None): (2, 0.5, 0.333333), ("category", "c2", None): (1, 0.0, 0.0), ("lang", None, "ko"): (2, 0.0, 0.083333), ("lang", None, "ko_en"): (1, 1.0, 0.5),
    }
    assert evaluate.totals(rows.where("query_id = 'none'")).first()["recall"] == 0.0


def test_verification(spark):
    rows = [("c", "1", [1.0, 2.0]), ("c", "1", [1.0, 2.0]), ("d", "2", [1.0])]
    df = spark.createDataFrame(rows, "collection string, point_id string, vector array<float>")
    expected = spark.createDataFrame([("c", 1), ("d", 1), ("e", 4)], "collection string, expected long")
    got = {r["collection"]: (r["n"], r["passed"]) for r in points.verified(df, 2, expected).collect()}
    assert got == {"c": (2, False), "d": (1, False), "e": (0, False)}
    assert spark.range(1).select(validate.same_set(F.array(F.lit(1), F.lit(2)), F.array(F.lit(2), F.lit(1), F.lit(1))).alias("s")).first()["s"]
    values = sorted(random.Random(1).choices(range(50), k=31))
    row = validate.token_stats(spark.createDataFrame([(v,) for v in values], "token_estimate int")).first()
    assert (row["count"], row["min"], row["max"], row["mean"]) == (31, values[0], values[-1], sum(values) // 31) and row["p95"] == values[round(0.95 * 30)] and row["p50"] == values[15]
    assert validate.token_stats(spark.createDataFrame([], "token_estimate int")).first()["p99"] == 0


def test_golden_file_and_documents(spark, tmp_path):
    (tmp_path / "g.jsonl").write_text('{"query_id": "a", "expected_chunk_ids": ["x"]}\n\n{"query_id": "b", "expected_chunk_ids": []}\n')
    with pytest.raises(Exception, match="GOLDEN"):
        documents.read_golden(spark, str(tmp_path / "g.jsonl")).collect()


def test_command_line(spark, tmp_path):
    body = '---\nschema_version: "1.0"\nstandard_id: "ISA-200"\nstandard_no: "200"\nstandard_title: "a \\"b\\""\nsource_file: "x"\n---\n\n# t\n\n<!-- idx: 0 -->\n\n1.\t글\n<!-- para: 1. | kind: requirement | idx: 1 -->\n\n\t•\t점\n<!-- kind: bullet | idx: 2 -->\n'
    (tmp_path / "md").mkdir()
    (tmp_path / "md" / "ISA-200.md").write_text(body)
    (tmp_path / "md" / "notes.md").write_text("x")
    assert main(["ingest", str(tmp_path / "md"), "--out", str(tmp_path / "json")]) == 0
    text = (tmp_path / "json" / "ISA-200.json").read_text()
    doc = json.loads(text)
    assert doc["schema_version"] == "1.2.0" and doc["standard"]["standard_title"] == 'a "b"' and [c["content_text"] for c in doc["chunks"]] == ["글", "점"]
    assert list(doc["chunks"][0])[:3] == ["chunk_id", "paragraph_id", "kind"] and doc["chunks"][0]["embedding"] is None
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "a.json").write_text(text)
    assert main(["validate", str(tmp_path / "one"), "--out", str(tmp_path / "report")]) == 0
    assert json.loads(next((tmp_path / "report" / "report").glob("*.json")).read_text())["chunks"] == 2
    with pytest.raises(ValueError, match="upsert"):
        main(["ingest", str(tmp_path / "md"), "--out", str(tmp_path / "j"), "--store", "s"])

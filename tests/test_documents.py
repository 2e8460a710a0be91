"""The document pipeline: synthetic files of four families through blocks, Markdown, chunks and points."""

import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from tessera.functions import columns as K
from tessera.model.profiles import PROFILES, family_of, named_appendix, numbered_appendix, profile_of, valid_standard_id
from tessera.operators import chunks as C
from tessera.operators import points as P
from tessera.operators import render, split
from tessera.operators.numbering import counters
from tessera.operators.structure import blocks, trail
from tessera.plans import jobs
from tessera.sources import docx, markdown

NS = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def para(text, style="", num=None, ilvl=None):
    props = (f'<w:pStyle w:val="{style}"/>' if style else "") + (f'<w:numPr><w:ilvl w:val="{ilvl}"/><w:numId w:val="{num}"/></w:numPr>' if num is not None else "")
    return f"<w:p><w:pPr>{props}</w:pPr><w:r><w:t>{text}</w:t></w:r></w:p>"


def table(rows):
    cell = lambda c: "<w:tc>" + "".join(para(x) for x in (c if isinstance(c, list) else [c])) + "</w:tc>"
    return "<w:tbl>" + "".join("<w:tr>" + "".join(map(cell, r)) + "</w:tr>" for r in rows) + "</w:tbl>"


NUMBERING = f"""<w:numbering {NS}>
<w:abstractNum w:abstractNumId="1"><w:lvl w:ilvl="0"><w:start w:val="1"/><w:numFmt w:val="decimal"/><w:lvlText w:val="%1."/></w:lvl>
<w:lvl w:ilvl="1"><w:start w:val="1"/><w:numFmt w:val="lowerLetter"/><w:lvlText w:val="(%2)"/></w:lvl></w:abstractNum>
<w:abstractNum w:abstractNumId="2"><w:lvl w:ilvl="0"><w:start w:val="1"/><w:numFmt w:val="decimal"/><w:lvlText w:val="A%1."/></w:lvl></w:abstractNum>
<w:num w:numId="5"><w:abstractNumId w:val="1"/></w:num><w:num w:numId="6"><w:abstractNumId w:val="2"/></w:num></w:numbering>"""
STYLES = f"""<w:styles {NS}><w:style w:styleId="1"><w:name w:val="heading 1"/></w:style><w:style w:styleId="2"><w:name w:val="heading 2"/></w:style>
<w:style w:styleId="3"><w:name w:val="heading 3"/></w:style><w:style w:styleId="b"><w:name w:val="보론 제목"/></w:style><w:style w:styleId="t"><w:name w:val="목차"/></w:style>
<w:style w:styleId="base"><w:name w:val="base"/><w:pPr><w:numPr><w:numId w:val="5"/></w:numPr></w:pPr></w:style>
<w:style w:styleId="child"><w:name w:val="child"/><w:basedOn w:val="base"/><w:pPr><w:numPr><w:ilvl w:val="1"/></w:numPr></w:pPr></w:style></w:styles>"""


def write(path, body):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("word/document.xml", f"<w:document {NS}><w:body>{body}</w:body></w:document>")
        z.writestr("word/styles.xml", STYLES)
        z.writestr("word/numbering.xml", NUMBERING)


ISA = (
    para("목차 1", "t") + para("감사기준서 200 제목", "1") + para("서론", "2") + para("이 감사기준서의 범위", "3") + para("첫 문단", "", 5, 0) + para("항목", "child")
    + para("요구사항", "2") + para("둘째", "", 5, 0) + para("적용 및 기타 설명자료", "2") + para("지침", "", 6, 0) + para("보론 1", "b") + para("부록 문단", "", 5, 0)
    + table([["a|b", "c"], ["d\\e", "f"]]) + table([["하나"]]) + para("감사기준서 300 다음", "1") + para("요구사항", "2") + para("다시", "", 5, 0)
)


@pytest.fixture(scope="module")
def isa(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("isa")
    write(d / "x.docx", ISA)
    return str(d)


def test_blocks(spark, isa):
    rows = {r["text"]: r for r in jobs.structured(spark, isa, "ISA").collect()}
    assert rows["목차 1"]["is_toc"] and rows["목차 1"]["standard_no"] is None
    assert (rows["첫 문단"]["kind"], rows["첫 문단"]["paragraph_id"], rows["첫 문단"]["section"]) == ("requirement", "1.", "intro")
    assert rows["첫 문단"]["heading_trail"] == ["감사기준서 200", "서론", "이 감사기준서의 범위"]
    assert (rows["항목"]["kind"], rows["항목"]["paragraph_id"], rows["항목"]["parent_paragraph_id"]) == ("sub_item", "(a)", "1.")
    assert rows["둘째"]["paragraph_id"] == "2."
    assert (rows["지침"]["paragraph_id"], rows["지침"]["parent_paragraph_id"]) == ("A1.", "2.")
    assert rows["부록 문단"]["paragraph_id"] == "부록-3." and rows["부록 문단"]["section"] == "appendix"
    assert rows["하나"]["kind"] == "block_quote" and rows["하나"]["table_cells"] is None
    assert (rows["다시"]["paragraph_id"], rows["다시"]["standard_no"], rows["다시"]["standard_title"]) == ("1.", "300", "다음")


@pytest.fixture(scope="module")
def files(spark, isa, tmp_path_factory):
    return {r["file_name"]: r["content"] for r in jobs.convert(spark, isa, "ISA", str(tmp_path_factory.mktemp("out") / "md")).collect()}


def test_markdown_round_trip(spark, isa, files, tmp_path):
    assert set(files) == {"_prelude.md", "ISA-200.md", "ISA-300.md"}
    assert files["ISA-200.md"].startswith('---\nschema_version: "1.0"\nstandard_id: "ISA-200"\nstandard_no: "200"\nstandard_title: "제목"\n')
    assert "| a\\|b | c |\n| --- | --- |\n| d\\\\e | f |\n<!-- kind: table | rows: 2 | cols: 2 | idx: " in files["ISA-200.md"]
    folder = tmp_path / "flat"
    folder.mkdir()
    for name, content in files.items():
        (folder / name).write_text(content)
    standards, chunks, links, summaries = jobs.parsed(spark, str(folder), "ISA")
    rows = {r["content_text"]: r for r in chunks.collect()}
    source = {r["text"]: r for r in jobs.structured(spark, isa, "ISA").collect()}
    for text in ("첫 문단", "항목", "둘째", "지침", "부록 문단", "다시"):
        assert rows[text]["paragraph_id"] == source[text]["paragraph_id"] and rows[text]["kind"] == source[text]["kind"]
        assert rows[text]["heading_trail"][1:] == source[text]["heading_trail"][1:] and rows[text]["source_idx"] == source[text]["idx"]
    grid = next(r for r in rows.values() if r["kind"] == "table")
    assert grid["table_cells"] == [["a|b", "c"], ["d\\e", "f"]] and grid["appendix_index"] == 1
    link = links.collect()
    assert len(link) == 1 and link[0]["source"].endswith(":A1.") and link[0]["target"].endswith(":2.")
    assert {r["standard_id"]: r["scope_text"] for r in summaries.collect()}["ISA-200"] == "1. 첫 문단\n\n (a) 항목"
    docs = jobs.ingest(spark, str(folder), "ISA").collect()
    assert {d["standard"]["standard_id"] for d in docs} == {"ISA-200", "ISA-300"}


def test_body_table_family(spark, tmp_path):
    write(tmp_path / "q.docx", para("표지") + table([["", "서론"], ["1.", ["본문", "(a) 가지", "이어짐"]], ["", "감독(문단 32(b) 참조)"], ["", "문단번호"], ["", ""], ["x", "y", "z"], ["", "모르는 제목"]]))
    rows = [(r["idx"], r["kind"], r["text"], r["label"]) for r in docx.body_table_blocks(jobs.with_styles(docx.read_docx(spark, str(tmp_path)), docx.read_docx(spark, str(tmp_path), "styles"))).orderBy("idx").collect()]
    assert rows == [
        (0, "paragraph_body", "표지", None), (1, "heading", "서론", None), (2, "requirement", "본문", "1."), (3, "sub_item", "(a) 가지", "(a)"), (4, "paragraph_body", "이어짐", None),
        (5, "heading", "감독", None), (6, "paragraph_body", "모르는 제목", None),
    ]
    made = jobs.structured(spark, str(tmp_path), "ISQM").collect()
    assert {r["standard_no"] for r in made} == {"1"} and all(r["section"] is None and r["paragraph_id"] is None for r in made)


def test_descent_and_preludes(spark, tmp_path):
    write(tmp_path / "a.docx", para("개요") + para("서론") + table([[["안쪽 하나", "안쪽 둘"]], ["x"]]))
    texts = [(r["kind"], r["text"]) for r in jobs.structured(spark, str(tmp_path), "ASSR").orderBy("idx").collect()]
    assert texts == [("table", ""), ("paragraph_body", "안쪽 하나"), ("paragraph_body", "안쪽 둘"), ("paragraph_body", "x")]


FRAMEWORK = """---
schema_version: "1.0"
standard_id: "FRMK-1"
standard_no: "1"
source_file: "f.docx"
---

## 서론

<!-- section: intro | idx: 1 -->

## 보론: 역할과 책임

<!-- idx: 2 -->

| 문단번호 | |
| --- | --- |
|  | 서론 |
| 1 | 첫 문단 |
| 2 | 둘째 \\| 문단 |
|  | 소제목 |
| 3 | 셋째 |
| 보론 |  |
| 4 | 부록 |
| a | b | c |
<!-- kind: table | rows: 9 | cols: 2 | idx: 7 -->

첫 문단
<!-- kind: paragraph_body | idx: 8 -->
"""


def test_framework_rows(spark, tmp_path):
    (tmp_path / "FRMK-1.md").write_text(FRAMEWORK)
    _, chunks, _, _ = jobs.parsed(spark, str(tmp_path), "FRMK")
    rows = {(r["content_text"], r["source_idx"]): r for r in chunks.collect()}
    by = {k[0]: r for k, r in rows.items()}
    assert by["첫 문단"]["paragraph_id"] == "1" and by["첫 문단"]["heading_trail"] == ["FRMK-1", "서론"] and by["첫 문단"]["section"] == "intro"
    assert by["둘째 | 문단"]["paragraph_id"] == "2"
    assert by["셋째"]["heading_trail"] == ["FRMK-1", "서론", "소제목"]
    assert by["부록"]["section"] == "appendix" and by["부록"]["heading_trail"] == ["FRMK-1", "보론: 역할과 책임"] and by["부록"]["special_appendix_name"] == "역할과 책임"
    assert by["보론: 역할과 책임"]["source_idx"] == 0
    assert sorted(i for _, i in rows if i > 1000) == [7001, 7002, 7003, 7004, 7005, 7006][: len([i for _, i in rows if i > 1000])]


def test_unsafe_xml():
    with pytest.raises(docx.UnsafeXML):
        docx.parse_xml(b'<!DOCTYPE a [<!ENTITY b "c">]><a>&b;</a>')
    deep = "<w:sdt><w:sdtContent>" * 12 + para("x") + "</w:sdtContent></w:sdt>" * 12
    buffer = io.BytesIO()
    write(buffer, deep)
    with pytest.raises(ValueError, match="deeper"):
        list(docx.rows_of(buffer, "x", "body"))


def simulate(rows, starts):
    """The sequential rules: a deeper level resets what lies between; a level's first use may take its override."""
    state, used, last, out = {}, set(), {}, []
    for key, ilvl, override in rows:
        c = state.setdefault(key, [s - 1 for s in starts])
        if (key, ilvl) not in used:
            used.add((key, ilvl))
            if override is not None:
                c[ilvl] = override - 1
        if key in last and ilvl > last[key]:
            for k in range(last[key] + 1, ilvl + 1):
                c[k] = starts[k] - 1
        c[ilvl] += 1
        last[key] = ilvl
        out.append(list(c[: ilvl + 1]))
    return out


def test_counters_against_simulation(spark):
    rng = random.Random(5)
    starts = [1, 1, 3, 1]
    rows = [(rng.choice("ab"), rng.randint(0, 3), rng.choice([None, None, 7])) for _ in range(600)]
    df = spark.createDataFrame([(i, k, l, o) for i, (k, l, o) in enumerate(rows)], "idx int, k string, ilvl int, override int").withColumn("starts", F.array(*map(F.lit, starts)))
    got = [r["counter"] for r in counters(df, ["k"], "idx", levels=4).orderBy("idx").collect()]
    assert got == simulate(rows, starts)


def test_trails_against_stacks(spark):
    rng = random.Random(6)
    levels = [rng.choice([None, 1, 2, 3, 4]) for _ in range(300)]
    df = spark.createDataFrame([(i, l, f"h{i}") for i, l in enumerate(levels)], "i int, l int, t string").withColumn("d", F.lit(1))
    popped = [r["heading_trail"] for r in trail(df, F.col("l"), F.col("t"), ["d"], "i").orderBy("i").collect()]
    gapped = [r["heading_trail"] for r in trail(df, F.col("l"), F.col("t"), ["d"], "i", gap=True).orderBy("i").collect()]
    stack, places = [], []
    for i, level in enumerate(levels):
        if level is not None:
            stack = [(l, t) for l, t in stack if l < level] + [(level, f"h{i}")]
            places = (places + [""] * 9)[: level - 1] + [f"h{i}"] if len(places) < level - 1 else places[: level - 1] + [f"h{i}"]
        assert popped[i] == [t for _, t in stack]
        assert gapped[i] == places


def test_columns(spark):
    import hashlib
    import json
    import uuid

    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    trail_ = [" 서론 ", 'a"b', ""]
    assert one(K.trail_hash(F.array(*map(F.lit, trail_)))) == hashlib.sha1(json.dumps([t.strip() for t in trail_], ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()[:8]
    assert one(K.uuid5(F.lit("ISA-200:x"))) == str(uuid.uuid5(uuid.NAMESPACE_DNS, "ISA-200:x"))
    got = spark.range(1, 800).select(K.letters(F.col("id")).alias("l"), K.roman(F.col("id")).alias("r")).collect()
    assert [got[i]["l"] for i in (0, 25, 26, 701, 702)] == ["a", "z", "aa", "zz", "aaa"] and [got[i]["r"] for i in (3, 8, 39, 798)] == ["iv", "ix", "xl", "dccxcix"]
    assert one(K.label(F.lit("%1.%2)"), F.array(F.lit(4), F.lit(3)), F.array(F.lit("upperRoman"), F.lit("lowerLetter")))) == "IV.c)"
    assert one(K.comment_fields(F.lit(r"para: 1. | kind: a\|b | junk | kind: c"))) == {"para": "1.", "kind": "c"}
    assert one(K.plain_text(F.lit("7.\t본문  글\n> 인용"), F.lit("7."), F.lit("requirement"))) == "본문 글\n인용"
    assert one(K.heading_range(F.lit("삼자관계27-38"))) == ("삼자관계", "27-38") and one(K.heading_range(F.lit("보론 1")))["range"] is None
    assert [one(numbered_appendix(F.lit(h)))["index"] for h in ("보론 2 x", "보론. y", "서론")] == [2, 1, None]
    assert one(named_appendix(F.lit("보론. 이름"))) == (None, "이름")
    assert one(K.item_label(F.lit("(가) 글"))) == "(가)" and one(K.item_label(F.lit("글"))) is None
    assert one(K.trail_hash(F.array().cast("array<string>"))) == "97d170e1"
    assert one(valid_standard_id(F.lit("ISA-20"))) is False and profile_of("FRMK-1").prefix == "FRMK"
    assert one(family_of(F.lit("3. 품질관리기준서1.docx"))) == "ISQM"
    with pytest.raises(Exception, match="FAMILY"):
        one(family_of(F.lit("other.docx")))


def test_splitting(spark):
    words = F.size(F.split(F.lit("x"), " "))
    count = lambda c: F.size(F.split(c, " ")).cast("int")
    rng = random.Random(7)
    costs = [[rng.randint(1, 9) for _ in range(rng.randint(1, 20))] for _ in range(50)]
    got = spark.createDataFrame([(c,) for c in costs], "c array<int>").select("c", split.packed(F.col("c"), 12).alias("b")).collect()
    for r in got:
        out, total, b = [], 0, 0
        for k, x in enumerate(r["c"]):
            if total + x > 12 and total:
                b, total = b + 1, 0
            total += x
            out.append(b)
        assert r["b"] == out
    base = {"chunk_of": 1, "chunk_index": 0, "part_of": None}
    schema = "chunk_id string, kind string, content_text string, content_markdown string, table_cells array<array<string>>, token_estimate int, chunk_of int, chunk_index int, part_of string"
    long = "\n\n".join("w " * 4 + "w" for _ in range(5))
    rows = [("p", "requirement", long, long, None, 25), ("t", "table", "x", "x", [["h", "i"], *([["a b c", "d"]] * 4)], 99), ("q", "block_quote", long, long, None, 25), ("s", "requirement", "short", "short", None, 1)]
    df = spark.createDataFrame([(*r, 1, 0, None) for r in rows], schema)
    got = {r["chunk_id"]: r for r in split.split_oversized(df, 18, count).collect()}
    assert set(got) == {"p", "p#1", "t", "t#1", "t#2", "t#3", "q", "s"} or {"p", "p#1", "t", "t#1", "q", "s"} <= set(got)
    assert got["p#1"]["part_of"] == "p" and got["p"]["chunk_of"] == 2 and got["p"]["content_text"].count("\n\n") == 2
    assert all(got[k]["table_cells"][0] == ["h", "i"] for k in got if k.startswith("t"))
    with pytest.raises(Exception, match="SPLIT"):
        split.split_oversized(df.withColumn("kind", F.lit("bullet")), 18, count).collect()


def test_collisions_and_links(spark):
    schema = "standard_id string, chunk_id string, paragraph_id string, kind string, heading_trail array<string>, parent_paragraph_id string, chunk_index int, source_idx int, ordinal int"
    rows = [("S", "a", "1.", "requirement", ["x", "y"], None, 0, 1, 1), ("S", "a", "1.", "requirement", ["x", "z"], None, 0, 2, 2), ("S", "g", "A1.", "application_guidance", ["x", "z", "w"], "1.", 0, 3, 3), ("S", "d", "A2.", "application_guidance", ["x"], "9.", 0, 4, 4)]
    made = C.resolved_collisions(spark.createDataFrame(rows, schema))
    assert sorted(r["chunk_id"] for r in made.collect()) == ["a#1", "a#2", "d", "g"]
    assert [(r["source"], r["target"]) for r in C.links(made).collect()] == [("g", "a#2")]
    assert [r["chunk_id"] for r in C.dangling(made).collect()] == ["d"]
    with pytest.raises(Exception, match="not unique"):
        C.unique(spark.createDataFrame(rows, schema)).collect()


def test_store(spark, files, tmp_path):
    folder = tmp_path / "flat"
    folder.mkdir()
    for name, content in files.items():
        (folder / name).write_text(content)
    store = P.PointStore(spark, str(tmp_path / "store"))
    client = P.hash_client(8)
    jobs.ingest(spark, str(folder), "ISA", store, client, dim=8)
    n = store.count("audit_standards")
    standards, chunks, _, summaries = jobs.parsed(spark, str(folder), "ISA")
    assert n == chunks.count() + 2
    points = store.read("audit_standards")
    near = points.withColumn("collection", F.lit("c"))
    first = chunks.where("kind = 'application_guidance'").first()
    seeds = spark.createDataFrame([("q", first["content_text"], "k", [first["chunk_id"]], ["ISA-200"], "ko")], "query_id string, query_text string, category string, expected_chunk_ids array<string>, expected_standard_ids array<string>, lang_mix string")
    rows, by, all_ = jobs.evaluate_golden(seeds, points, client, 8)
    assert all_.first()["seed_count"] == 1 and by.count() == 3 and rows.first()["hit_rank"] is None or rows.first()["hit_rank"] >= 1
    told = jobs.answer(seeds.select("query_id", "query_text"), near, client, lambda q, c: f"{len(c)}", 8)
    assert told[0]["context"].startswith("# ") and told[0]["answer"] == str(len(told[0]["context"]))
    assert [df.count() for df in jobs.smoke(seeds.select("query_id", "query_text"), points, client, 8)] == [2, 5]
    first = points.where("vector_role = 'passage'").first()
    spark.createDataFrame(points.collect(), points.schema).write.parquet(str(tmp_path / "copy"))
    copy = spark.read.parquet(str(tmp_path / "copy"))
    assert store.upsert("audit_standards", copy) == {"points": n, "drift": 0, "pruned": 0}
    edited = copy.where("chunk_id not like '%:A1.'").withColumn("content_text_hash", F.when(F.col("chunk_id") == first["chunk_id"], F.lit("new")).otherwise(F.col("content_text_hash")))
    told = store.upsert("audit_standards", edited)
    assert told["pruned"] == 1 and told["drift"] in (0, 1) and store.count("audit_standards") == n - 1


def test_options_and_targets(spark, tmp_path):
    jobs.check_options(True, prune_stale=True)
    with pytest.raises(ValueError, match="prune_stale"):
        jobs.check_options(False, prune_stale=True, collection="audit_standards")
    assert [r["standard_id"] for r in jobs.targets(spark, "ISQM-1").collect()] == ["ISQM-1"] and jobs.targets(spark).count() == 3
    with pytest.raises(ValueError, match="TARGET"):
        jobs.targets(spark, "none")
    jobs.write_metrics(spark.range(1).select(F.lit(None).cast("string").alias("a"), "id"), str(tmp_path / "m"))
    assert '"a":null' in "".join(p.read_text() for p in (tmp_path / "m").glob("*.json"))


def test_cache_table(spark, tmp_path):
    cache = P.EmbeddingCache(spark, str(tmp_path / "cache"))
    texts = spark.createDataFrame([("passage", "a"), ("query", "b")], "role string, text string")
    _, wanted = P.requested(texts, cache.read())
    cache.add(P.embedded(wanted, P.hash_client(4), dim=4))
    cache.add(P.embedded(wanted, P.hash_client(4), dim=4))
    assert cache.read().count() == 2 and cache.get("passage", texts.select("text")).count() == 1
    assert P.requested(texts, cache.read())[1].count() == 0
    part = next((tmp_path / "cache").rglob("*.parquet"))
    part.write_bytes(b"broken")
    for crc in part.parent.glob(".*.crc"):
        crc.unlink()
    assert cache.read().count() == 0 and list(tmp_path.glob("cache.corrupt.*"))


def test_stream_merges_repeatably(spark, tmp_path):
    from tessera.streaming.ingest import merge_stream

    schema = "point_id string, chunk_id string, standard_id string, content_text_hash string"
    spark.createDataFrame([("1", "a", "S", "x"), ("2", "b", "S", "y")], schema).write.parquet(str(tmp_path / "in"))
    store = P.PointStore(spark, str(tmp_path / "store"))
    for run in ("one", "two"):
        merge_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), store, "c", str(tmp_path / run)).awaitTermination()
    assert store.count("c") == 2


def test_embedding_cache(spark):
    texts = spark.createDataFrame([("passage", "a"), ("passage", "b"), ("passage", "a"), ("query", "a")], "role string, text string")
    _, wanted = P.requested(texts, None)
    cache = P.embedded(wanted, P.hash_client(4), dim=4)
    assert cache.count() == 3
    _, again = P.requested(texts, spark.createDataFrame(cache.collect(), cache.schema))
    assert again.count() == 0
    with pytest.raises(Exception, match="DIM"):
        P.embedded(wanted, P.hash_client(5), dim=4).collect()
    with pytest.raises(Exception, match="OVERFLOW"):
        P.requested(spark.createDataFrame([("passage", "x" * 20000)], "role string, text string"), None)[0].collect()

"""Jobs end to end: files that are written are read again, texts are embedded once, writers that die lose nothing."""

import http.server
import json
import threading

import pytest
from pyspark.sql import functions as F

from tessera.operators import points as P
from tessera.operators import validate
from tessera.operators.styles import with_styles
from tessera.plans import jobs
from tessera.sources import documents, docx, markdown


def content(number, n):
    body = "\n\n".join(f"{k}.\ttext {number} {k}\n<!-- para: {k}. | kind: requirement | idx: {k} -->" for k in range(1, n + 1))
    return f'---\nschema_version: "1.0"\nstandard_id: "ISA-{number}"\nstandard_no: "{number}"\nsource_file: "x.docx"\n---\n\n## 요구사항\n<!-- section: requirements | idx: 0 -->\n\n{body}\n'


@pytest.fixture
def folder(spark, tmp_path):
    rows = [(f"ISA-{n}.md", content(n, 3).rstrip("\n")) for n in (200, 210)]
    documents.write_named(spark.createDataFrame(rows, "file_name string, value string"), str(tmp_path / "md"))
    return tmp_path / "md"


def test_files_have_their_names_and_are_read_again(spark, folder):
    assert sorted(p.name for p in folder.iterdir() if p.suffix == ".md") == ["ISA-200.md", "ISA-210.md"] and (folder / "ISA-200.md").read_text() == content(200, 3)
    assert {r["file_name"]: r["content"] for r in markdown.read_markdown(spark, str(folder), "ISA").collect()} == {f"ISA-{n}.md": content(n, 3) for n in (200, 210)}


def counting(tmp_path, dim=8):
    """A client whose calls leave a line in a file, as it runs in other processes."""
    log, inner = str(tmp_path / "calls"), P.hash_client(dim)

    def call(texts, model):
        with open(log, "a") as f:
            f.write("".join(json.dumps(t) + "\n" for t in texts))
        return inner(texts, model)

    return call, lambda: [json.loads(x) for x in open(log)] if (tmp_path / "calls").exists() else []


def test_texts_are_embedded_once(spark, folder, tmp_path):
    client, sent = counting(tmp_path)
    store, told = P.PointStore(spark, str(tmp_path / "store")), []
    jobs.ingest(spark, str(folder), "ISA", store, client, dim=8, dry_run=True)
    assert not store.exists("audit_standards") and len(sent()) == len(set(sent())) == 8  # six chunks and two summaries
    for _ in range(2):
        jobs.ingest(spark, str(folder), "ISA", store, client, dim=8, told=told)
    assert len(sent()) == 8 and store.count("audit_standards") == 8
    assert told == [{"collection": "audit_standards", "points": 8, "drift": 0, "pruned": 0}] * 2
    (folder / ".ISA-200.md.crc").unlink(missing_ok=True)
    (folder / "ISA-200.md").write_text(content(200, 2).replace("text 200 1", "other"))
    jobs.ingest(spark, str(folder), "ISA", store, client, dim=8, told=told)
    assert len(sent()) == 9 and told[-1] == {"collection": "audit_standards", "points": 7, "drift": 1, "pruned": 1}
    points = store.read("audit_standards")
    assert points.count() == 7 and points.where(F.col("content_text") == "other").first()["vector"] is not None


def test_a_failed_family_does_not_stop_the_others(spark, folder, tmp_path):
    (folder / "ASSR-3000.md").write_text("no front matter")
    store = P.PointStore(spark, str(tmp_path / "store"))
    runs = {r["family"]: r for r in jobs.ingest_all(spark, str(folder), store, P.hash_client(8), ["ASSR", "ISA"], str(tmp_path / "json"), dim=8).collect()}
    assert (runs["ASSR"]["failed"], runs["ISA"]["failed"], runs["ISA"]["points"]) == (1, 0, 8) and runs["ASSR"]["reason"]
    made = documents.read_documents(spark, str(tmp_path / "json" / "ISA"))
    assert {r["standard"]["standard_id"] for r in made.collect()} == {"ISA-200", "ISA-210"} and (tmp_path / "json" / "ISA" / "ISA-200.json").exists()
    assert {r["outcome"] for r in jobs.migrate(spark, str(tmp_path / "json" / "ISA"), str(tmp_path / "new")).collect()} == {"already"}


POINT = "point_id string, chunk_id string, standard_id string, content_text_hash string"


def test_a_dead_writer_loses_nothing(spark, tmp_path):
    store = P.PointStore(spark, str(tmp_path))
    store.upsert("c", spark.createDataFrame([("1", "a", "S", "x"), ("2", "b", "T", "y")], POINT))
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    store.upsert("c", spark.createDataFrame([("1", "a", "S", "z"), ("1", "a", "S", "q")], POINT))
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())  # what isn't touched isn't rewritten
    assert sorted((r["point_id"], r["content_text_hash"]) for r in store.read("c").collect()) == [("1", "z"), ("2", "y")]
    with pytest.raises(Exception, match="dies"):
        store.upsert("c", spark.createDataFrame([("1", "a", "S", "w")], POINT).withColumn("content_text_hash", F.raise_error(F.lit("dies")).cast("string")))
    spark.createDataFrame([("9", "n", "S", "v")], POINT).write.partitionBy("standard_id").parquet(str(tmp_path / "c" / "seg-00000009" / "points"))  # a writer that died before its list of standards
    assert store.count("c") == 2 and store.segments("c") == [1, 2]
    store.replace("c", store.read("c"))
    assert len(store.segments("c")) == 1 and store.count("c") == 2
    cache = P.EmbeddingCache(spark, str(tmp_path / "cache"))
    _, wanted = P.requested(spark.createDataFrame([("passage", "a")], "role string, text string"), None)
    cache.add(P.embedded(wanted, P.hash_client(4), dim=4))
    (tmp_path / "cache").rename(tmp_path / "cache.before")
    assert cache.read().count() == 1


def test_service_clients():
    asked = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            asked.append((self.headers["Authorization"], body))
            if self.headers["Authorization"] != "Bearer k":
                self.send_error(401)
                return
            if "messages" in body:
                out = {"choices": [{"message": {"content": body["messages"][-1]["content"].upper()}}]}
            else:
                out = {"data": [{"index": i, "embedding": [float(len(t)), 0.0]} for i, t in reversed(list(enumerate(body["input"])))], "usage": {"total_tokens": 7}}
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps(out).encode())

        def log_message(self, *args):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/"
    assert P.service_client(url, "k")(["a", "bbb"], "m") == ([[1.0, 0.0], [3.0, 0.0]], 7) and asked[0][1] == {"model": "m", "input": ["a", "bbb"]}
    assert jobs.service_answer(url, "k")("q", "c") == "C\n\nQ"
    with pytest.raises(P.AuthError):
        P.service_client(url, "wrong")(["a"], "m")
    server.shutdown()


def test_repeated_names_in_dimensions(spark):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    styles = f'<w:styles {w}><w:style w:styleId="a"><w:name w:val="first"/></w:style><w:style w:styleId="a"><w:name w:val="last"/></w:style></w:styles>'
    import io
    import zipfile

    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        z.writestr("word/styles.xml", styles)
        z.writestr("word/document.xml", f'<w:document {w}><w:body><w:p><w:pPr><w:pStyle w:val="a"/></w:pPr><w:r><w:t>t</w:t></w:r></w:p></w:body></w:document>')
    files = spark.createDataFrame([("f.docx", held.getvalue())], "name string, content binary")
    made = with_styles(docx.parsed(files), docx.parsed(files, "styles")).collect()
    assert [r["style"] for r in made] == ["last"]
    rows = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 1, "z")], "k string, pos int, v string")
    assert sorted(r["v"] for r in validate.latest(rows, ["k"], "pos").collect()) == ["y", "z"] and sorted(r["v"] for r in validate.earliest(rows, ["k"], "pos").collect()) == ["x", "z"]


def test_checks_of_fields_and_members(spark):
    rows = spark.createDataFrame([(1, ["a", "b"], ["b"]), (2, ["a"], None)], "id long, e array<string>, a array<string>")
    assert [r["lacking"] for r in validate.missing_members(rows, "e", "a").orderBy("id").collect()] == [["a"], ["a"]]
    assert validate.missing_fields(rows, {"id": "bigint", "e": "array<string>", "x": "string", "a": "string"}) == ["a", "x"]
    assert validate.token_stats(rows.where("id < 0").select(F.col("id").alias("token_estimate"))).first().asDict() == dict.fromkeys(("count", "min", "max", "mean", "p50", "p95", "p99"), 0)

"""Registered queries of the engine's own operators, with the DuckDB SQL that gives the same rows.

The tables stand in for documents: `events` are the paragraphs of a user's document in order of event_id, `embeddings` are
points whose label is their standard, `documents` are texts, `conversations` are marked lines. Every query runs over its
whole tables; searches take as queries the rows whose id is divisible by 20.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import columns as K
from tessera.operators import chunks as C
from tessera.operators import evaluate, points, search, split, validate
from tessera.operators import structure as S
from tessera.operators.numbering import counters, kind_counts, unknown_ratio
from tessera.operators.styles import resolved_styles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(c) -> F.Column:
    """Arrays as text, for results."""
    return F.array_join(c, "|")


# -- vectors ----------------------------------------------------------------------------------------------------------


def _points(spark: SparkSession, sf: str) -> DataFrame:
    e = t(spark, sf, "embeddings")
    return e.select(F.col("vec_id").alias("chunk_id"), F.col("label").cast("long").alias("standard_id"), (F.col("label") % 4).cast("long").alias("collection"), F.col("embedding").alias("vector"))


def _queries(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "embeddings").where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"), F.col("label").cast("long").alias("query_label"))


def _summaries(spark: SparkSession, sf: str) -> DataFrame:
    """A summary vector for each label: the mean of its vectors, to six places."""
    e = t(spark, sf, "embeddings").select(F.col("label").cast("long").alias("standard_id"), F.posexplode("embedding").alias("at", "x"))
    mean = e.groupBy("standard_id", "at").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("x"))
    return mean.groupBy("standard_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("vector")).select(F.col("standard_id").alias("chunk_id"), "standard_id", "vector")


_V = """q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS qv, CAST(label AS BIGINT) AS query_label FROM embeddings WHERE vec_id % 20 = 0),
p AS (SELECT vec_id AS chunk_id, CAST(embedding AS DOUBLE[]) AS v, CAST(label AS BIGINT) AS standard_id, CAST(label % 4 AS BIGINT) AS collection FROM embeddings),
s AS (SELECT q.query_id, q.query_label, p.chunk_id, p.standard_id, p.collection, round(list_cosine_similarity(q.qv, p.v), 6) AS score FROM q, p)"""
_M = """m AS (SELECT standard_id, list(x ORDER BY i) AS v FROM (SELECT CAST(label AS BIGINT) AS standard_id, i, round(avg(CAST(embedding[i] AS DOUBLE)), 6) AS x FROM embeddings, unnest(range(1, len(embedding) + 1)) u(i) GROUP BY ALL) GROUP BY ALL),
s1 AS (SELECT * FROM (SELECT q.query_id, m.standard_id, row_number() OVER (PARTITION BY q.query_id ORDER BY round(list_cosine_similarity(q.qv, m.v), 6) DESC, m.standard_id) AS r FROM q, m) WHERE r <= 3)"""


@query(f"WITH {_V} SELECT * FROM (SELECT query_id, chunk_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM s) WHERE rank <= 5")
def knn_topk(spark, sf):
    hits = search.search(_queries(spark, sf).select("query_id", "query_vector"), _points(spark, sf), 5)
    return hits.select("query_id", "chunk_id", "score", F.col("rank").cast("long").alias("rank"))


@query(f"WITH {_V} SELECT * FROM (SELECT query_id, chunk_id, standard_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM s WHERE standard_id IN (1, 3, 5) AND NOT chunk_id = query_id) WHERE rank <= 5")
def knn_filtered_topk(spark, sf):
    near = search.nearest(_queries(spark, sf).select("query_id", "query_vector"), _points(spark, sf).where(F.col("standard_id").isin(1, 3, 5)), 6).where("chunk_id <> query_id")
    return search.top(near, ["query_id"], 5).select("query_id", "chunk_id", "standard_id", "score", F.col("rank").cast("long").alias("rank"))


@query(f"WITH {_V}, {_M} SELECT * FROM (SELECT s.query_id, s.chunk_id, s.standard_id, s.score, row_number() OVER (PARTITION BY s.query_id ORDER BY s.score DESC, s.chunk_id) AS rank FROM s JOIN s1 USING (query_id, standard_id)) WHERE rank <= 5")
def two_stage_pooled(spark, sf):
    _, hits = search.two_stage(_queries(spark, sf).select("query_id", "query_vector"), _summaries(spark, sf), _points(spark, sf))
    return hits.select("query_id", "chunk_id", "standard_id", "score", F.col("rank").cast("long").alias("rank"))


@query(f"WITH {_V}, {_M} SELECT query_id, chunk_id, standard_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM (SELECT s.*, row_number() OVER (PARTITION BY s.query_id, s.standard_id ORDER BY s.score DESC, s.chunk_id) AS r2 FROM s JOIN s1 USING (query_id, standard_id)) WHERE r2 <= 5")
def two_stage_per_standard(spark, sf):
    _, hits = search.two_stage(_queries(spark, sf).select("query_id", "query_vector"), _summaries(spark, sf), _points(spark, sf), per_standard=True)
    return search.reranked(hits.drop("rank")).select("query_id", "chunk_id", "standard_id", "score", F.col("rank").cast("long").alias("rank"))


@query(f"WITH {_V} SELECT query_id, chunk_id, collection, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id, collection ORDER BY score DESC, chunk_id) AS r FROM s) WHERE r <= 3) WHERE rank <= 3")
def cross_collection_topn(spark, sf):
    hits = search.across(_queries(spark, sf).select("query_id", "query_vector"), _points(spark, sf), 3)
    return hits.select("query_id", "chunk_id", "collection", "score", F.col("rank").cast("long").alias("rank"))


_HITS = f"""{_V}, h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM s WHERE chunk_id <> query_id) WHERE rank <= 10),
f AS (SELECT q.query_id, q.query_label, min(h.rank) AS hit_rank FROM q LEFT JOIN h ON q.query_id = h.query_id AND h.standard_id = q.query_label GROUP BY ALL),
j AS (SELECT *, coalesce(hit_rank <= 5, false) AS recalled, CASE WHEN hit_rank <= 10 THEN 1.0::DOUBLE / hit_rank ELSE 0.0::DOUBLE END AS rr FROM f)"""


def _ranked(spark, sf) -> DataFrame:
    """Queries with the rank of the first hit of their own label."""
    asked = _queries(spark, sf)
    near = search.nearest(asked.select("query_id", "query_vector"), _points(spark, sf), 11).where("chunk_id <> query_id")
    hits = search.top(near, ["query_id"], 10).select("query_id", "standard_id", "rank")
    best = hits.join(asked.select("query_id", F.col("query_label").alias("standard_id")), ["query_id", "standard_id"]).groupBy("query_id").agg(F.min("rank").alias("hit_rank"))
    return evaluate.judged(asked.select("query_id", "query_label").join(best, "query_id", "left"))


@query(f"WITH {_HITS} SELECT count(*) AS seed_count, round(coalesce(avg(recalled::INT), 0.0), 6) AS recall, round(coalesce(avg(rr), 0.0), 6) AS mrr, round(coalesce(avg(recalled::INT), 0.0), 6) >= 0.6 AND round(coalesce(avg(rr), 0.0), 6) >= 0.5 AS passed FROM j")
def retrieval_eval(spark, sf):
    return evaluate.totals(_ranked(spark, sf))


@query(f"WITH {_HITS}, g AS (SELECT *, 'c' || (query_label % 3) AS category, CASE WHEN query_label % 2 = 0 THEN 'ko' ELSE 'ko_en' END AS lang_mix FROM j) SELECT CASE WHEN grouping(category) = 0 THEN 'category' WHEN grouping(lang_mix) = 0 THEN 'lang' ELSE 'all' END AS by, category, lang_mix, count(*) AS seed_count, round(avg(recalled::INT), 6) AS recall, round(avg(rr), 6) AS mrr FROM g GROUP BY GROUPING SETS ((category), (lang_mix), ())")
def retrieval_eval_grouped(spark, sf):
    rows = _ranked(spark, sf).withColumn("category", F.concat(F.lit("c"), (F.col("query_label") % 3).cast("string"))).withColumn("lang_mix", F.when(F.col("query_label") % 2 == 0, "ko").otherwise("ko_en"))
    return evaluate.metrics(rows)


@query(f"WITH {_V.split('s AS')[0].rstrip().rstrip(',')}, {_M.split('s1 AS')[0].rstrip().rstrip(',')} SELECT a.standard_id AS a, b.standard_id AS b, round(list_cosine_similarity(a.v, b.v), 6) AS similarity FROM m a JOIN m b ON a.standard_id < b.standard_id")
def pairwise_cosine_bias(spark, sf):
    return evaluate.pairwise(_summaries(spark, sf))


@query(f"""WITH {_V}, h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM s) WHERE rank <= 5)
SELECT h.query_id, '# Audit Standards RAG Context\n사용자 질문: q' || h.query_id || '\n\n## 1. 기준서 후보\n- score=' || printf('%.4f', any_value(h.score) FILTER (rank = 1)) || ' standard_id=' || (any_value(standard_id) FILTER (rank = 1)) || ' collection=' || (any_value(collection) FILTER (rank = 1))
 || '\n  summary: x\n\n## 2. 검색된 근거 문단\n' || string_agg('\n### [' || chunk_id || ']\nscore=' || printf('%.4f', score) || '; standard_id=' || standard_id || '; kind=k; section=s' || '\nheading: a > b\n' || 'body ' || chunk_id, '\n' ORDER BY rank) AS context FROM h GROUP BY h.query_id""")
def context_builder(spark, sf):
    asked = _queries(spark, sf).select("query_id", "query_vector")
    hits = search.search(asked, _points(spark, sf), 5).withColumns({c: F.col(c).cast("string") for c in ("chunk_id", "standard_id", "collection")})
    rows = hits.select("query_id", "rank", "score", "chunk_id", "standard_id", "collection", F.lit("k").alias("kind"), F.lit("s").alias("section"), F.lit(None).cast("string").alias("paragraph_id"), F.lit("").alias("special_appendix_name"), F.array(F.lit("a"), F.lit(""), F.lit("b")).alias("heading_trail"), F.concat(F.lit("body "), "chunk_id").alias("content_text"))
    return search.context(asked.select("query_id", F.concat(F.lit("q"), F.col("query_id").cast("string")).alias("query_text")), rows.where("rank = 1").withColumn("content_text", F.lit("x")), rows)


# -- numbering and structure over events --------------------------------------------------------------------------------


def _events(spark, sf) -> DataFrame:
    e = t(spark, sf, "events")
    return e.select("event_id", "user_id", "event_type", (F.floor("value") % 3).cast("int").alias("ilvl"), F.floor("value").cast("long").alias("v"))


_E = "e AS (SELECT event_id, user_id, event_type, CAST(floor(value) AS BIGINT) % 3 AS ilvl, CAST(floor(value) AS BIGINT) AS v FROM events)"


def _counter_sql(override: str = "NULL") -> str:
    """The counters of three levels in SQL: reset groups by running sums, counts within them, the override of a level's first row."""
    w = "PARTITION BY user_id, event_type ORDER BY event_id"
    down = ", ".join(f"CASE WHEN prev < {k} AND ilvl >= {k} THEN 1 ELSE 0 END AS d{k}" for k in range(3))
    group = ", ".join(f"sum(d{k}) OVER ({w}) AS g{k}" for k in range(3))
    count = ", ".join(f"count(*) FILTER (ilvl = {k}) OVER (PARTITION BY user_id, event_type, g{k} ORDER BY event_id) AS n{k}, first_value(CASE WHEN ilvl = {k} THEN {{'o': ov, 'g': g{k}, 'd': d{k}}} END IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f{k}" for k in range(3))
    value = ", ".join(f"CAST(CASE WHEN f{k}.o IS NOT NULL AND f{k}.d = 0 AND f{k}.g = g{k} THEN f{k}.o - 1 + n{k} ELSE n{k} END AS INTEGER) AS c{k}" for k in range(3))
    return f"""{_E}, e0 AS (SELECT *, {override} AS ov, lag(ilvl) OVER ({w}) AS prev FROM e), e1 AS (SELECT *, {down} FROM e0), e2 AS (SELECT *, {group} FROM e1), e3 AS (SELECT *, {count} FROM e2), e4 AS (SELECT *, {value} FROM e3)"""


def _counted(spark, sf, override=None) -> DataFrame:
    rows = _events(spark, sf).withColumn("override", F.lit(None).cast("int") if override is None else override).withColumn("starts", F.array(F.lit(1), F.lit(1), F.lit(1)))
    return counters(rows, ["user_id", "event_type"], "event_id", levels=3)


def _level_query(level: int):
    def run(spark, sf):
        return _counted(spark, sf).where(F.col("ilvl") >= level).select("event_id", F.element_at("counter", level + 1).alias("counter"))

    run.__name__ = f"list_counter_l{level}"
    return run


for _k in range(3):
    query(f"WITH {_counter_sql()} SELECT event_id, c{_k} AS counter FROM e4 WHERE ilvl >= {_k}")(_level_query(_k))


@query(f"WITH {_counter_sql('CASE WHEN v % 7 = 0 THEN CAST(v % 5 + 4 AS INTEGER) END')} SELECT event_id, CAST(c0 AS VARCHAR) || CASE WHEN ilvl >= 1 THEN '|' || c1 ELSE '' END || CASE WHEN ilvl >= 2 THEN '|' || c2 ELSE '' END AS counter FROM e4")
def list_counter_override(spark, sf):
    override = F.when(F.col("v") % 7 == 0, (F.col("v") % 5 + 4).cast("int"))
    return _counted(spark, sf, override).select("event_id", text("counter").alias("counter"))


@query(f"""WITH {_counter_sql()} SELECT event_id, c0 || '.' || CASE WHEN ilvl < 1 THEN '%2' WHEN c1 < 1 THEN '-' WHEN c1 <= 26 THEN chr(96 + c1) WHEN c1 <= 702 THEN chr(96 + (c1 - 1) // 26) || chr(97 + (c1 - 1) % 26) END || '.'
|| CASE WHEN ilvl < 2 THEN '%3' WHEN c2 <= 0 THEN CAST(c2 AS VARCHAR) ELSE repeat('m', c2 // 1000) || ['', 'c', 'cc', 'ccc', 'cd', 'd', 'dc', 'dcc', 'dccc', 'cm'][c2 // 100 % 10 + 1] || ['', 'x', 'xx', 'xxx', 'xl', 'l', 'lx', 'lxx', 'lxxx', 'xc'][c2 // 10 % 10 + 1] || ['', 'i', 'ii', 'iii', 'iv', 'v', 'vi', 'vii', 'viii', 'ix'][c2 % 10 + 1] END AS label FROM e4""")
def counter_label_render(spark, sf):
    # a level that was skipped stands at 0, which has no letter
    safe = F.array(F.lit("decimal"), F.lit("lowerLetter"), F.lit("lowerRoman"))
    rows = _counted(spark, sf).withColumn("template", F.lit("%1.%2.%3"))
    zero = F.get("counter", F.lit(1)) < 1
    rows = rows.withColumn("template", F.when(zero, F.replace(F.col("template"), F.lit("%2"), F.lit("-"))).otherwise(F.col("template"))).withColumn("shown", F.when(zero, F.transform("counter", lambda x, i: F.when(i == 1, F.lit(1)).otherwise(x))).otherwise(F.col("counter"))).withColumn("formats", safe)
    return rows.select("event_id", K.label(F.col("template"), F.col("shown"), F.col("formats")).alias("label"))


def _level(c):
    return F.when(F.col("event_type") == "view", F.lit(None)).otherwise(F.col("ilvl") + 1)


def _trail_sql(gap: bool) -> str:
    w = "PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    seen = ", ".join(f"last_value(CASE WHEN lvl = {k} THEN {{'at': event_id, 't': h}} END IGNORE NULLS) OVER ({w}) AS h{k}" for k in (1, 2, 3))
    live = "CASE WHEN h1 IS NOT NULL THEN h1.t END AS l1, CASE WHEN h2.at > coalesce(h1.at, -1) THEN h2.t END AS l2, CASE WHEN h3.at > greatest(coalesce(h1.at, -1), coalesce(h2.at, -1)) THEN h3.t END AS l3"
    made = "list_filter([l1, l2, l3], lambda x: x IS NOT NULL)"
    if gap:
        made = "CASE WHEN l3 IS NOT NULL THEN [coalesce(l1, ''), coalesce(l2, ''), l3] WHEN l2 IS NOT NULL THEN [coalesce(l1, ''), l2] WHEN l1 IS NOT NULL THEN [l1] ELSE [] END"
    return f"{_E}, a AS (SELECT *, CASE WHEN event_type <> 'view' THEN ilvl + 1 END AS lvl, event_type || v AS h FROM e), b AS (SELECT *, {seen} FROM a), c AS (SELECT *, {live} FROM b), d AS (SELECT event_id, user_id, {made} AS trail FROM c)"


def _trails(spark, sf, gap=False) -> DataFrame:
    return S.trail(_events(spark, sf), _level(None), F.concat("event_type", F.col("v").cast("string")), ["user_id"], "event_id", gap=gap, levels=3)


@query(f"WITH {_trail_sql(False)} SELECT event_id, array_to_string(trail, '|') AS trail FROM d")
def heading_trail_stack(spark, sf):
    return _trails(spark, sf).select("event_id", text("heading_trail").alias("trail"))


@query(f"WITH {_trail_sql(True)} SELECT event_id, array_to_string(trail, '|') AS trail FROM d")
def heading_trail_gapfill(spark, sf):
    return _trails(spark, sf, True).select("event_id", text("heading_trail").alias("trail"))


@query(f"WITH {_trail_sql(False)} SELECT event_id, substring(sha1(CAST(to_json(trail) AS VARCHAR)), 1, 8) AS trail_hash FROM d")
def trail_hash(spark, sf):
    return _trails(spark, sf).select("event_id", K.trail_hash(F.col("heading_trail")).alias("trail_hash"))


_FILL = "last_value({x} IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND {end})"


@query(f"WITH {_E} SELECT event_id, {_FILL.format(x="CASE event_type WHEN 'signup' THEN 'intro' WHEN 'error' THEN 'requirements' WHEN 'purchase' THEN 'application' END", end='CURRENT ROW')} AS section FROM e")
def section_forward_fill(spark, sf):
    signal = S.lookup(F.col("event_type"), {"signup": "intro", "error": "requirements", "purchase": "application"})
    return S.filled(_events(spark, sf), signal, ["user_id"], "event_id", "section").select("event_id", "section")


_KIND = "CASE event_type WHEN 'signup' THEN 'requirement' WHEN 'error' THEN 'application_guidance' WHEN 'click' THEN 'sub_item' ELSE 'paragraph_body' END"


@query(f"""WITH {_E}, k AS (SELECT *, {_KIND} AS kind, 'p' || event_id AS pid FROM e) SELECT event_id, CASE kind WHEN 'sub_item' THEN {_FILL.format(x="CASE WHEN kind IN ('requirement', 'application_guidance') THEN pid END", end='1 PRECEDING')} WHEN 'application_guidance' THEN {_FILL.format(x="CASE WHEN kind = 'requirement' THEN pid END", end='1 PRECEDING')} END AS parent FROM k""")
def parent_tracking(spark, sf):
    kind = F.coalesce(S.lookup(F.col("event_type"), {"signup": "requirement", "error": "application_guidance", "click": "sub_item"}), F.lit("paragraph_body"))
    rows = _events(spark, sf).withColumn("kind", kind).withColumn("paragraph_id", F.concat(F.lit("p"), F.col("event_id").cast("string")))
    return S.parents(rows, ["user_id"], ["user_id"], "event_id").select("event_id", F.col("parent_paragraph_id").alias("parent"))


@query(f"WITH {_E}, f AS (SELECT user_id, min(event_id) AS first FROM e WHERE event_type = 'signup' GROUP BY user_id) SELECT e.event_id, e.user_id FROM e JOIN f USING (user_id) WHERE e.event_id > first")
def prelude_skip(spark, sf):
    return S.after_marker(_events(spark, sf), F.col("event_type") == "signup", ["user_id"], "event_id").select("event_id", "user_id")


@query(f"WITH {_E} SELECT event_id, CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS unit, last_value(CASE WHEN event_type = 'signup' THEN v END IGNORE NULLS) OVER w AS opened FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
def unit_boundary(spark, sf):
    return S.units(_events(spark, sf), F.col("event_type") == "signup", F.col("v"), ["user_id"], "event_id").select("event_id", "unit", "opened")


@query(f"WITH {_E}, n AS (SELECT *, CASE event_type WHEN 'click' THEN 'bullet' ELSE 'decimal' END AS fmt, CASE event_type WHEN 'signup' THEN '%1.' WHEN 'error' THEN 'A%1.' ELSE '(%1)' END AS lvl FROM e) SELECT event_id, CASE WHEN fmt = 'bullet' THEN 'bullet' WHEN ilvl >= 1 THEN 'sub_item' WHEN lvl = '%1.' THEN 'requirement' WHEN lvl = 'A%1.' THEN 'application_guidance' ELSE 'unknown_numbering' END AS kind FROM n")
def kind_classify(spark, sf):
    return _kinds(spark, sf).select("event_id", "kind")


def _kinds(spark, sf) -> DataFrame:
    fmt = F.when(F.col("event_type") == "click", "bullet").otherwise("decimal")
    lvl = F.coalesce(S.lookup(F.col("event_type"), {"signup": "%1.", "error": "A%1."}), F.lit("(%1)"))
    return _events(spark, sf).withColumn("kind", K.kind_of_level(lvl, fmt, F.col("ilvl")))


_KINDS = ORACLE["kind_classify"]


@query(f"SELECT kind, count(*) AS n FROM ({_KINDS}) GROUP BY kind")
def kind_distribution(spark, sf):
    return kind_counts(_kinds(spark, sf))


@query(f"SELECT count(*) AS n, count(*) FILTER (kind = 'unknown_numbering') AS unknown, count(*) FILTER (kind = 'unknown_numbering') / count(*) AS ratio, count(*) FILTER (kind = 'unknown_numbering') / count(*) <= 0.05 AS passed FROM ({_KINDS})")
def unknown_ratio_gate(spark, sf):
    return unknown_ratio(_kinds(spark, sf))


@query("""WITH RECURSIVE s AS (SELECT p_partkey AS id, CASE WHEN p_partkey > 1 AND p_partkey // 2 <> p_partkey THEN p_partkey // 2 END AS up, CASE WHEN p_size % 9 = 0 THEN 'n' || p_partkey END AS num, CASE WHEN p_size % 4 = 0 THEN p_size END AS ilvl FROM part),
c AS (SELECT id, num, ilvl, CASE WHEN num IS NULL THEN up END AS next, 1 AS depth FROM s UNION ALL SELECT c.id, s.num, coalesce(c.ilvl, s.ilvl), CASE WHEN s.num IS NULL THEN s.up END, depth + 1 FROM c JOIN s ON c.next = s.id WHERE depth < 10)
SELECT id AS style_id, num AS style_num_id, CASE WHEN num IS NOT NULL THEN coalesce(ilvl, 0) END AS style_ilvl FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY depth DESC) AS r FROM c) WHERE r = 1""")
def style_chain_closure(spark, sf):
    p = t(spark, sf, "part")
    up = F.floor(F.col("p_partkey") / 2).cast("long")
    styles = p.select(F.lit("f").alias("source_file"), F.col("p_partkey").alias("style_id"), F.when((F.col("p_partkey") > 1) & (up != F.col("p_partkey")), up).alias("based_on"), F.when(F.col("p_size") % 9 == 0, F.concat(F.lit("n"), F.col("p_partkey").cast("string"))).alias("num_id"), F.when(F.col("p_size") % 4 == 0, F.col("p_size")).alias("ilvl"))
    return resolved_styles(styles).select("style_id", "style_num_id", "style_ilvl")


@query("""WITH nums AS (SELECT * FROM (VALUES ('signup', 'L1'), ('error', 'L2'), ('click', 'L9')) v(num_id, abstract_id)), levels AS (SELECT * FROM (VALUES ('L1', 0, '%1.'), ('L1', 1, '(%2)'), ('L2', 0, 'A%1.')) v(abstract_id, ilvl, lvl_text)),
e AS (SELECT event_id, event_type, CAST(floor(value) AS BIGINT) % 3 AS ilvl FROM events) SELECT event_id, n.abstract_id, l.lvl_text FROM e LEFT JOIN nums n ON e.event_type = n.num_id LEFT JOIN levels l ON n.abstract_id = l.abstract_id AND e.ilvl = l.ilvl""")
def numbering_star_lookup(spark, sf):
    from tessera.operators.numbering import with_levels

    nums = spark.createDataFrame([("f", "signup", "L1", {}), ("f", "error", "L2", {}), ("f", "click", "L9", {})], "source_file string, num_id string, abstract_id string, overrides map<int,int>")
    levels = spark.createDataFrame([("f", "L1", 0, "%1.", "decimal", 1), ("f", "L1", 1, "(%2)", "decimal", 1), ("f", "L2", 0, "A%1.", "decimal", 1)], "source_file string, abstract_id string, ilvl int, lvl_text string, num_fmt string, start int")
    rows = _events(spark, sf).select("event_id", F.lit("f").alias("source_file"), F.col("event_type").alias("num_id"), "ilvl")
    return with_levels(rows, nums, levels).select("event_id", "abstract_id", "lvl_text")


# -- chunks over documents and conversations ----------------------------------------------------------------------------


def _chunks(spark, sf) -> DataFrame:
    """A chunk a document: its source is the standard, its language the section, its id modulo 50 the paragraph."""
    d = t(spark, sf, "documents")
    rows = d.select("doc_id", F.col("source").alias("standard_id"), F.col("lang").alias("section"), F.array("source", "lang").alias("heading_trail"), F.concat((F.col("doc_id") % 50).cast("string"), F.lit(".")).alias("paragraph_id"), F.lit("requirement").alias("kind"), F.col("doc_id").cast("int").alias("source_idx"), F.lit(0).alias("chunk_index"), "text")
    return rows.withColumn("heading_trail_hash", K.trail_hash(F.col("heading_trail"))).withColumn("chunk_id", K.chunk_id(F.col("standard_id"), F.col("section"), F.col("heading_trail_hash"), F.col("paragraph_id"), F.col("kind"), F.col("source_idx")))


_CH = "c AS (SELECT doc_id, source AS standard_id, source || ':' || lang || ':' || substring(sha1(CAST(to_json([source, lang]) AS VARCHAR)), 1, 8) || ':' || (doc_id % 50) || '.' AS chunk_id FROM documents)"


@query(f"WITH {_CH} SELECT * FROM c")
def chunk_identity_candidates(spark, sf):
    return _chunks(spark, sf).select("doc_id", "standard_id", "chunk_id")


@query(f"WITH {_CH} SELECT doc_id, CASE WHEN count(*) OVER (PARTITION BY standard_id, chunk_id) > 1 THEN chunk_id || '#' || doc_id ELSE chunk_id END AS chunk_id FROM c")
def chunk_identity_collisions(spark, sf):
    return C.resolved_collisions(_chunks(spark, sf)).select("doc_id", "chunk_id")


@query(f"WITH {_CH} SELECT chunk_id, count(*) AS n, string_agg(CAST(doc_id AS VARCHAR), '|' ORDER BY doc_id) AS source_idxs FROM c GROUP BY chunk_id HAVING count(*) > 1")
def chunk_uniqueness(spark, sf):
    return C.duplicate_ids(_chunks(spark, sf)).select("chunk_id", "n", text("source_idxs").alias("source_idxs"))


@query("""WITH h AS (SELECT doc_id, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode('doc:' || doc_id)) AS x FROM documents)
SELECT doc_id, substring(x, 1, 8) || '-' || substring(x, 9, 4) || '-5' || substring(x, 14, 3) || '-' || substring('89ab', (CAST('0x' || substring(x, 17, 1) AS INTEGER) % 4) + 1, 1) || substring(x, 18, 3) || '-' || substring(x, 21, 12) AS point_id FROM h""")
def point_ids_uuid5(spark, sf):
    return t(spark, sf, "documents").select("doc_id", K.uuid5(F.concat(F.lit("doc:"), F.col("doc_id").cast("string"))).alias("point_id"))


@query("SELECT doc_id, substring(sha256('embedding-passage:passage:' || text), 1, 16) AS cache_key, sha1(text) AS content_hash FROM documents")
def cache_keys(spark, sf):
    d = t(spark, sf, "documents")
    return d.select("doc_id", K.cache_key(points.model_for(F.lit("passage")), F.lit("passage"), F.col("text")).alias("cache_key"), K.content_hash(F.col("text")).alias("content_hash"))


@query(r"""WITH a AS (SELECT doc_id, regexp_replace('<!-- x -->' || text || chr(9) || '• tail', '<!--.*?-->', '', 'gs') AS x FROM documents), b AS (SELECT doc_id, regexp_replace(replace(x, chr(9), ' '), ' +', ' ', 'g') AS x FROM a),
c AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(x, '(?m)^\s*•\s*', '', 'g'), '(?m)^\s*>\s?', '', 'g'), '(?m)^\s*\[\?\]\s*', '', 'g') AS x FROM b) SELECT doc_id, sha256(regexp_replace(regexp_replace(x, '^\s+', ''), '\s+$', '')) AS plain_sha256 FROM c""")
def plain_text_normalise(spark, sf):
    none = F.lit(None).cast("string")
    rows = t(spark, sf, "documents").select("doc_id", F.concat(F.lit("<!-- x -->"), "text", F.lit("\t• tail")).alias("md"))
    return rows.select("doc_id", F.sha2(K.plain_text(F.col("md"), none, none).cast("binary"), 256).alias("plain_sha256"))


@query("SELECT n_nationkey, CASE WHEN NOT (kind = 'paragraph_body' AND section IS NULL AND trim(txt) IN ('목차', '문단번호')) THEN 'kept' ELSE 'leak' END AS outcome FROM (SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'paragraph_body' ELSE 'table' END AS kind, CASE WHEN n_nationkey % 3 = 0 THEN 'intro' END AS section, CASE n_nationkey % 5 WHEN 0 THEN n_name WHEN 1 THEN ' 목차 ' ELSE '문단번호' END AS txt FROM nation)")
def toc_leak_filter(spark, sf):
    n = F.col("n_nationkey")
    rows = t(spark, sf, "nation").select(n, F.when(n % 2 == 0, "paragraph_body").otherwise("table").alias("kind"), F.when(n % 3 == 0, "intro").alias("section"), F.when(n % 5 == 0, F.col("n_name")).when(n % 5 == 1, " 목차 ").otherwise("문단번호").alias("txt"))
    return rows.select("n_nationkey", F.when(C.leaks(F.col("kind"), F.col("section"), F.col("txt")), "leak").otherwise("kept").alias("outcome"))


@query("SELECT n_nationkey, n_name || '|x' || chr(10) || n_regionkey || '/\\' AS cells FROM nation")
def table_cells_parse(spark, sf):
    line = F.concat(F.lit("| "), "n_name", F.lit("\\|x | "), F.col("n_regionkey").cast("string"), F.lit(" | \\\\ |"))
    cells = K.table_row(line)
    return t(spark, sf, "nation").select("n_nationkey", F.concat(F.get(cells, F.lit(0)), F.lit("\n"), F.get(cells, F.lit(1)), F.lit("/"), F.get(cells, F.lit(2))).alias("cells"))


@query("""WITH l AS (SELECT conv_id, turn, role, text, coalesce(sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM conversations)
SELECT m.conv_id, m.turn, sha256(coalesce((SELECT string_agg(x.text, chr(10) ORDER BY x.turn) FROM l x WHERE x.conv_id = m.conv_id AND x.g = m.g AND x.turn < m.turn), '')) AS pending_sha256 FROM l m WHERE m.role = 'assistant'""")
def marker_accumulate(spark, sf):
    rows = C.accumulated(t(spark, sf, "conversations"), F.col("role") == "assistant", ["conv_id"], "turn", "text")
    return rows.select("conv_id", "turn", F.sha2(F.array_join("pending", "\n").cast("binary"), 256).alias("pending_sha256"))


@query("""WITH g AS (SELECT conv_id, turn, conv_id % 23 AS k FROM conversations WHERE role = 'assistant'), r AS (SELECT conv_id, turn, conv_id % 23 AS k FROM conversations WHERE role = 'system'),
p AS (SELECT g.conv_id || ':' || g.turn AS source, r.conv_id || ':' || r.turn AS target, CASE WHEN g.conv_id % 3 <> r.conv_id % 3 THEN 0 WHEN g.turn % 2 <> r.turn % 2 THEN 1 ELSE 2 END AS shared, r.conv_id * 1000 + r.turn AS ord FROM g JOIN r USING (k))
SELECT source, target FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY shared DESC, ord) AS n FROM p) WHERE n = 1""")
def paragraph_links_argmax(spark, sf):
    return C.links(_turns(spark, sf)).select("source", "target")


def _turns(spark, sf) -> DataFrame:
    """Assistants' turns are guidance to the system turns of conversations of the same remainder; trails tell them apart."""
    c = t(spark, sf, "conversations").where(F.col("role").isin("assistant", "system"))
    name = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    guidance = F.col("role") == "assistant"
    key = (F.col("conv_id") % 23).cast("string")
    return c.select(
        F.lit("S").alias("standard_id"), name.alias("chunk_id"), F.when(~guidance, key).alias("paragraph_id"), F.when(guidance, "application_guidance").otherwise("requirement").alias("kind"),
        F.array((F.col("conv_id") % 3).cast("string"), (F.col("turn") % 2).cast("string")).alias("heading_trail"), F.when(guidance, key).alias("parent_paragraph_id"), F.lit(0).alias("chunk_index"), (F.col("conv_id") * 1000 + F.col("turn")).alias("ordinal"),
    )


@query("SELECT conv_id || ':' || turn AS chunk_id, CAST(conv_id % 23 AS VARCHAR) AS parent FROM conversations c WHERE role = 'assistant' AND NOT EXISTS (SELECT 1 FROM conversations r WHERE r.role = 'system' AND r.conv_id % 23 = c.conv_id % 23)")
def dangling_parents(spark, sf):
    return C.dangling(_turns(spark, sf)).select("chunk_id", F.col("parent_paragraph_id").alias("parent"))


@query("SELECT CAST(conv_id AS VARCHAR) AS standard_id, sha256(coalesce(string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (role = 'user'), '')) AS scope_sha256, sha256(coalesce(string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (role = 'assistant'), '')) AS definitions_sha256 FROM conversations GROUP BY conv_id")
def summary_listagg(spark, sf):
    c = t(spark, sf, "conversations")
    raw = c.select(F.col("conv_id").cast("string").alias("standard_id"), F.lit("1").alias("standard_no"), F.when(F.col("role") == "assistant", "definitions").alias("section"), F.when(F.col("role") == "user", F.array(F.lit("이 감사기준서의 범위"))).otherwise(F.array().cast("array<string>")).alias("heading_trail"), F.split("text", "\n", -1).alias("lines"), F.col("turn").alias("ordinal"))
    made = C.summaries(raw)
    digest = lambda x: F.sha2(F.coalesce(x, F.lit("")).cast("binary"), 256)
    return made.select("standard_id", digest(F.col("scope_markdown")).alias("scope_sha256"), digest(F.col("definitions_markdown")).alias("definitions_sha256"))


# -- splitting ----------------------------------------------------------------------------------------------------------


@query("""WITH RECURSIVE l AS (SELECT doc_id, list_transform(list_filter(string_split(text, chr(10)), lambda x: x <> ''), lambda x: (strlen(x) + 3) // 4) AS cost FROM documents),
r AS (SELECT doc_id, cost, 1 AS i, 0 AS bucket, cost[1] AS total, [0] AS out FROM l WHERE len(cost) > 0
UNION ALL SELECT doc_id, cost, i + 1, CASE WHEN total + cost[i + 1] > 200 THEN bucket + 1 ELSE bucket END, CASE WHEN total + cost[i + 1] > 200 THEN cost[i + 1] ELSE total + cost[i + 1] END, list_append(out, CASE WHEN total + cost[i + 1] > 200 THEN bucket + 1 ELSE bucket END) FROM r WHERE i < len(cost))
SELECT doc_id, array_to_string(out, '|') AS buckets FROM r WHERE i = len(cost)""")
def split_paragraph_greedy(spark, sf):
    lines = F.filter(F.split("text", "\n", -1), lambda x: x != "")
    rows = t(spark, sf, "documents").select("doc_id", F.transform(lines, K.estimated_tokens).alias("cost")).where("size(cost) > 0")
    return rows.select("doc_id", text(split.packed(F.col("cost"), 200)).alias("buckets"))


@query("""WITH RECURSIVE r0 AS (SELECT l_suppkey, list((strlen('| ' || l_orderkey || ' | ' || l_linenumber || ' |') + 3) // 4 ORDER BY l_orderkey, l_linenumber, l_partkey) AS cost FROM lineitem GROUP BY l_suppkey),
r AS (SELECT l_suppkey, cost, 1 AS i, 0 AS bucket, 9 + cost[1] AS total FROM r0 UNION ALL SELECT l_suppkey, cost, i + 1, CASE WHEN total + cost[i + 1] > 400 THEN bucket + 1 ELSE bucket END, CASE WHEN total + cost[i + 1] > 400 THEN 9 + cost[i + 1] ELSE total + cost[i + 1] END FROM r WHERE i < len(cost))
SELECT l_suppkey, CAST(bucket + 1 AS BIGINT) AS parts, CAST(len(cost) AS BIGINT) AS rows FROM r WHERE i = len(cost)""")
def split_table_header_repeat(spark, sf):
    """Grids in parts, each with the header on top: `| orderkey | linenum |` and its rule are 36 bytes, the 9 tokens that the SQL starts a part with."""
    l = t(spark, sf, "lineitem")
    key = F.struct("l_orderkey", "l_linenumber", "l_partkey")
    body = F.transform(F.array_sort(F.collect_list(key)), lambda x: F.array(x["l_orderkey"].cast("string"), x["l_linenumber"].cast("string")))
    grids = l.groupBy("l_suppkey").agg(F.concat(F.array(F.array(F.lit("orderkey"), F.lit("linenum"))), body).alias("cells"))
    parts = split.table_parts(grids, "cells", "parts", 400)
    return parts.select("l_suppkey", F.size("parts").cast("long").alias("parts"), F.aggregate("parts", F.lit(0).cast("long"), lambda s, p: s + F.size(p) - 1).alias("rows"))


# -- the point store ----------------------------------------------------------------------------------------------------


def _versions(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Points of all documents, and the new ones: two thirds of them, some with other texts, and some that weren't there."""
    d = t(spark, sf, "documents")
    made = lambda df, body: df.select(F.col("doc_id").cast("string").alias("point_id"), F.col("doc_id").cast("string").alias("chunk_id"), F.col("source").alias("standard_id"), K.content_hash(body).alias("content_text_hash"))
    kept = d.where("doc_id % 3 <> 1")
    edited = F.when(F.col("doc_id") % 6 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    fresh = kept.withColumn("doc_id", F.col("doc_id") + 100_000_000).where("doc_id % 10 = 0")
    return made(d, F.col("text")), made(kept, edited).unionByName(made(fresh, F.col("text")))


_PT = """o AS (SELECT CAST(doc_id AS VARCHAR) AS point_id, source AS standard_id, sha1(text) AS h FROM documents), n AS (SELECT CAST(doc_id AS VARCHAR) AS point_id, source AS standard_id, sha1(CASE WHEN doc_id % 6 = 0 THEN text || '!' ELSE text END) AS h FROM documents WHERE doc_id % 3 <> 1
UNION ALL SELECT CAST(doc_id + 100000000 AS VARCHAR), source, sha1(text) FROM documents WHERE doc_id % 3 <> 1 AND doc_id % 10 = 0)"""


@query(f"WITH {_PT} SELECT n.point_id, o.h AS old_hash, n.h AS new_hash FROM n JOIN o USING (point_id) WHERE o.h <> n.h")
def payload_drift(spark, sf):
    old, new = _versions(spark, sf)
    return points.drift(old, new).select("point_id", "old_hash", "new_hash")


@query(f"WITH {_PT} SELECT point_id, standard_id FROM o WHERE standard_id IN (SELECT standard_id FROM n) AND point_id NOT IN (SELECT point_id FROM n)")
def stale_prune_antijoin(spark, sf):
    old, new = _versions(spark, sf)
    return points.stale(old, new).select("point_id", "standard_id")


@query(f"WITH {_PT} SELECT point_id, standard_id, h AS content_text_hash FROM n UNION ALL SELECT point_id, standard_id, h FROM o WHERE point_id NOT IN (SELECT point_id FROM n)")
def idempotent_merge(spark, sf):
    old, new = _versions(spark, sf)
    return points.merged(points.merged(old, new, prune=False), new, prune=False).select("point_id", "standard_id", "content_text_hash")


@query("""WITH c AS (SELECT d.doc_id, l.doc_id IS NOT NULL AS cached, (strlen(d.text) + 3) // 4 AS tik, CASE WHEN d.doc_id % 5 <> 0 THEN len(d.text) // 6 END AS sol FROM documents d LEFT JOIN labels l USING (doc_id)), f AS (SELECT * FROM c WHERE NOT cached)
SELECT (SELECT count(*) FROM c WHERE cached) AS cached_hits, CAST(coalesce(sum(tik), 0) AS BIGINT) AS total_tiktoken_tokens, CAST(coalesce(sum(sol), 0) AS BIGINT) AS total_solar_tokens, count(sol) AS solar_samples, CAST(coalesce(max(abs(sol - tik)), 0) AS BIGINT) AS max_abs_gap,
round(coalesce(max(sol / tik), 0), 6) AS max_ratio, round(coalesce(sum(sol), 0) / sum(tik), 6) AS mean_ratio FROM f""")
def embed_stats(spark, sf):
    d, l = t(spark, sf, "documents"), t(spark, sf, "labels").select("doc_id", F.lit(True).alias("hit"))
    calls = d.join(l, "doc_id", "left").select(F.coalesce("hit", F.lit(False)).alias("cached"), K.estimated_tokens(F.col("text")).cast("long").alias("tiktoken_tokens"), F.when(F.col("doc_id") % 5 != 0, F.floor(F.length("text") / 6)).alias("solar_tokens"))
    return points.embed_stats(calls)


@query("WITH c AS (SELECT doc_id, doc_id // 32 AS batch, (strlen(text) + 3) // 4 AS tik FROM documents), s AS (SELECT *, sum(tik) OVER (PARTITION BY batch) AS whole FROM c) SELECT doc_id, CAST(round_even(whole // 2 * tik / whole, 0) AS BIGINT) AS solar_tokens FROM s")
def prorata_tokens(spark, sf):
    rows = t(spark, sf, "documents").select("doc_id", F.floor(F.col("doc_id") / 32).alias("batch"), K.estimated_tokens(F.col("text")).cast("long").alias("tik"))
    rows = rows.withColumn("total", F.floor(F.sum("tik").over(Window.partitionBy("batch")) / 2))
    return points.prorated(rows, ["batch"], "total", "tik", "solar_tokens").select("doc_id", "solar_tokens")


# -- checks -------------------------------------------------------------------------------------------------------------


@query("""WITH v AS (SELECT list(n_chars ORDER BY n_chars) AS v FROM documents) SELECT CAST(len(v) AS BIGINT) AS count, v[1] AS min, v[len(v)] AS max, CAST(floor(list_sum(v) / len(v)) AS BIGINT) AS mean, v[CAST(round_even((len(v) - 1) * 50 / 100, 0) AS BIGINT) + 1] AS p50, v[CAST(round_even((len(v) - 1) * 95 / 100, 0) AS BIGINT) + 1] AS p95, v[CAST(round_even((len(v) - 1) * 99 / 100, 0) AS BIGINT) + 1] AS p99 FROM v""")
def token_percentiles_nearest_rank(spark, sf):
    return validate.token_stats(t(spark, sf, "documents"), "n_chars")


@query("SELECT name, value, count(*) AS n FROM (SELECT 'lang' AS name, lang AS value FROM documents UNION ALL SELECT 'source', source FROM documents UNION ALL SELECT 'toxic', CAST(toxic AS VARCHAR) FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY ALL")
def value_distributions(spark, sf):
    d = t(spark, sf, "documents").join(t(spark, sf, "labels").select("doc_id", "toxic"), "doc_id", "left")
    return validate.distributions(d, ["lang", "source", "toxic"])


@query("SELECT source, CASE WHEN source = 'src0' THEN '9.9' ELSE '1.2.0' END AS schema_version, CASE source WHEN 'src0' THEN 'unexpected' WHEN 'src1' THEN 'already' ELSE 'migrated' END AS outcome, count(*) AS chunks, 'chunk_id|appendix_index|special_appendix_name|kind' AS fields FROM documents GROUP BY source")
def schema_migration(spark, sf):
    d = t(spark, sf, "documents")
    chunk = F.struct(F.col("doc_id").cast("string").alias("chunk_id"), F.lit(1).alias("appendix_index"), F.col("lang").alias("kind"))
    docs = d.groupBy("source").agg(F.collect_list(chunk).alias("chunks")).withColumn("schema_version", F.when(F.col("source") == "src0", "9.9").when(F.col("source") == "src1", "1.2.0").otherwise("1.1.2"))
    made = validate.migrated(docs)
    fields = "|".join(made.schema["chunks"].dataType.elementType.fieldNames())
    return made.select("source", "schema_version", "outcome", F.size("chunks").cast("long").alias("chunks"), F.lit(fields).alias("fields"))


@query("WITH e AS (SELECT lang AS collection, count(*) + count(DISTINCT source) AS expected FROM documents GROUP BY lang), a AS (SELECT lang AS collection, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY lang) SELECT collection, coalesce(expected, 0) AS expected, coalesce(n, 0) AS n, coalesce(expected, 0) = coalesce(n, 0) AS passed FROM e FULL JOIN a USING (collection)")
def expected_vs_actual(spark, sf):
    d = t(spark, sf, "documents")
    docs = d.groupBy("lang", "source").agg(F.collect_list("doc_id").alias("chunks"))
    actual = d.join(t(spark, sf, "labels").select("doc_id"), "doc_id").groupBy(F.col("lang").alias("collection")).agg(F.count("*").alias("n"))
    return validate.compared(validate.expected_counts(docs, F.col("lang")), actual)


@query("SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_keys(spark, sf):
    return validate.missing(t(spark, sf, "documents"), t(spark, sf, "labels"), "doc_id")


# -- pages --------------------------------------------------------------------------------------------------------------


@query("""SELECT page_id, CASE WHEN page_id % 3 = 0 AND trim(url) <> '' THEN 'block_quote' ELSE 'table' END AS kind, CASE WHEN page_id % 3 = 0 THEN trim(url) ELSE '' END AS text FROM pages""")
def page_table_promote(spark, sf):
    grid = F.when(F.col("page_id") % 3 == 0, F.array(F.array("url"))).otherwise(F.array(F.array("url", "url"), F.array("url", "url")))
    rows = t(spark, sf, "pages").select("page_id", F.lit("table").alias("kind"), F.lit("").alias("text"), grid.alias("table_cells"))
    return S.promoted(rows).select("page_id", "kind", "text")

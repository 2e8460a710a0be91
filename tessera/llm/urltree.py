"""URL filter by path-template trees, with DataFrame operations only.

A rule list judges the urls that it fits. For the rest, every host has a tree of path segments, grown level by level
until no node has enough urls. Of a node's children those stay that have enough urls, and at least half the root of the
node's urls; the others are variable and become the wildcard `*`. So children that stay are those of sections, at most
twice that root, and ids and names are generalised however many urls each has. What a url has below a node with too few
urls is summed up as `**`.

Branches of a host whose labelled shares of blocked urls are statistically alike are merged: in the order of their smoothed
shares, a branch goes with the one before it unless a test of two proportions, by their counts, tells them apart. The
purity of a merged branch is its blocked share, smoothed towards the same template's share over all hosts, and that
towards the share over all labels. Templates of a purity of a half or more are rejected. The labels are, unless given,
the urls that a rule judges.

Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; path: then up to `?`, `#` or the end. A null
url or one without `://` has an empty host and path; such urls share one tree. Of rules that fit, the longest wins, and
the first in order of their text of equal ones. Equal urls get equal verdicts; a repeated page_id stays repeated. Counts
are of distinct urls. Very long paths are read whole: a level costs some jobs, and there are as many as the deepest path
has that `MIN_URLS` urls share. An empty table gives an empty result. Other columns are not read, but a labels column
may be named.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, UPPER, Scratch, small

#: (host and path, verdict) of the contract's rule list.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: Urls that a node needs to grow, and a child to stay.
MIN_URLS = 3
#: Prior weights: of a template over all hosts against a host's labels, and of the whole against a template's.
HOST_WEIGHT, TEMPLATE_WEIGHT = 4.0, 8.0
#: Standard normal value above which two shares differ.
DIFFERENT = 1.96


def parts(pages: DataFrame) -> DataFrame:
    """page_id, host, path."""
    rest = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce("url", F.lit(""))
    return pages.select("page_id", F.translate(F.regexp_extract(url, rest, 1), UPPER, LOWER).alias("host"), F.regexp_extract(url, rest, 2).alias("path"))


def fitting(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """struct(rule, verdict) of the longest rule that fits; null if none does."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the longest is tried first
        name, slash, below = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + below))
        chosen = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def templates(urls: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, path, template and others) for distinct urls (host, path and others): a level is one grouping and joins with its nodes, whose rows are cut."""
    now = scratch.cut(urls.withColumn("segments", F.split(F.regexp_replace("path", "^/", ""), "/")).withColumn("template", F.lit("")))
    done = []
    level = 0
    while not now.isEmpty():
        held = now.withColumn("segment", F.get("segments", F.lit(level)))
        counts = held.groupBy("host", "template", "segment").agg(F.count("*").alias("n"))
        nodes = counts.groupBy("host", "template").agg(F.sum("n").alias("total")).where(F.col("total") >= MIN_URLS)
        nodes = scratch.cut(nodes)
        kept = counts.where(F.col("n") >= MIN_URLS).join(small(nodes), ["host", "template"]).where(4 * F.col("n") * F.col("n") >= F.col("total"))
        kept = scratch.cut(kept.select("host", "template", "segment", F.lit(True).alias("stays")))
        joined = held.join(small(nodes.withColumn("grows", F.lit(True)).drop("total")), ["host", "template"], "left").join(small(kept), ["host", "template", "segment"], "left")
        step = F.when(F.col("grows").isNull(), F.lit("/**")).when(F.col("stays"), F.concat(F.lit("/"), "segment")).otherwise(F.lit("/*"))
        more = F.col("grows").isNotNull() & (F.size("segments") > level + 1)
        joined = joined.select(*urls.columns, "segments", F.concat("template", step).alias("template"), F.coalesce(more, F.lit(False)).alias("open"))
        made = scratch.cut(joined)
        done.append(made.where("not open").select(*urls.columns, "template"))
        now = made.where("open").drop("open")
        level += 1
    return functools.reduce(DataFrame.unionByName, done, now.select(*urls.columns, "template")) if done else now.drop("segments")


def purity(found: DataFrame) -> DataFrame:
    """(host, template, purity): of distinct urls with template and their labelled counts blocked and allowed."""
    leaf = found.groupBy("host", "template").agg(F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed"))
    over = leaf.groupBy("template").agg(F.sum("blocked").alias("t_blocked"), F.sum("allowed").alias("t_allowed"))
    whole = leaf.agg(((F.sum("blocked") + 1) / (F.sum("blocked") + F.sum("allowed") + 2)).alias("p")).first()["p"]
    whole = 0.5 if whole is None else float(whole)
    over = over.select(F.col("template").alias("t"), ((F.col("t_blocked") + TEMPLATE_WEIGHT * whole) / (F.col("t_blocked") + F.col("t_allowed") + TEMPLATE_WEIGHT)).alias("prior"))
    leaf = leaf.join(over, leaf["template"] == over["t"]).drop("t")
    labelled = F.col("blocked") + F.col("allowed")
    share = F.round((F.col("blocked") + HOST_WEIGHT * F.col("prior")) / (labelled + HOST_WEIGHT), 9)
    leaf = leaf.withColumn("share", share)
    # branches of equal shares are one; then each is held against the one before it
    equal = leaf.groupBy("host", "share").agg(F.sum("blocked").alias("b"), F.sum(labelled).alias("l"), F.sum(F.col("prior") * (labelled + 1)).alias("weighed"), F.sum(labelled + 1).alias("weight"))
    order = Window.partitionBy("host").orderBy("share")
    weight = F.col("l") + HOST_WEIGHT
    before, before_weight = F.lag("share").over(order), F.lag(weight).over(order)
    both = (F.col("share") * weight + before * before_weight) / (weight + before_weight)
    z = F.round((F.col("share") - before) / F.sqrt(both * (1 - both) * (1 / weight + 1 / before_weight)), 6)
    equal = equal.withColumn("new", F.when(z > DIFFERENT, 1).otherwise(0)).withColumn("step", F.sum("new").over(order))
    merged = equal.groupBy("host", "step").agg(F.sum("b").alias("b"), F.sum("l").alias("l"), (F.sum("weighed") / F.sum("weight")).alias("m"))
    merged = merged.select("host", "step", ((F.col("b") + HOST_WEIGHT * F.col("m")) / (F.col("l") + HOST_WEIGHT)).alias("purity"))
    of = equal.select("host", "share", "step").join(merged, ["host", "step"])
    return leaf.join(of, ["host", "share"]).select("host", "template", "purity")


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, label: str | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity. label: a column of pages with 1 for urls to block and 0 for others, else null; without it the rules label."""
    page = parts(pages) if label is None else parts(pages.withColumn("page_id", F.struct("page_id", F.col(label).alias("label")))).select("page_id.page_id", "host", "path", "page_id.label")
    judged = F.col("ruled.verdict")
    blocked, allowed = (judged == "block", judged == "allow") if label is None else (F.col("label") > 0, F.col("label") <= 0)
    page = page.withColumn("ruled", fitting(F.col("host"), F.col("path"), rules))
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    scratch = Scratch(pages.sparkSession, "urltree")
    urls = page.groupBy("host", "path").agg(count(blocked).alias("blocked"), count(allowed).alias("allowed"))
    found = templates(urls, scratch)
    known = found.join(small(scratch.cut(purity(found))), ["host", "template"])
    known = known.select(F.col("host").alias("u_host"), F.col("path").alias("u_path"), "template", "purity")
    page = page.join(known.hint("merge"), (page["host"] == known["u_host"]) & (page["path"] == known["u_path"]))
    method = F.when(F.round("purity", 9) >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return page.select("page_id", "host", "path", F.col("ruled.rule").alias("rule"), F.coalesce(F.col("ruled.verdict"), method).alias("verdict"), "template", F.round("purity", 9).alias("purity"))


def _oracle() -> str:
    """The same in DuckDB SQL; a level is a step of the recursion."""
    cases = "\n".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}') THEN {{'rule': '{h}/{p}', 'verdict': '{v}'}}" for (h, _, p), v in sorted((((r.partition("/")), v) for r, v in RULES), key=lambda x: -len("".join(x[0]))))
    return f"""
WITH RECURSIVE page AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
ruled AS (SELECT *, CASE {cases} ELSE NULL END AS ruled FROM page),
now0 AS (SELECT host, path, count(*) FILTER (ruled.verdict = 'block') AS blocked, count(*) FILTER (ruled.verdict = 'allow') AS allowed, string_split(regexp_replace(path, '^/', ''), '/') AS segments FROM ruled GROUP BY host, path),
walk AS (SELECT *, '' AS template, 0 AS level, true AS open FROM now0
  UNION ALL SELECT host, path, blocked, allowed, segments, template || CASE WHEN total < {MIN_URLS} THEN '/**' WHEN n >= {MIN_URLS} AND 4 * n * n >= total THEN '/' || segments[level + 1] ELSE '/*' END, level + 1, total >= {MIN_URLS} AND len(segments) > level + 1
  FROM (SELECT *, count(*) OVER (PARTITION BY host, template) AS total, count(*) OVER (PARTITION BY host, template, segments[level + 1]) AS n FROM walk WHERE open)),
found AS (SELECT * FROM walk WHERE NOT open),
leaf0 AS (SELECT host, template, sum(blocked) AS blocked, sum(allowed) AS allowed FROM found GROUP BY ALL),
whole AS (SELECT (sum(blocked) + 1) / (sum(blocked) + sum(allowed) + 2) AS p FROM leaf0),
over_all AS (SELECT template AS t, (sum(blocked) + {TEMPLATE_WEIGHT} * any_value(p)) / (sum(blocked) + sum(allowed) + {TEMPLATE_WEIGHT}) AS prior FROM leaf0, whole GROUP BY template),
leaf AS (SELECT *, round((blocked + {HOST_WEIGHT} * prior) / (blocked + allowed + {HOST_WEIGHT}), 9) AS share FROM leaf0 JOIN over_all ON template = t),
same AS (SELECT host, share, sum(blocked) AS b, sum(blocked + allowed) AS l, sum(blocked + allowed) + {HOST_WEIGHT} AS w, sum(prior * (blocked + allowed + 1)) AS weighed, sum(blocked + allowed + 1) AS weight FROM leaf GROUP BY ALL),
beside AS (SELECT *, lag(share) OVER o AS s0, lag(w) OVER o AS w0 FROM same WINDOW o AS (PARTITION BY host ORDER BY share)),
tested AS (SELECT *, CASE WHEN round((share - s0) / sqrt((share * w + s0 * w0) / (w + w0) * (1 - (share * w + s0 * w0) / (w + w0)) * (1 / w + 1 / w0)), 6) > {DIFFERENT} THEN 1 ELSE 0 END AS new FROM beside),
stepped AS (SELECT *, sum(new) OVER (PARTITION BY host ORDER BY share) AS step FROM tested),
merged AS (SELECT host, step, (sum(b) + {HOST_WEIGHT} * (sum(weighed) / sum(weight))) / (sum(l) + {HOST_WEIGHT}) AS purity FROM stepped GROUP BY ALL),
known AS (SELECT found.host, found.path, found.template, merged.purity FROM found JOIN leaf ON found.host = leaf.host AND found.template = leaf.template JOIN stepped ON leaf.host = stepped.host AND leaf.share = stepped.share
  JOIN merged ON leaf.host = merged.host AND stepped.step = merged.step)
SELECT page_id, ruled.host AS host, ruled.path AS path, ruled.rule AS rule, coalesce(ruled.verdict, CASE WHEN round(purity, 9) >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict, template, round(purity, 9) AS purity
FROM ruled JOIN known ON ruled.host = known.host AND ruled.path = known.path
"""


ORACLE = _oracle()

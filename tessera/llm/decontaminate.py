"""Benchmark decontamination through a positional inverted index, with DataFrame operations only.

Every window of a benchmark item (ten consecutive words; a shorter item is one window) is looked up by its rarest word
in the corpus: the postings (document, position) of these words, less the word's offset in the item, give the
diagonals on which an item may lie along a document. Diagonals that a second rare word of the window confirms are kept
where the window has one, and on each the words are compared, which gives the exact windows. Proximity matches ask for
the window's words within a distance instead.

The counts that tell which word is rare cover all documents. The postings are those of the rarest words only, which
keeps them small against the corpus. Tables whose size follows the benchmark are measured first and joined by broadcast
up to a bound of bytes, else by shuffle; the rows are the same.

Nulls: a null text has no words; a null item_id is the text 'null' in lists of items. Each of several texts
under one item_id, or under none, is looked up by itself. Documents of equal id are judged
row by row. Repeated items count once. Without benchmark items nothing is hit. Empty and very long texts are treated
alike. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, fold, small

WINDOW = 10
#: What stands between words, as a Java pattern over folded text.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text in order; of a null text, none."""
    return F.filter(F.split(fold(F.coalesce(text, F.lit(""))), BETWEEN), lambda w: w != "")


def windows(items: DataFrame, n: int = WINDOW) -> DataFrame:
    """(item string, text_key long: the hash of id and words, words array, start int, size int): the windows of distinct items.

    Items are told apart by text_key: rows of one id, or of none, may have different texts."""
    plain = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), words(F.col("text")).alias("words")).where("size(words) > 0").distinct()
    size = F.least(F.size("words"), F.lit(n))
    return plain.select("item", F.xxhash64("item", "words").alias("text_key"), "words", size.alias("size"), F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("start"))


def frequencies(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(word, n): how often each word of the vocabulary stands in the corpus."""
    return docs.select(F.explode(words(F.col("text"))).alias("word")).join(small(vocabulary), "word").groupBy("word").agg(F.count("*").alias("n"))


def anchors(found: DataFrame, counts: DataFrame) -> DataFrame:
    """(word, text_key, first, second, offset, role): for each window its rarest and second rarest word, the first of equals.

    first and second are the words' offsets in the item and name the pair; role is 1 or 2. A window of one word is its own second."""
    each = found.select("text_key", "start", F.posexplode(F.slice("words", F.col("start") + 1, F.col("size"))).alias("at", "word"))
    each = each.join(small(counts), "word", "left").select("text_key", "start", F.struct(F.coalesce("n", F.lit(0)).alias("n"), (F.col("start") + F.col("at")).alias("offset"), "word").alias("x"))
    order = each.groupBy("text_key", "start").agg(F.slice(F.array_sort(F.collect_list("x")), 1, 2).alias("x"))
    # a window with a word that the corpus lacks can't occur
    pair = order.where(F.col("x")[0]["n"] > 0).select("text_key", F.col("x")[0].alias("a"), F.coalesce(F.get("x", F.lit(1)), F.col("x")[0]).alias("b"))
    pair = pair.select("text_key", F.col("a.offset").alias("first"), F.col("b.offset").alias("second"), "a", "b").distinct()
    roles = F.array(F.struct(F.col("a.word").alias("word"), F.col("first").alias("offset"), F.lit(1).alias("role")), F.struct(F.col("b.word").alias("word"), F.col("second").alias("offset"), F.lit(2).alias("role")))
    return pair.select("text_key", "first", "second", F.explode(roles).alias("r")).select("r.word", "text_key", "first", "second", "r.offset", "r.role")


def postings(docs: DataFrame, of: DataFrame) -> DataFrame:
    """The positional index of docs (row_key, at, word), restricted to the words of `of`, with its columns."""
    return docs.select("row_key", F.posexplode(words(F.col("text"))).alias("at", "word")).join(small(of), "word")


def diagonals(places: DataFrame) -> DataFrame:
    """(row_key, text_key, shift): where the offset-adjusted lists of a window's two rarest words meet."""
    lists = places.select("row_key", "text_key", (F.col("at") - F.col("offset")).alias("shift"), "first", "second", "role")
    met = lists.groupBy("row_key", "text_key", "shift", "first", "second").agg(F.bit_or("role").alias("roles")).where("roles = 3")
    return met.select("row_key", "text_key", "shift").distinct()


def keyed(docs: DataFrame) -> DataFrame:
    """docs as (doc_id, text, row_key, carried): row_key is the id with the text's hash, so that rows of equal id but different text stay apart; carried is the whole row, whatever its columns are named."""
    return docs.select("doc_id", "text", F.struct("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).alias("row_key"), F.struct(*docs.columns).alias("carried"))


def matches(docs: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """doc_id, n_words long, hits array<int> (positions of hit words, ascending), items array<string> (items with occurring windows) and carried (the row of docs), for every row of docs."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    base = keyed(docs)
    found = scratch.cut(windows(items, n))
    vocabulary = scratch.cut(found.select(F.explode("words").alias("word")).distinct())
    counts = scratch.cut(frequencies(base, vocabulary))
    index = scratch.cut(anchors(found, counts))
    texts = scratch.cut(found.select("text_key", "item", F.col("words").alias("item_words")).distinct())
    per_row = diagonals(postings(base, index)).join(small(texts), "text_key").groupBy("row_key").agg(F.collect_list(F.struct("item", "shift", "item_words")).alias("candidates"))
    candidates = scratch.cut(per_row).select(F.col("row_key").alias("key"), "candidates")
    # the texts are shuffled at any size, not their words, which take more room
    joined = base.join(candidates.hint("merge"), base["row_key"].eqNullSafe(candidates["key"]), "left").select("doc_id", "candidates", words(F.col("text")).alias("words"), "carried")

    def occurring(x: Column) -> Column:
        """Starts, in the document, of the item's windows that occur on this diagonal."""
        size = F.least(F.size(x["item_words"]), F.lit(n))
        starts = F.sequence(F.lit(0), F.size(x["item_words"]) - size)
        fits = lambda s: (x["shift"] + s >= 0) & (F.slice("words", F.greatest(x["shift"] + s, F.lit(0)) + 1, size) == F.slice(x["item_words"], s + 1, size))
        return F.transform(F.filter(starts, fits), lambda s: F.struct((x["shift"] + s).alias("from"), (x["shift"] + s + size - 1).alias("to")))

    judged = joined.select("doc_id", "carried", F.size("words").cast("long").alias("n_words"), F.transform("candidates", lambda x: F.struct(x["item"].alias("item"), occurring(x).alias("spans"))).alias("found"))
    kept = judged.select("doc_id", "carried", "n_words", F.filter("found", lambda x: F.size(x["spans"]) > 0).alias("found"))
    hits = F.array_sort(F.array_distinct(F.flatten(F.transform(F.flatten(F.transform("found", lambda x: x["spans"])), lambda s: F.sequence(s["from"], s["to"])))))
    none = F.array().cast("array<int>")
    return kept.select(
        "doc_id",
        "n_words",
        F.coalesce(hits, none).alias("hits"),
        F.coalesce(F.array_sort(F.array_distinct(F.transform("found", lambda x: x["item"]))), F.array().cast("array<string>")).alias("items"),
        "carried",
    )


def clean(docs: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """The rows of docs, as they are, in which no window of an item occurs. Each row is judged by its own text, whatever its doc_id."""
    return matches(docs, items, n).where(F.size("hits") == 0).select("carried.*")


def proximity(docs: DataFrame, items: DataFrame, within: int = 20, n: int = WINDOW) -> DataFrame:
    """(doc_id, item, start, at): windows of items all of whose words stand within `within` words of an occurrence, at position at, of the window's rarest word."""
    scratch = Scratch(docs.sparkSession, "proximity")
    base = keyed(docs)
    found = scratch.cut(windows(items, n))
    counts = scratch.cut(frequencies(base, scratch.cut(found.select(F.explode("words").alias("word")).distinct())))
    index = scratch.cut(anchors(found, counts)).where("role = 1").select("word", "text_key", "offset").distinct()
    near = postings(base, index).select("row_key", "text_key", "offset", "at").distinct()
    window = scratch.cut(found.select("text_key", "item", "start", "size", F.slice("words", F.col("start") + 1, F.col("size")).alias("asked")))
    near = near.join(small(window), "text_key").where("offset >= start and offset < start + size")
    held = near.groupBy("row_key").agg(F.collect_list(F.struct("item", "start", "at", "asked")).alias("near"))
    row = base.select("doc_id", F.col("row_key").alias("key"), words(F.col("text")).alias("words"))
    around = lambda x: F.slice("words", F.greatest(x["at"] - within, F.lit(0)) + 1, 2 * within + 1)
    kept = row.join(held, row["key"].eqNullSafe(held["row_key"])).select("doc_id", F.filter("near", lambda x: F.size(F.array_except(x["asked"], around(x))) == 0).alias("near"))
    return kept.select("doc_id", F.explode("near").alias("x")).select("doc_id", "x.item", "x.start", "x.at")


def digests(docs: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return matches(docs, items, n).select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item, least(len(w), 10) AS k, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS g FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) t(s) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS g FROM d, ks, unnest(range(1, len(w) - k + 2)) t(s) WHERE len(w) >= k),
m AS (SELECT DISTINCT doc_id, s, dw.k AS k, item FROM dw JOIN bw ON dw.g = bw.g AND dw.k = bw.k),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM m, unnest(range(s, s + k)) t(p) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""

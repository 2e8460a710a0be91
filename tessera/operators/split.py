"""Splitting oversized chunks under a token budget: table rows, then paragraphs, sentences, and fixed slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import TokenCount, estimated_tokens, part_id, strip

SOFT_LIMIT = 3500
ATOMIC = ["block_quote", "unknown_numbering"]
LIST_ITEMS = ["bullet", "sub_item"]
SENTENCE = r"(?<=[.!?。!?])\s+|(?<=[다요]\.)\s+|(?<=까\?)\s+"


def packed(costs: Column, limit: Column | int, start: Column | int = 0) -> Column:
    """ARRAY<INT>: the bucket of each item, filled in order; an item that would pass the limit opens the next, unless the bucket is empty.

    start is what every bucket costs by itself. The fold is per row, as where a bucket ends depends on the sum that it resets; it keeps the buckets' sizes, not a place for each item."""
    limit, start = (x if isinstance(x, Column) else F.lit(x) for x in (limit, start))
    zero = F.struct(F.array().cast("array<int>").alias("sizes"), start.cast("long").alias("sum"), F.lit(0).alias("n"))

    def step(s: Column, cost: Column) -> Column:
        opens = (s["sum"] + cost > limit) & (s["n"] > 0)
        sizes = F.when(opens, F.concat(s["sizes"], F.array(s["n"]))).otherwise(s["sizes"])
        return F.struct(sizes.alias("sizes"), (F.when(opens, start.cast("long")).otherwise(s["sum"]) + cost).alias("sum"), F.when(opens, 1).otherwise(s["n"] + 1).alias("n"))

    dealt = lambda s: F.flatten(F.transform(F.concat(s["sizes"], F.array(s["n"])), lambda n, bucket: F.array_repeat(bucket, n)))
    return F.aggregate(costs, zero, step, dealt)


def paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(strip(text), r"\n\s*\n"), strip), lambda p: p != "")


def sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(strip(text), SENTENCE), strip), lambda p: p != "")


def joined(items: Column, buckets: Column, separator: str = "\n\n") -> Column:
    """ARRAY<STRING>: the items of each bucket in one text. Both are columns, read by index."""
    count = F.coalesce(F.array_max(buckets) + 1, F.lit(0))
    one = lambda b: F.array_join(F.filter(items, lambda _, i: F.get(buckets, i) == b), separator)
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), one)).otherwise(F.array().cast("array<string>"))


def sliced(text: Column, limit: int, tokens: TokenCount) -> Column:
    """ARRAY<STRING>: slices of equal length, of as many characters as the text's density of tokens allows."""
    n = F.greatest(F.ceil(tokens(text) / limit).cast("int"), F.lit(1))
    size = F.greatest(F.floor(F.length(text) / n).cast("int"), F.lit(1))
    return F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.length(text) / size).cast("int") - 1, F.lit(0))), lambda i: F.substring(text, i * size + 1, size))


def aligned(markdown: Column, buckets: Column) -> Column:
    """ARRAY<STRING>: the Markdown's paragraphs dealt to as many buckets as the text has, in proportion; the texts themselves where it has fewer."""
    parts = F.split(strip(markdown), r"\n\s*\n")
    n = F.size(buckets)
    per = F.greatest(F.floor(F.size(parts) / n).cast("int"), F.lit(1))
    dealt = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda b: F.array_join(F.filter(parts, lambda _, i: F.least(F.floor(i / per).cast("int"), n - 1) == b), "\n\n"))
    return F.when(F.size(parts) >= n, dealt).otherwise(buckets)


def text_buckets(df: DataFrame, text: str, out: str, limit: int = SOFT_LIMIT, tokens: TokenCount = estimated_tokens) -> DataFrame:
    """df with out, the texts that a text is split into: by paragraphs, else sentences of too long ones, else slices of the whole."""
    a, b, c, d = (f"{out}__{k}" for k in "abcd")
    over = lambda col: F.exists(col, lambda x: tokens(x) > limit)
    df = df.withColumn(a, paragraphs(F.col(text)))
    df = df.withColumn(b, packed(F.transform(a, tokens), limit)).withColumn(b, joined(F.col(a), F.col(b)))
    finer = F.flatten(F.transform(a, lambda p: F.when(tokens(p) > limit, sentences(p)).otherwise(F.array(p))))
    df = df.withColumn(c, finer).withColumn(d, packed(F.transform(c, tokens), limit)).withColumn(d, joined(F.col(c), F.col(d)))
    chosen = F.when(~over(F.col(b)), F.col(b)).when(~over(F.col(d)), F.col(d)).otherwise(sliced(F.col(text), limit, tokens))
    return df.withColumn(out, chosen).drop(a, b, c, d)


def row_text(cells: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))


def table_parts(df: DataFrame, cells: str, out: str, limit: int = SOFT_LIMIT, tokens: TokenCount = estimated_tokens) -> DataFrame:
    """df with out, ARRAY<ARRAY<ARRAY<STRING>>>: a grid in parts within the limit, each with the first row on top.

    A row that doesn't fit beside the first raises. Grids of a row or of one part are one part."""
    rows, cost, top, bucket = (f"{out}__{k}" for k in ("rows", "cost", "top", "bucket"))
    head = F.get(F.col(cells), F.lit(0))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), F.size(head)), " | "), F.lit(" |"))
    df = df.withColumn(rows, F.slice(cells, 2, F.greatest(F.size(cells), F.lit(1)))).withColumn(cost, F.transform(rows, lambda r: tokens(row_text(r))))
    df = df.withColumn(top, tokens(F.concat(row_text(head), F.lit("\n"), rule)))
    big = F.exists(cost, lambda c: c + F.col(top) > limit)
    df = df.withColumn(bucket, F.when(big, F.raise_error(F.lit("[SPLIT] a table row is over the limit")).cast("array<int>")).otherwise(packed(F.col(cost), limit, F.col(top))))
    count = F.coalesce(F.array_max(bucket) + 1, F.lit(0))
    parts = F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda b: F.concat(F.array(head), F.filter(rows, lambda _, i: F.get(F.col(bucket), i) == b)))
    return df.withColumn(out, F.when((F.size(cells) >= 2) & (count > 1), parts).otherwise(F.array(F.col(cells)))).drop(rows, cost, top, bucket)


def split_oversized(chunks: DataFrame, limit: int = SOFT_LIMIT, tokens: TokenCount = estimated_tokens) -> DataFrame:
    """chunks, in which those over the limit are parts: the first keeps the id, the others add #1, #2, ..

    Parts of a split, quotations and unknown patterns pass; list items raise. Only the rows over the limit take the
    longer way, the others are passed by a filter."""
    small = chunks.where(F.col("token_estimate") <= limit)
    big = chunks.where(F.col("token_estimate") > limit)
    passes = (F.col("chunk_of") > 1) | F.col("kind").isin(ATOMIC)
    told = F.concat(F.lit("[SPLIT] a list item is over the limit: "), "chunk_id")
    item = F.col("kind").isin(LIST_ITEMS)
    by_table = (F.col("kind") == "table") & F.col("table_cells").isNotNull()
    passed = big.where(passes)
    rest = big.where(~passes).withColumn("kind", F.when(item, F.raise_error(told).cast("string")).otherwise(F.col("kind")))
    tables = table_parts(rest.where(by_table), "table_cells", "parts__", limit, tokens)
    texts = text_buckets(rest.where(~by_table), "content_text", "parts__", limit, tokens)
    line = lambda r: F.array_join(F.transform(r, strip), " ")
    head = F.get("grid__", F.lit(0))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), F.size(head)), " | "), F.lit(" |"))
    tables = tables.withColumn("n__", F.size("parts__")).select("*", F.posexplode("parts__").alias("i__", "grid__"))
    markdown = F.array_join(F.concat(F.array(row_text(head), rule), F.transform(F.slice("grid__", 2, F.greatest(F.size("grid__"), F.lit(1))), row_text)), "\n")
    whole = F.col("n__") == 1
    tables = tables.withColumn("content_markdown", F.when(whole, F.col("content_markdown")).otherwise(markdown)).withColumn("content_text", F.when(whole, F.col("content_text")).otherwise(F.array_join(F.transform("grid__", line), "\n")))
    tables = tables.withColumn("table_cells", F.col("grid__")).drop("parts__", "grid__")
    texts = texts.withColumn("md__", aligned(F.col("content_markdown"), F.col("parts__"))).withColumn("n__", F.size("parts__")).select("*", F.posexplode("parts__").alias("i__", "t__"))
    texts = texts.withColumn("content_markdown", F.when(F.col("n__") <= 1, F.col("content_markdown")).otherwise(F.get("md__", F.col("i__")))).withColumn("content_text", F.when(F.col("n__") <= 1, F.col("content_text")).otherwise(F.col("t__")))
    texts = texts.withColumn("table_cells", F.when(F.col("n__") <= 1, F.col("table_cells"))).drop("parts__", "md__", "t__")
    parts = tables.unionByName(texts)
    many = F.col("n__") > 1
    parts = (
        parts.withColumn("part_of", F.when(many & (F.col("i__") > 0), F.col("chunk_id")).otherwise(F.col("part_of")))
        .withColumn("chunk_id", F.when(many, part_id(F.col("chunk_id"), F.col("i__"))).otherwise(F.col("chunk_id")))
        .withColumn("chunk_index", F.when(many, F.col("i__")).otherwise(F.col("chunk_index")))
        .withColumn("chunk_of", F.when(many, F.col("n__")).otherwise(F.col("chunk_of")))
        .withColumn("token_estimate", F.when(many, tokens(F.col("content_text"))).otherwise(F.col("token_estimate")))
        .drop("i__", "n__")
    )
    return small.unionByName(passed).unionByName(parts)

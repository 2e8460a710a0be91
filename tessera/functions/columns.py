"""Column functions: text clean-up, hashes and ids, counters and labels, vectors. All run in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Stands for an escaped pipe while a line is split at pipes.
ESCAPED = "￾"
#: The DNS namespace of version-5 UUIDs.
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"


def strip(c: Column) -> Column:
    """c without white space, Unicode's too, at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def presence(c: Column) -> Column:
    """c, with null for the empty text."""
    return F.when(c != "", c)


# -- hashes and ids ---------------------------------------------------------------------------------------------------


def trail_hash(trail: Column) -> Column:
    """Eight hexadecimal digits of the SHA-1 of a heading trail as compact JSON of stripped texts."""
    return F.substring(F.sha1(F.to_json(F.transform(trail, strip)).cast("binary")), 1, 8)


def uuid5(name: Column, namespace: str = DNS_NAMESPACE) -> Column:
    """The version-5 UUID of a name."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), name.cast("binary")))
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4) + 1, F.lit(1))
    part = lambda a, n: F.substring(digest, a, n)
    return F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("5"), part(14, 3)), F.concat(variant, part(18, 3)), part(21, 12))


def cache_key(model: Column, role: Column, text: Column) -> Column:
    """Sixteen hexadecimal digits that name the embedding of a text by a model in a role."""
    return F.substring(F.sha2(F.concat_ws(":", model, role, text).cast("binary"), 256), 1, 16)


def content_hash(text: Column) -> Column:
    return F.sha1(text.cast("binary"))


def chunk_id(standard: Column, section: Column, trail: Column, paragraph: Column, kind: Column, source_idx: Column) -> Column:
    """standard:section:trail:paragraph, or :kind#source_idx for a chunk without a paragraph id."""
    tail = F.coalesce(presence(paragraph), F.concat(kind, F.lit("#"), source_idx.cast("string")))
    return F.concat_ws(":", standard, F.coalesce(presence(section), F.lit("none")), trail, tail)


def part_id(whole: Column, part: Column) -> Column:
    """The id of a part of a split chunk: the first keeps the whole's."""
    return F.when(part == 0, whole).otherwise(F.concat(whole, F.lit("#"), part.cast("string")))


def utc_now(now: Column | None = None) -> Column:
    """A time, now unless given, as text with seconds, in the session's zone, which is to be UTC."""
    return F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM-dd'T'HH:mm:ss'Z'")


# -- counters and labels ----------------------------------------------------------------------------------------------


def roman(n: Column) -> Column:
    """Lower-case Roman numerals; n below 1 stays a decimal number."""
    digits = lambda one, five, ten: F.array(*map(F.lit, ("", one, one * 2, one * 3, one + five, five, five + one, five + one * 2, five + one * 3, one + ten)))
    place = lambda table, unit: F.element_at(table, (F.floor(n / unit) % 10 + 1).cast("int"))
    made = F.concat(F.repeat(F.lit("m"), F.floor(n / 1000).cast("int")), place(digits("c", "d", "m"), 100), place(digits("x", "l", "c"), 10), place(digits("i", "v", "x"), 1))
    return F.when(n > 0, made).otherwise(n.cast("string"))


def letters(n: Column) -> Column:
    """a, b, .. z, aa, ab, ..; raises for n below 1."""
    n = n.cast("long")
    steps = F.sequence(F.lit(1), F.lit(14))  # 26 ** 14 is beyond a long
    out = F.aggregate(
        steps,
        F.struct(n.alias("rest"), F.lit("").alias("text")),
        lambda s, _: F.struct(
            F.when(s["rest"] > 0, F.floor((s["rest"] - 1) / 26)).otherwise(F.lit(0)).cast("long").alias("rest"),
            F.when(s["rest"] > 0, F.concat(F.char(((s["rest"] - 1) % 26 + 97).cast("long")), s["text"])).otherwise(s["text"]).alias("text"),
        ),
        lambda s: s["text"],
    )
    return F.when(n >= 1, out).when(n.isNull(), F.lit(None)).otherwise(F.raise_error(F.concat(F.lit("[COUNTER] no letter for "), n.cast("string"))).cast("string"))


def counter_text(n: Column, fmt: Column) -> Column:
    """A counter in a list format: decimal, lower or upper letters or Roman numerals; bullets have none."""
    return (
        F.when(fmt == "bullet", F.lit(""))
        .when(fmt == "lowerLetter", letters(n))
        .when(fmt == "upperLetter", F.upper(letters(n)))
        .when(fmt == "lowerRoman", roman(n))
        .when(fmt == "upperRoman", F.upper(roman(n)))
        .otherwise(n.cast("string"))
    )


def label(template: Column, counters: Column, formats: Column) -> Column:
    """A level's label: %1, %2, .. stand for the counters of the levels, each in its own format.

    counters and formats are columns, read by index; a level without a format counts in decimals."""
    fmt = lambda i: F.coalesce(F.get(formats, i - 1), F.lit("decimal"))
    return F.aggregate(F.sequence(F.lit(1), F.size(counters)), template, lambda text, i: F.replace(text, F.concat(F.lit("%"), i.cast("string")), counter_text(F.element_at(counters, i), fmt(i))))


def kind_of_level(lvl_text: Column, fmt: Column, ilvl: Column) -> Column:
    """What a numbered paragraph is, by its level's template, format and depth."""
    return (
        F.when(fmt == "bullet", "bullet")
        .when(ilvl >= 1, "sub_item")
        .when((fmt == "decimal") & (lvl_text == "%1."), "requirement")
        .when((fmt == "decimal") & (lvl_text == "A%1."), "application_guidance")
        .otherwise("unknown_numbering")
    )


def kind_of_style(style: Column, toc: list[str], appendix: str) -> Column:
    """What a paragraph is by its style alone."""
    return F.when(style.isin(toc), "toc_entry").when((style == appendix) | F.startswith(style, F.lit("heading")), "heading").otherwise("paragraph_body")


def heading_level(style: Column, appendix: str) -> Column:
    """`heading N` is level N, an appendix title 3, anything else 2."""
    n = F.regexp_extract(style, r"^heading ([1-9])$", 1)
    return F.when(style == appendix, 3).when(n != "", n.cast("int")).otherwise(2)


def heading_range(text: Column) -> Column:
    """struct(text, range): a heading without the numbers of its paragraphs at the end; appendix headings stay."""
    t = strip(text)
    found = presence(F.regexp_extract(t, r"(\d+(?:-\d+)?)\s*$", 1))
    found = F.when(~F.startswith(t, F.lit("보론")), found)
    return F.struct(F.when(found.isNull(), t).otherwise(F.rtrim(F.regexp_replace(t, r"\d+(?:-\d+)?\s*$", ""))).alias("text"), found.alias("range"))


def without_reference(text: Column) -> Column:
    """A heading without `(문단 .. 참조)` or `(문단 .. 관련)` at the end."""
    return strip(F.regexp_replace(text, r"\s*\(문단.*(?:참조|관련)\s*\)\s*$", ""))


def item_label(text: Column) -> Column:
    """The label, such as (a), (가), (iv) or (12), that a text begins with; else null."""
    found = F.regexp_extract(text, r"^\s*\(([a-z]{1,2}|[가-힣]|[ivx]{1,4}|\d{1,2})\)\s*", 1)
    return F.when(found != "", F.concat(F.lit("("), found, F.lit(")")))


# -- Markdown ---------------------------------------------------------------------------------------------------------


def comment_fields(inner: Column) -> Column:
    """map of the `key: value` parts of a comment, between pipes; an escaped pipe belongs to a value; the last of equal keys stays."""
    parts = F.split(F.replace(inner, F.lit("\\|"), F.lit(ESCAPED)), r"\s*\|\s*")
    pairs = F.transform(
        F.filter(parts, lambda p: p.rlike(r"^[a-z_]+:\s*")),
        lambda p: F.struct(F.regexp_extract(p, r"^([a-z_]+):", 1).alias("key"), F.replace(F.regexp_extract(p, r"^[a-z_]+:\s*(.*)$", 1), F.lit(ESCAPED), F.lit("|")).alias("value")),
    )
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def is_table_row(line: Column) -> Column:
    return line.rlike(r"^\s*\|.*\|\s*$")


def is_table_rule(line: Column) -> Column:
    return line.rlike(r"^\s*(\|\s*:?-+:?\s*)+\|\s*$")


def table_row(line: Column) -> Column:
    """The cells of a Markdown table row, unescaped."""
    bare = F.regexp_replace(strip(F.replace(line, F.lit("\\|"), F.lit(ESCAPED))), r"^\||\|$", "")
    cell = lambda c: F.replace(F.replace(F.replace(strip(c), F.lit(ESCAPED), F.lit("|")), F.lit("<br>"), F.lit("\n")), F.lit("\\\\"), F.lit("\\"))
    return F.transform(F.split(bare, r"\|", -1), cell)


def table_cells(kind: Column, lines: Column) -> Column:
    """The grid of a chunk: a table's rows, a quotation's text as one cell, else null. lines is a column."""
    rows = F.transform(F.filter(lines, lambda x: is_table_row(x) & ~is_table_rule(x)), table_row)
    quote = strip(F.array_join(F.transform(F.filter(lines, lambda x: x != ""), lambda x: F.regexp_replace(x, r"^\s*>\s?", "")), "\n"))
    return F.when(kind == "table", F.when(F.size(rows) > 0, rows)).when(kind == "block_quote", F.array(F.array(quote)))


def plain_text(markdown: Column, paragraph: Column, kind: Column) -> Column:
    """Markdown without comments, tabs, runs of blanks, list and quotation marks and, for numbered kinds, the id in front."""
    text = F.regexp_replace(markdown, "(?s)<!--.*?-->", "")
    text = F.regexp_replace(F.replace(text, F.lit("\t"), F.lit(" ")), "[  ]+", " ")
    text = F.regexp_replace(text, r"(?mU)^\s*•\s*", "")
    text = F.regexp_replace(text, r"(?mU)^\s*>\s?", "")
    text = F.regexp_replace(text, r"(?mU)^\s*\[\?\]\s*", "")
    front = F.regexp_replace(text, r"(?U)^\s+", "")
    rest = F.substring(front, F.length(paragraph) + 1, F.length(front))
    numbered = (F.coalesce(paragraph, F.lit("")) != "") & kind.isin("requirement", "application_guidance", "sub_item") & F.startswith(front, paragraph) & rest.rlike(r"(?U)^\s")
    return strip(F.when(F.coalesce(numbered, F.lit(False)), rest).otherwise(text))


def yaml_text(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def from_yaml(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit('\\"'), F.lit('"')), F.lit("\\\\"), F.lit("\\"))


# -- numbers and vectors ----------------------------------------------------------------------------------------------


def estimated_tokens(text: Column) -> Column:
    """An estimate of a text's tokens: a quarter of its bytes, rounded up. Operators that count tokens take any such function."""
    return F.ceil(F.octet_length(F.coalesce(text, F.lit(""))) / 4).cast("int")


TokenCount = Callable[[Column], Column]


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; 0 where one has no length."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm).otherwise(F.lit(0.0))


def nearest_rank(values: Column, percent: float) -> Column:
    """The value at place (n - 1) * percent / 100, rounded half to even, of a sorted array column; 0 for none."""
    at = F.bround((F.size(values) - 1) * F.lit(percent) / 100.0).cast("int")
    return F.when(F.size(values) > 0, F.element_at(values, F.greatest(at, F.lit(0)) + 1)).otherwise(F.lit(0))


def shared_prefix(a: Column, b: Column) -> Column:
    """How many elements two arrays have in common from the start."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y) & x.isNotNull())
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")

"""Document structure: units, heading trails, sections and parents, from blocks in document order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import presence, strip
from tessera.model.profiles import APPENDIX_HEADING, APPENDIX_PREFIX, APPENDIX_STYLE, SECTION_BY_HEADING, TOC_STYLES, UNIT_HEADING, UNIT_NAME, Profile
from tessera.operators.numbering import numbered


def lookup(c: Column, table: dict[str, str]) -> Column:
    """The table's value for c, else null."""
    return F.element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), c)


def _order(keys: list[str], order: str):
    return Window.partitionBy(*keys).orderBy(order)


def after_marker(rows: DataFrame, marker: Column, keys: list[str], order: str) -> DataFrame:
    """The rows behind the first marker of each group; a group without a marker has none."""
    first = F.min(F.when(marker, F.col(order))).over(Window.partitionBy(*keys))
    return rows.withColumn("first__", first).where(F.col(order) > F.col("first__")).drop("first__")


def units(rows: DataFrame, opens: Column, value: Column, keys: list[str], order: str) -> DataFrame:
    """rows with unit (0 before the first opening row, then 1, 2, ..) and opened, the last opening row's value."""
    w = _order(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("unit", F.sum(F.when(opens, 1).otherwise(0)).over(w)).withColumn("opened", F.last(F.when(opens, value), ignorenulls=True).over(w))


def trail(rows: DataFrame, level: Column, text: Column, keys: list[str], order: str, out: str = "heading_trail", gap: bool = False, levels: int = 9) -> DataFrame:
    """rows with the texts of the headings that are open, outermost first. level is null where a row is no heading.

    A heading closes those of its level and deeper. With gap, places of levels that were skipped hold empty texts (so the
    trail's length is the level of its last heading), else they are left out."""
    w = _order(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"level__": level, "text__": text})
    names = [f"h{k}__" for k in range(1, levels + 1)]
    rows = rows.withColumns({name: F.last(F.when(F.col("level__") == k, F.struct(F.col(order).alias("at"), F.col("text__").alias("text"))), ignorenulls=True).over(w) for k, name in enumerate(names, 1)})
    live = []
    for k, name in enumerate(names):
        above = [F.coalesce(F.col(n)["at"], F.lit(-1)) for n in names[:k]]
        open_ = F.col(name).isNotNull() & (F.col(name)["at"] > F.greatest(F.lit(-1), F.lit(-1), *above)) if above else F.col(name).isNotNull()
        live.append(F.when(open_, F.col(name)["text"]))
    every = F.array(*live)
    if gap:
        depth = F.greatest(F.lit(0), F.lit(0), *(F.when(x.isNotNull(), F.lit(k + 1)).otherwise(0) for k, x in enumerate(live)))
        made = F.transform(F.slice(every, 1, depth), lambda x: F.coalesce(x, F.lit("")))
    else:
        made = F.array_compact(every)
    return rows.withColumn(out, made).drop("level__", "text__", *names)


def filled(rows: DataFrame, signal: Column, keys: list[str], order: str, out: str) -> DataFrame:
    """rows with the last signal so far that isn't null."""
    w = _order(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(out, F.last(signal, ignorenulls=True).over(w))


def parents(rows: DataFrame, unit_keys: list[str], standard_keys: list[str], order: str, kind: str = "kind", paragraph: str = "paragraph_id") -> DataFrame:
    """rows with parent_paragraph_id: of a sub-item the last requirement or guidance of its unit, of guidance the last requirement of its standard (which goes on where a standard is entered again)."""
    before = lambda keys: _order(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    p, k = F.col(paragraph), F.col(kind)
    top = F.last(F.when(k.isin("requirement", "application_guidance"), p), ignorenulls=True).over(before(unit_keys))
    requirement = F.last(F.when(k == "requirement", p), ignorenulls=True).over(before(standard_keys))
    known = F.lit(True)
    for key in standard_keys:
        known = known & F.col(key).isNotNull()
    parent = F.when(k == "sub_item", F.col("top__")).when((k == "application_guidance") & known, F.col("requirement__"))
    return rows.withColumn("top__", top).withColumn("requirement__", requirement).withColumn("parent_paragraph_id", parent).drop("top__", "requirement__")


def section_of_heading(text: Column, sections: dict[str, str] = SECTION_BY_HEADING) -> Column:
    """The section that a level-two heading opens; null if it opens none."""
    t = strip(text)
    return F.coalesce(lookup(t, sections), F.when(t.rlike(APPENDIX_HEADING), F.lit("appendix")))


def stated_sections(rows: DataFrame, keys: list[str], order: str, text: str = "text") -> DataFrame:
    """rows with stated_section, from headings as plain texts: a second `목적` behind the requirements opens the application part, and `용어의 정의` opens none there."""
    t = strip(F.col(text))
    plain = lookup(t, {"서론": "intro", "시행일": "effective_date", "요구사항": "requirements", "적용 및 기타 설명자료": "application"})
    sure = F.when(t == "목적", F.lit("purpose")).otherwise(plain)
    w = _order(keys, order)
    rows = rows.withColumn("sure__", sure)
    before = F.last("sure__", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("before__", before)
    # where a purpose follows the requirements it is the application part, and the definitions there are no part
    real = F.when((t == "목적") & (F.col("before__") == "requirements"), "application").otherwise(F.col("sure__"))
    rows = rows.withColumn("real__", real).withColumn("now__", F.last("real__", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    signal = F.when((t == "용어의 정의") & ~F.coalesce(F.col("now__").isin("requirements", "application"), F.lit(False)), "definitions").otherwise(F.col("real__"))
    return filled(rows.withColumn("signal__", signal), F.col("signal__"), keys, order, "stated_section").drop("sure__", "before__", "real__", "now__", "signal__")


def promoted(rows: DataFrame) -> DataFrame:
    """rows in which tables of one filled cell are quotations of its text; `promoted` tells which."""
    cell = strip(F.get(F.get("table_cells", F.lit(0)), F.lit(0)))
    single = (F.col("kind") == "table") & (F.size("table_cells") == 1) & (F.size(F.get("table_cells", F.lit(0))) == 1) & (cell != "")
    single = F.coalesce(single, F.lit(False))
    return (
        rows.withColumn("promoted", single)
        .withColumn("text", F.when(F.col("promoted"), cell).otherwise(F.col("text")))
        .withColumn("kind", F.when(F.col("promoted"), "block_quote").otherwise(F.col("kind")))
        .withColumn("table_cells", F.when(~F.col("promoted"), F.col("table_cells")))
    )


def blocks(raw: DataFrame, nums: DataFrame, levels: DataFrame, profile: Profile) -> DataFrame:
    """Structured blocks of raw blocks (source_file, idx, kind, text, style, num_id, ilvl, table_cells) of one family.

    All windows are partitioned by the file, some finer, so they share one exchange."""
    file = ["source_file"]
    rows = raw
    if profile.prelude_marker is not None:
        rows = after_marker(rows, F.coalesce(profile.prelude_marker(F.col("text"), F.col("style")), F.lit(False)), file, "idx")
    toc = F.col("style").isin(TOC_STYLES)
    opens = F.coalesce((F.col("style") == "heading 1") & F.col("text").rlike(UNIT_HEADING), F.lit(False))
    value = F.struct(F.regexp_extract("text", UNIT_HEADING, 1).alias("no"), presence(strip(F.regexp_extract("text", UNIT_HEADING, 2))).alias("title"))
    rows = units(rows.withColumn("is_toc", F.coalesce(toc, F.lit(False))).withColumn("opens", opens), F.col("opens"), value, file, "idx")
    rows = rows.withColumn("standard_no", F.coalesce(F.col("opened.no"), F.lit(profile.default_no).cast("string"))).withColumn("standard_title", F.col("opened.title")).drop("opened")
    by_unit = [*file, "unit"]
    appendix = (F.col("style") == APPENDIX_STYLE) & ~F.col("is_toc") & ~F.col("opens")
    heading_no = F.regexp_extract("style", r"^heading ([1-9])$", 1)
    heading = (F.col("kind") == "heading") & (heading_no != "") & ~F.col("is_toc") & ~F.col("opens")
    level = F.when(appendix, 3).when(heading, heading_no.cast("int"))
    rows = trail(rows, level, F.col("text"), by_unit, "idx")
    seed = F.when(F.col("unit") > 0, F.concat(F.lit(UNIT_NAME), "standard_no") if profile.prefix == "ISA" else F.concat(F.lit(f"{profile.prefix}-"), "standard_no"))
    if profile.default_no is not None:
        seed = F.coalesce(seed, F.lit(f"{profile.prefix}-{profile.default_no}"))
    # the unit's own name stands first until a level-one heading replaces it
    replaced = F.max(F.when(level == 1, 1).otherwise(0)).over(_order(by_unit, "idx").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("seed__", seed).withColumn("replaced__", replaced)
    rows = rows.withColumn("heading_trail", F.when(F.col("seed__").isNotNull() & (F.col("replaced__") == 0), F.concat(F.array("seed__"), "heading_trail")).otherwise(F.col("heading_trail")))
    in_body = F.col("standard_no").isNotNull()
    signal = F.when(appendix, "appendix").when(heading & (heading_no == "2") & in_body, section_of_heading(F.col("text")))
    rows = filled(rows.withColumn("signal__", signal), F.col("signal__"), by_unit, "idx", "section")
    rows = promoted(rows)
    skips = F.col("promoted") | F.col("kind").isin("heading", "table", "toc_entry") | (F.col("style") == APPENDIX_STYLE)
    # headings, tables and entries of contents carry no list number into the counters
    rows = rows.withColumn("skips__", F.coalesce(skips, F.lit(False))).withColumn("own_num__", F.col("num_id"))
    rows = numbered(rows.withColumn("num_id", F.when(~F.col("skips__"), F.col("num_id"))), nums, levels)
    rows = rows.withColumn("num_id", F.col("own_num__")).withColumn("kind", F.when(F.col("skips__"), F.col("kind")).otherwise(F.col("kind_n")))
    made = F.when(F.col("section") == "appendix", F.concat(F.lit(APPENDIX_PREFIX), "paragraph_n")).otherwise(F.col("paragraph_n"))
    rows = rows.withColumn("paragraph_id", F.when(~F.col("skips__"), made))
    rows = parents(rows, by_unit, [*file, "standard_no"], "idx")
    rows = rows.withColumn("is_application_guidance", F.col("kind") == "application_guidance").withColumn("is_header_footer", F.lit(False))
    rows = rows.withColumn("immediate_heading", F.get("heading_trail", F.size("heading_trail") - 1))
    return rows.select(
        "source_file", "idx", "kind", "text", "style", "paragraph_id", "is_application_guidance", "parent_paragraph_id", "standard_no", "standard_title",
        "section", "heading_trail", "immediate_heading", "is_toc", "is_header_footer", "table_cells", "unit",
    )

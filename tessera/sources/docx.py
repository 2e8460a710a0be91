"""Word-processor files as tables.

read_docx() gives, for part `body`, the paragraphs and tables in order; for `styles`, `nums` and `levels`, the dimensions
that numbering needs. The XML is read by the standard library's expat parser, which refuses documents with a DOCTYPE or
entities.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Iterator
from itertools import batched
from typing import IO
from xml.etree import ElementTree as ET
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tessera.functions.columns import item_label, kind_of_style, strip, without_reference
from tessera.model.profiles import APPENDIX_STYLE, TABLE_HEADERS, TABLE_SECTIONS, TABLE_SUBSECTIONS, TOC_STYLES
from tessera.operators.validate import latest

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
MAX_DEPTH = 10
#: Bytes of a part that are parsed at once, and rows of a batch of output.
READ_BYTES, OUT_ROWS = 1 << 16, 1000
# List formats that are told apart; any other counts in decimals.
FORMATS = ["decimal", "lowerLetter", "lowerRoman", "upperLetter", "upperRoman", "bullet"]
SCHEMAS = {
    "body": "source_file string, pos int, is_table boolean, text string, style_id string, p_num_id string, p_ilvl int, table_cells array<array<string>>, body_rows array<struct<cells:int,label:string,paragraphs:array<string>>>",
    "styles": "source_file string, pos int, style_id string, name string, based_on string, num_id string, ilvl int",
    "nums": "source_file string, pos int, num_id string, abstract_id string, overrides map<int,int>",
    "levels": "source_file string, pos int, abstract_id string, ilvl int, lvl_text string, num_fmt string, start int, suff string",
}


class UnsafeXML(ValueError):
    """The XML declares a document type or an entity."""


def parse_xml(content: bytes) -> ET.Element:
    """The root of a document without DOCTYPE and entities; nothing outside the bytes is read."""
    builder = ET.TreeBuilder()
    parser = expat.ParserCreate(namespace_separator="}")

    def refuse(*_):
        raise UnsafeXML("[XML] document types and entities are refused")

    named = lambda n: "{" + n if "}" in n else n
    parser.StartDoctypeDeclHandler = refuse
    parser.EntityDeclHandler = refuse
    parser.ExternalEntityRefHandler = refuse
    parser.StartElementHandler = lambda n, a: builder.start(named(n), {named(k): v for k, v in a.items()})
    parser.EndElementHandler = lambda n: builder.end(named(n))
    parser.CharacterDataHandler = builder.data
    parser.Parse(content, True)
    return builder.close()


def units(xml: IO[bytes], *path: str) -> Iterator[ET.Element]:
    """The children of the first element at a path of tags below the root, each let go of before the next is read; what parse_xml() refuses is refused.

    A document type can only stand before the root: a parser of its own reads up to there, ahead of the one that builds elements."""
    guard, builder = expat.ParserCreate(), ET.XMLPullParser(("start", "end"))
    guarded, depth, at, holder = True, 0, 0, None

    def refuse(*_):
        raise UnsafeXML("[XML] document types and entities are refused")

    def begun(*_):
        nonlocal guarded
        guarded = False

    guard.StartDoctypeDeclHandler = guard.EntityDeclHandler = guard.ExternalEntityRefHandler = refuse
    guard.StartElementHandler = begun
    over = False
    while not over:
        read = xml.read(READ_BYTES)
        over = not read
        if guarded:
            guard.Parse(read, over)
        if over:
            builder.close()
        else:
            builder.feed(read)
        for event, e in builder.read_events():
            if event == "start":
                if holder is None and at == depth and (depth == 0 or e.tag == W + path[depth - 1]):
                    at += 1
                    if at == len(path) + 1:
                        holder = e
                depth += 1
            else:
                depth -= 1
                if e is holder:
                    holder, at = None, -1  # only the first
                elif holder is not None and depth == len(path) + 1:
                    yield e
                    holder.remove(e)


def whole(value: str | None) -> int | None:
    try:
        return None if value is None else int(value)
    except ValueError:
        return None


def value_at(element: ET.Element | None, *path: str) -> str | None:
    """The w:val of a descendant by a path of tags."""
    for tag in path:
        element = None if element is None else element.find(W + tag)
    return None if element is None else element.get(W + "val")


def paragraph_text(p: ET.Element) -> str:
    """The text of a paragraph's own runs; tabs and breaks as characters."""
    marks = {W + "tab": "\t", W + "br": "\n", W + "cr": "\n"}
    return "".join((x.text or "") if x.tag == W + "t" else marks.get(x.tag, "") for run in p.findall(W + "r") for x in run)


def cell_texts(cell: ET.Element) -> list[str]:
    return [t for p in cell.findall(W + "p") if (t := paragraph_text(p).strip())]


def grid(table: ET.Element) -> list[list[str]]:
    rows = [["\n".join(cell_texts(c)) for c in row.findall(W + "tc")] for row in table.findall(W + "tr")]
    return [r for r in rows if r]


def body_rows(table: ET.Element) -> list[dict]:
    """A table's rows as a two-column body: how many cells, the first one's text, and the second one's paragraphs."""
    out = []
    for row in table.iter(W + "tr"):
        cells = row.findall(W + "tc")
        texts = [[paragraph_text(p) for p in c.iter(W + "p")] for c in cells[:2]]
        first = next((t for t in texts[0] if t.strip()), "") if texts else ""
        out.append({"cells": len(cells), "label": first.strip(), "paragraphs": [t.strip() for t in texts[1]] if len(texts) > 1 else []})
    return out


def elements(parent: Iterable[ET.Element], descend: bool, depth: int = 0) -> Iterator[ET.Element]:
    """Paragraphs and tables in order, content controls unwrapped; with descend also those within tables, behind the table."""
    if depth > MAX_DEPTH:
        raise ValueError(f"[DOCX] elements nest deeper than {MAX_DEPTH}")
    for child in parent:
        if child.tag == W + "sdt":
            content = child.find(W + "sdtContent")
            if content is not None:
                yield from elements(content, descend, depth + 1)
        elif child.tag in (W + "p", W + "tbl"):
            yield child
            if descend and child.tag == W + "tbl":
                yield from elements(child, descend, depth + 1)
        elif descend and child.tag in (W + "tr", W + "tc"):
            yield from elements(child, descend, depth + 1)


def rows_of(file, name: str, part: str, descend: bool = False) -> Iterator[tuple]:
    """The rows of a part of one file, a path or an open file."""
    inner = {"body": "word/document.xml", "styles": "word/styles.xml"}.get(part, "word/numbering.xml")
    with zipfile.ZipFile(file) as z:
        if inner not in z.namelist():
            if part == "body":
                raise ValueError(f"[DOCX] {name}: no {inner}")
            return
        with z.open(inner) as xml:
            yield from {"body": _body, "styles": _styles, "nums": _nums, "levels": _levels}[part](xml, name, descend)


def _body(xml: IO[bytes], name: str, descend: bool) -> Iterator[tuple]:
    pos = 0
    for e in elements(units(xml, "body"), descend):
        if e.tag == W + "p":
            text = paragraph_text(e).strip()
            if text:
                props = e.find(W + "pPr")
                yield name, pos, False, text, value_at(props, "pStyle") or "", value_at(props, "numPr", "numId"), whole(value_at(props, "numPr", "ilvl")), None, None
                pos += 1
        else:
            cells = grid(e)
            if any(c.strip() for row in cells for c in row):
                yield name, pos, True, "", "", None, None, cells, body_rows(e)
                pos += 1


def _placed(make):
    """make's rows with their position in the part behind the file's name."""

    def rows(xml: IO[bytes], name: str, descend: bool) -> Iterator[tuple]:
        yield from ((name, pos, *row[1:]) for pos, row in enumerate(make(xml, name, descend)))

    return rows


@_placed
def _styles(xml: IO[bytes], name: str, descend: bool) -> Iterator[tuple]:
    for style in units(xml):
        if style.tag == W + "style" and (found := style.get(W + "styleId")) is not None:
            yield name, found, value_at(style, "name"), value_at(style, "basedOn"), value_at(style, "pPr", "numPr", "numId"), whole(value_at(style, "pPr", "numPr", "ilvl"))


@_placed
def _nums(xml: IO[bytes], name: str, descend: bool) -> Iterator[tuple]:
    for num in (n for unit in units(xml) for n in unit.iter(W + "num")):
        found, abstract = num.get(W + "numId"), value_at(num, "abstractNumId")
        if found is not None and abstract is not None:
            starts = ((whole(o.get(W + "ilvl")), whole(value_at(o, "startOverride"))) for o in num.findall(W + "lvlOverride"))
            yield name, found, abstract, list({k: v for k, v in starts if k is not None and v is not None}.items())


@_placed
def _levels(xml: IO[bytes], name: str, descend: bool) -> Iterator[tuple]:
    for abstract in (a for unit in units(xml) for a in unit.iter(W + "abstractNum")):
        found = abstract.get(W + "abstractNumId")
        for lvl in abstract.findall(W + "lvl") if found is not None else ():
            if (ilvl := whole(lvl.get(W + "ilvl"))) is not None:
                fmt = value_at(lvl, "numFmt")
                start = whole(value_at(lvl, "start"))
                yield name, found, ilvl, value_at(lvl, "lvlText") or "", fmt if fmt in FORMATS else "decimal", 1 if start is None else start, value_at(lvl, "suff")


#: What names a row of a dimension in its file.
KEYS = {"styles": ["style_id"], "nums": ["num_id"], "levels": ["abstract_id", "ilvl"]}


def parsed(files: DataFrame, part: str = "body", descend: bool = False) -> DataFrame:
    """A part of files (name, content); each file is parsed by one task, which holds a paragraph, a table or a list at a time. Of a style, list or level that stands several times the last row stays."""
    schema = StructType.fromDDL(SCHEMAS[part])

    def run(batches):
        arrow = to_arrow_schema(schema)
        files_ = ((batch.column(0)[i].as_py(), batch.column(1)[i].as_py()) for batch in batches for i in range(batch.num_rows))
        rows = (row for name, content in files_ for row in rows_of(io.BytesIO(content), name, part, descend))
        for some in batched(rows, OUT_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), arrow, strict=True)], schema=arrow)

    rows = files.select("name", "content").mapInArrow(run, schema)
    return latest(rows, ["source_file", *KEYS[part]], "pos").drop("pos") if part in KEYS else rows


def read_docx(spark: SparkSession, path: str, part: str = "body", descend: bool = False) -> DataFrame:
    """A part of the files below a path, in any store that Spark reads."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").option("recursiveFileLookup", "true").load(path)
    return parsed(files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content"), part, descend)


def raw_blocks(styled: DataFrame) -> DataFrame:
    """Raw blocks (source_file, idx, kind, text, style, num_id, ilvl, table_cells) of body rows with style, num_id and ilvl."""
    kind = F.when(F.col("is_table"), "table").otherwise(kind_of_style(F.col("style"), TOC_STYLES, APPENDIX_STYLE))
    style = F.when(F.col("is_table"), "").otherwise(F.col("style"))
    return styled.select("source_file", F.col("pos").alias("idx"), kind.alias("kind"), "text", style.alias("style"), "num_id", "ilvl", "table_cells")


def body_table_blocks(styled: DataFrame) -> DataFrame:
    """Raw blocks of families whose body is a two-column table: a label and paragraphs in each row.

    A row without a label is a heading if its text, references left out, is known as one; the column headers' and empty
    rows are skipped, as are rows of another number of cells; any other text is a plain paragraph. A row with a label is a
    requirement and, for each further paragraph, a sub-item with its own label or a plain paragraph. Paragraphs outside
    tables stay. Numbers follow the order of what is emitted."""
    text = lambda c: strip(F.coalesce(c, F.lit("")))
    make = lambda kind, t, style, label: F.struct(kind.alias("kind"), t.alias("text"), style.alias("style"), label.alias("label"))
    none = F.lit(None).cast("string")

    def of_row(r):
        first = text(F.get(r["paragraphs"], F.lit(0)))
        canonical = without_reference(first)
        head = make(F.lit("heading"), canonical, F.when(canonical.isin(TABLE_SECTIONS), F.lit("isqm_section")).otherwise(F.lit("isqm_subsection")), none)
        bare = F.when((first == "") | canonical.isin(TABLE_HEADERS), F.array().cast("array<struct<kind:string,text:string,style:string,label:string>>")).when(canonical.isin(TABLE_SECTIONS + TABLE_SUBSECTIONS), F.array(head)).otherwise(F.array(make(F.lit("paragraph_body"), first, F.lit(""), none)))
        more = F.filter(F.transform(F.slice(r["paragraphs"], 2, F.greatest(F.size(r["paragraphs"]), F.lit(1))), text), lambda t: t != "")
        below = F.transform(more, lambda t: make(F.when(item_label(t).isNotNull(), "sub_item").otherwise("paragraph_body"), t, F.lit(""), item_label(t)))
        full = F.concat(F.array(make(F.lit("requirement"), first, F.lit(""), r["label"])), below)
        return F.when(r["cells"] != 2, F.array().cast("array<struct<kind:string,text:string,style:string,label:string>>")).when(r["label"] == "", bare).otherwise(full)

    own = F.array(make(kind_of_style(F.col("style"), TOC_STYLES, APPENDIX_STYLE), F.col("text"), F.col("style"), none))
    rows = styled.withColumn("b", F.when(F.col("is_table"), F.flatten(F.transform("body_rows", of_row))).otherwise(own))
    rows = rows.select("source_file", "pos", "is_table", "num_id", "ilvl", F.posexplode("b").alias("at", "b"))
    idx = F.row_number().over(Window.partitionBy("source_file").orderBy("pos", "at")) - 1
    return rows.select("source_file", idx.alias("idx"), "b.kind", "b.text", "b.style", F.when(~F.col("is_table"), F.col("num_id")).alias("num_id"), F.when(~F.col("is_table"), F.col("ilvl")).alias("ilvl"), F.lit(None).cast("array<array<string>>").alias("table_cells"), F.col("b.label").alias("label"))

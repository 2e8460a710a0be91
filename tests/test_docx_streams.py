"""Word-processor parts are read an element at a time."""

import io
import tracemalloc
import zipfile

import pytest

from tessera.sources import docx

NS = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
NUM = '<w:abstractNum w:abstractNumId="{0}"><w:lvl w:ilvl="1"><w:start w:val="3"/><w:numFmt w:val="lowerRoman"/><w:lvlText w:val="%2."/></w:lvl></w:abstractNum><w:num w:numId="{0}"><w:abstractNumId w:val="{0}"/><w:lvlOverride w:ilvl="2"><w:startOverride w:val="4"/></w:lvlOverride></w:num>'
PARAGRAPH = '<w:p><w:pPr><w:pStyle w:val="s"/></w:pPr><w:r><w:t>a{0}</w:t></w:r></w:p>'
PARTS = {"nums": ("word/numbering.xml", "numbering", "", NUM), "levels": ("word/numbering.xml", "numbering", "", NUM), "body": ("word/document.xml", "document", "w:body", PARAGRAPH)}


def packed(inner, xml):
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(inner, xml)
    held.seek(0)
    return held


@pytest.mark.parametrize("part", sorted(PARTS))
def test_a_part_is_read_an_element_at_a_time(part):
    inner, root, within, one = PARTS[part]
    opened, closed = (f"<{within}>", f"</{within}>") if within else ("", "")
    file = packed(inner, f'<w:{root} xmlns:w="{NS}">{opened}{"".join(one.format(i) for i in range(20_000))}{closed}</w:{root}>')
    tracemalloc.start()
    n = sum(1 for _ in docx.rows_of(file, "x", part))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 20_000 and peak < 3e6


def test_the_first_body_alone_and_no_document_type():
    body = "<w:body><w:p><w:r><w:t>{}</w:t></w:r></w:p></w:body>"
    xml = f'<w:document xmlns:w="{NS}"><w:x>{body.format("no")}</w:x>{body.format("a")}{body.format("b")}</w:document>'
    assert [r[3] for r in docx.rows_of(packed("word/document.xml", xml), "x", "body")] == ["a"]
    for typed in (f'<!DOCTYPE a [<!ENTITY b "c">]>{xml}', f"<!--{'x' * 100_000}--><!DOCTYPE a>{xml}"):
        with pytest.raises(docx.UnsafeXML):
            list(docx.rows_of(packed("word/document.xml", typed), "x", "body"))

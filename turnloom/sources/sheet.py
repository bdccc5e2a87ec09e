"""Workbooks of one sheet, written and read with the standard library alone.

Texts are stored inline, so that one which begins with '=' stays a text and nothing is held but the row at hand.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACK = "http://schemas.openxmlformats.org/package/2006"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml"
#: The parts of the package but the sheet itself.
PARTS = {
    "[Content_Types].xml": f'<Types xmlns="{_PACK}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
    f'<Override PartName="/xl/workbook.xml" ContentType="{_TYPE}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{_TYPE}.worksheet+xml"/></Types>',
    "_rels/.rels": f'<Relationships xmlns="{_PACK}/relationships"><Relationship Id="rId1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACK}/relationships"><Relationship Id="rId1" Type="{_REL}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
}


def _cell(value: object) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, int | float):
        return f"<c><v>{value!r}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'


def write(title: str, header: list[str], rows: Iterable[Iterable[object]]) -> bytes:
    """The bytes of an xlsx file."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as pack:
        for name, text in PARTS.items():
            pack.writestr(name, _HEAD + text)
        pack.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{MAIN}" xmlns:r="{_REL}"><sheets><sheet name={quoteattr(title)} sheetId="1" r:id="rId1"/></sheets></workbook>')
        with pack.open("xl/worksheets/sheet1.xml", "w") as sheet:
            sheet.write(f'{_HEAD}<worksheet xmlns="{MAIN}"><sheetData>'.encode())
            for row in (header, *rows) if isinstance(rows, list) else _chain(header, rows):
                sheet.write(f"<row>{''.join(map(_cell, row))}</row>".encode())
            sheet.write(b"</sheetData></worksheet>")
    return out.getvalue()


def _chain(header: list[str], rows: Iterable[Iterable[object]]) -> Iterable[Iterable[object]]:
    yield header
    yield from rows


def _column(reference: str | None, following: int) -> int:
    letters = re.match(r"[A-Z]+", reference or "")
    if not letters:
        return following
    at = 0
    for letter in letters[0]:
        at = at * 26 + ord(letter) - 64
    return at - 1


def _first_sheet(pack: zipfile.ZipFile) -> str:
    book = ElementTree.fromstring(pack.read("xl/workbook.xml"))
    first = book.find(f"{{{MAIN}}}sheets/{{{MAIN}}}sheet")
    wanted = first.get(f"{{{_REL}}}id") if first is not None else None
    for link in ElementTree.fromstring(pack.read("xl/_rels/workbook.xml.rels")):
        if link.get("Id") == wanted:
            target = link.get("Target", "")
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    raise ValueError("the workbook has no sheet")


def read(data: bytes) -> list[list[str | None]]:
    """Rows of the first sheet, as text; an empty cell is None."""
    with zipfile.ZipFile(io.BytesIO(data)) as pack:
        words: list[str] = []
        if "xl/sharedStrings.xml" in pack.namelist():
            words = ["".join(t.text or "" for t in item.iter(f"{{{MAIN}}}t")) for item in ElementTree.fromstring(pack.read("xl/sharedStrings.xml"))]
        out = []
        with pack.open(_first_sheet(pack)) as sheet:
            for _, row in ElementTree.iterparse(sheet):
                if row.tag != f"{{{MAIN}}}row":
                    continue
                cells: list[str | None] = []
                for cell in row:
                    at = _column(cell.get("r"), len(cells))
                    cells += [None] * (at + 1 - len(cells))
                    value = cell.find(f"{{{MAIN}}}v")
                    kind = cell.get("t")
                    if kind == "inlineStr":
                        cells[at] = "".join(t.text or "" for t in cell.iter(f"{{{MAIN}}}t"))
                    elif value is not None and value.text is not None:
                        cells[at] = words[int(value.text)] if kind == "s" else {"1": "True", "0": "False"}.get(value.text, value.text) if kind == "b" else value.text
                out.append(cells)
                row.clear()
    return out

"""Workbooks as grids. ``.xlsx`` is read with the standard library; ``.xls`` only where ``xlrd`` is installed.

A workbook that cannot be opened becomes a failure row (invalid_excel_file), an empty sheet one of category no_data, and a sheet with one
line one of category only_one_line.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

GRID = "path string, sheet string, row int, cells array<string>, category string"


def _column(reference: str) -> int:
    out = 0
    for c in re.match(r"[A-Z]+", reference).group():  # type: ignore[union-attr]
        out = out * 26 + ord(c) - 64
    return out - 1


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{{{_NS['m']}}}t"))


def read_xlsx(content: bytes) -> Iterator[tuple[str, list[list[str | None]]]]:
    """(sheet name, rows) of a workbook; ``-`` in names becomes ``_``; blank cells are None."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = [_text(si) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS)]
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for s in ElementTree.fromstring(z.read("xl/workbook.xml")).findall("m:sheets/m:sheet", _NS):
            target = links[s.get(_REL)].lstrip("/")
            tree = ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
            rows: list[list[str | None]] = []
            for r in tree.findall("m:sheetData/m:row", _NS):
                at = int(r.get("r", len(rows) + 1)) - 1
                rows += [[] for _ in range(at + 1 - len(rows))]
                for k, c in enumerate(r.findall("m:c", _NS)):
                    col = _column(c.get("r")) if c.get("r") else k
                    v = c.find("m:v", _NS)
                    if c.get("t") == "inlineStr":
                        value = _text(c)
                    elif v is None:
                        continue
                    else:
                        value = shared[int(v.text)] if c.get("t") == "s" else v.text
                    rows[at] += [None] * (col + 1 - len(rows[at]))
                    rows[at][col] = value.strip() or None if value else None
            yield s.get("name", "").replace("-", "_"), rows


def write_xlsx(sheet: str, rows: list[list[str | None]]) -> bytes:
    """A workbook with one sheet of text cells; None is a blank cell. At most 26 columns."""
    cell = lambda i, j, v: f'<c r="{chr(65 + j)}{i}" t="inlineStr"><is><t>{escape(v)}</t></is></c>'
    body = "".join(f'<row r="{i}">' + "".join(cell(i, j, v) for j, v in enumerate(r) if v is not None) + "</row>" for i, r in enumerate(rows, 1))
    link = _REL[1:].split("}")[0]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{_NS["m"]}" xmlns:r="{link}"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{_NS["m"]}"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()


def _read_any(path: str, content: bytes) -> Iterator[tuple[str, list[list[str | None]]]]:
    if content[:4] == b"PK\x03\x04":
        yield from read_xlsx(content)
        return
    import xlrd  # optional; its absence makes the file a failure row

    book = xlrd.open_workbook(file_contents=content)
    for sheet in book.sheets():
        yield sheet.name.replace("-", "_"), [[str(v).strip() or None for v in sheet.row_values(i)] for i in range(sheet.nrows)]


def _grids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["path", "sheet", "row", "cells", "category"]
    for pdf in batches:
        held: list[tuple] = []
        for path, content in zip(pdf["path"], pdf["content"]):
            out = []
            try:
                for sheet, rows in _read_any(path, bytes(content)):
                    filled = [(i, r) for i, r in enumerate(rows) if any(c is not None for c in r)]
                    if len(filled) < 2:
                        out.append((path, sheet, -1, None, "only_one_line" if filled else "no_data"))
                    else:
                        out += [(path, sheet, i, r, None) for i, r in filled]
            except Exception:  # noqa: BLE001  whatever a broken workbook raises, it is that file's failure
                out = [(path, "", -1, None, "invalid_excel_file")]
            held += out
            if len(held) > 20_000:
                yield pd.DataFrame(held, columns=columns)
                held = []
        yield pd.DataFrame(held, columns=columns)


def workbook_grids(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((path, sheet, row, cells), failures) of the workbooks among ``files`` (path, suffix, content)."""
    books = files.where(F.col("suffix").isin(".xlsx", ".xls")).select("path", "content")
    rows = books.mapInPandas(_grids, GRID)
    failures = rows.where("category is not null").select("path", "sheet", "category", F.lit("").alias("details"))
    return rows.where("category is null").drop("category"), failures

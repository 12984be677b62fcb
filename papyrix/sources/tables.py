"""CSV and XLSX files to blocks of "column: value" lines. XLSX is read with the standard library only."""

from __future__ import annotations

import csv
import datetime
import io
import re
import xml.etree.ElementTree as ET
import zipfile
from typing import Any

DELIMITERS = ",;\t"
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_EPOCH = datetime.datetime(1899, 12, 30)
# Number formats of dates that a workbook needn't define.
_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}


def cell_text(value: Any) -> str:
    if value is None:
        return ""
    if isinstance(value, float) and value.is_integer():
        return str(int(value))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return str(value).strip()


def header_of(row: list) -> list[str]:
    return [cell_text(v) or f"columna_{i}" for i, v in enumerate(row, 1)]


def block(header: list[str], row: list) -> str:
    return "\n".join(f"{name}: {shown}" for name, value in zip(header, row) if (shown := cell_text(value)))


def document(rows: list[list]) -> dict:
    header = header_of(rows[0]) if rows else []
    blocks = [block(header, row) for row in rows[1:]]
    full = [b for b in blocks if b]
    return {"text": "\n\n".join(full), "title": None, "metadata": {"columnas": header, "n_filas": len(blocks), "n_filas_con_datos": len(full)}}


def load_csv(content: bytes) -> list[dict]:
    text = content.decode("utf-8-sig")
    try:
        dialect: Any = csv.Sniffer().sniff(text[:4096], delimiters=DELIMITERS)
    except csv.Error:
        dialect = csv.excel
    return [document(list(csv.reader(io.StringIO(text, newline=""), dialect)))]


def _column(reference: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _texts(node: ET.Element) -> str:
    return "".join(t.text or "" for t in node.iter(f"{{{_NS['m']}}}t"))


def read_xlsx(content: bytes, sheet: str | None = None) -> list[list]:
    """Rows of values of a sheet, by name, or of the active one."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        xml = lambda name: ET.fromstring(z.read(name)) if name in names else None
        strings = [_texts(s) for s in xml("xl/sharedStrings.xml").findall("m:si", _NS)] if "xl/sharedStrings.xml" in names else []
        dates: list[bool] = []
        if (styles := xml("xl/styles.xml")) is not None:
            own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in styles.iterfind("m:numFmts/m:numFmt", _NS)}
            for xf in styles.iterfind("m:cellXfs/m:xf", _NS):
                k = int(xf.get("numFmtId", "0"))
                dates.append(k in _DATE_FORMATS or bool(re.search("[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", own.get(k, "")))))
        book = xml("xl/workbook.xml")
        sheets = book.findall("m:sheets/m:sheet", _NS)
        view = book.find("m:bookViews/m:workbookView", _NS)
        chosen = sheets[int(view.get("activeTab", "0")) if view is not None else 0]
        if sheet is not None:
            chosen = next(s for s in sheets if s.get("name") == sheet)
        link = chosen.get("{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id")
        relation = next((r for r in xml("xl/_rels/workbook.xml.rels") if r.get("Id") == link), None)
        target = relation.get("Target").lstrip("/")
        found = xml(target if target.startswith("xl/") else f"xl/{target}")
        rows: list[list] = []
        for row in found.iterfind("m:sheetData/m:row", _NS):
            values: list = []
            for cell in row.findall("m:c", _NS):
                at = _column(cell.get("r")) if cell.get("r") else len(values)
                values += [None] * (at - len(values))
                values.append(_value(cell, strings, dates))
            rows += [[]] * (int(row.get("r", len(rows) + 1)) - 1 - len(rows))
            rows.append(values)
        width = max(map(len, rows), default=0)
        return [r + [None] * (width - len(r)) for r in rows]


def _value(cell: ET.Element, strings: list[str], dates: list[bool]) -> Any:
    kind, raw = cell.get("t", "n"), cell.findtext("m:v", None, _NS)
    if kind == "inlineStr":
        return _texts(cell)
    if raw is None:
        return None
    if kind == "s":
        return strings[int(raw)]
    if kind == "b":
        return raw == "1"
    if kind != "n":
        return raw
    number = float(raw)
    style = int(cell.get("s", "0"))
    if style < len(dates) and dates[style]:
        return _EPOCH + datetime.timedelta(days=number)
    return int(number) if number.is_integer() and "." not in raw and "E" not in raw.upper() else number


def load_xlsx(content: bytes) -> list[dict]:
    return [document(read_xlsx(content))]

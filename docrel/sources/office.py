"""Decoders of word processor and spreadsheet files that are zip archives of XML: no library but the standard one.

Both give one page of text in the form that the extractors read: [TABLA n] and [HOJA name] lines, and rows as FILA n: a || b.
"""

from __future__ import annotations

import datetime
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")
#: Number formats that are dates, by their built-in ids.
_DATES = {14, 15, 16, 17, 22, 27, 30, 36, 45, 46, 47, 50, 57}


def _clean(text: str) -> str:
    return _CONTROL.sub("", text).strip()


def _row(n: int, cells: list[str]) -> list[str]:
    return [f"FILA {n}: " + " || ".join(cells)] if any(cells) else []


def _paragraph(p: ElementTree.Element) -> str:
    out = []
    for x in p.iter():
        if x.tag == _W + "t":
            out.append(x.text or "")
        elif x.tag == _W + "tab":
            out.append("\t")
        elif x.tag in (_W + "br", _W + "cr"):
            out.append("\n")
    return "".join(out)


def decode_docx(name: str, content: bytes) -> list[tuple[int, str]]:
    """Paragraphs, then tables. Line ends in a cell become ' | '."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(_W + "body")
    if body is None:
        return [(1, "")]
    lines = [t for t in (_clean(_paragraph(p)) for p in body.findall(_W + "p")) if t]
    for n, table in enumerate(body.findall(_W + "tbl"), 1):
        lines.append(f"[TABLA {n}]")
        for i, tr in enumerate(table.findall(_W + "tr"), 1):
            cells = ["\n".join(_paragraph(p) for p in tc.findall(_W + "p")) for tc in tr.findall(_W + "tc")]
            lines += _row(i, [_clean(c).replace("\n", " | ") for c in cells])
    return [(1, "\n".join(lines))]


def column_number(reference: str) -> int:
    """Number of a cell's column, from 1, by its letters."""
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n


def _number(text: str, is_date: bool) -> str:
    value = float(text)
    if is_date:
        return str(datetime.datetime(1899, 12, 30) + datetime.timedelta(days=value))
    return str(int(value)) if value.is_integer() and abs(value) < 1e15 else repr(value)


def _sheet_rows(z: zipfile.ZipFile, path: str, strings: list[str], dates: set[int], max_rows: int, max_columns: int) -> Iterator[tuple[int, list[str]]]:
    at = 0
    with z.open(path) as f:
        for _, row in ElementTree.iterparse(f):
            if row.tag != _S + "row":
                continue
            at = int(row.get("r") or at + 1)
            if at > max_rows:
                return
            cells: list[str] = []
            for c in row.findall(_S + "c"):
                n = column_number(c.get("r") or "") or len(cells) + 1
                if n > max_columns:
                    break
                kind, v = c.get("t"), c.find(_S + "v")
                if kind == "inlineStr":
                    text = "".join(t.text or "" for t in c.iter(_S + "t"))
                elif v is None or v.text is None:
                    text = ""
                elif kind == "s":
                    text = strings[int(v.text)]
                elif kind == "b":
                    text = "True" if v.text == "1" else "False"
                elif kind in ("str", "e"):
                    text = v.text
                else:
                    text = _number(v.text, int(c.get("s") or 0) in dates)
                cells += [""] * (n - 1 - len(cells)) + [_clean(text)]
            yield at, cells
            row.clear()


def decode_xlsx(name: str, content: bytes, max_rows: int = 500, max_columns: int = 40) -> list[tuple[int, str]]:
    """All sheets in order; of each the first rows and columns, as a reader with these limits sees it. Cells have their stored values."""
    lines = []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        strings: list[str] = []
        if "xl/sharedStrings.xml" in names:
            strings = ["".join(t.text or "" for t in si.iter(_S + "t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall(_S + "si")]
        dates: set[int] = set()
        if "xl/styles.xml" in names:
            styles = ElementTree.fromstring(z.read("xl/styles.xml"))
            own = {int(f.get("numFmtId") or 0) for f in styles.iter(_S + "numFmt") if re.search(r"[ymdh]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", (f.get("formatCode") or "").lower()))}
            formats = styles.find(_S + "cellXfs")
            dates = {i for i, x in enumerate(formats if formats is not None else []) if int(x.get("numFmtId") or 0) in _DATES | own}
        targets = {}
        for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels")):
            target = r.get("Target") or ""
            targets[r.get("Id")] = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(_S + "sheet"):
            lines.append(f"[HOJA {sheet.get('name')}]")
            path = targets.get(sheet.get(_R + "id"))
            if path in names:
                for n, cells in _sheet_rows(z, path, strings, dates, max_rows, max_columns):
                    lines += _row(n, cells)
    return [(1, "\n".join(lines))]


#: Decoders by extension, for readers.dispatch().
DECODERS = {".docx": decode_docx, ".xlsx": decode_xlsx, ".xlsm": decode_xlsx}
